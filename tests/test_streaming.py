"""Incremental loads through a file stream, several batches."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_key
from strata.operators.scd2 import scd2_apply, scd2_seed
from strata.session import fresh_table_path
from strata.sources.fixtures import Store
from strata.streaming.incremental import incremental_load, scd2_step, upsert_step
from tests.conftest import SF_SMALL


def test_upsert_stream_over_three_batches(spark):
    events = Store(spark, SF_SMALL).raw("events")
    src = fresh_table_path(spark, "events_in")
    for i, (lo, hi) in enumerate([("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2025-01-01")]):
        part = events.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(f"{src}/part{i}")
        # one file per batch, in order
    files = [f"{src}/part{i}" for i in range(3)]
    flat = fresh_table_path(spark, "events_flat")
    for i, f in enumerate(files):
        spark.read.parquet(f).coalesce(1).write.mode("append").parquet(flat)
    out = incremental_load(
        spark, flat, events.schema, None,
        fresh_table_path(spark, "latest"), fresh_table_path(spark, "ckpt"),
        upsert_step(["event_type", "user_id"], order_by=["ts", "event_id"]), files_per_batch=1,
    )
    got = sorted(map(tuple, spark.read.parquet(out).select(*events.columns).collect()), key=str)
    want = sorted(map(tuple, latest_per_key(events, ["event_type", "user_id"], ["ts", "event_id"]).collect()), key=str)
    assert got == want
    assert out.endswith("version=000000002")


def test_scd2_stream_equals_batch(spark):
    store = Store(spark, SF_SMALL)
    src = fresh_table_path(spark, "customers_in")
    store.customers_s2.write.parquet(src)
    day = dt.date(2000, 6, 1)
    out = incremental_load(
        spark, src, store.customers_s2.schema, scd2_seed(store.customers_s1),
        fresh_table_path(spark, "dim"), fresh_table_path(spark, "ckpt"), scd2_step("id", lambda n: day),
    )
    got = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    want = sorted(map(tuple, scd2_apply(scd2_seed(store.customers_s1), store.customers_s2, day).collect()), key=str)
    assert got == want


def test_rerun_without_new_files_returns_latest_version(spark):
    store = Store(spark, SF_SMALL)
    src = fresh_table_path(spark, "customers_in")
    store.customers_s2.write.parquet(src)
    root, ckpt = fresh_table_path(spark, "dim"), fresh_table_path(spark, "ckpt")
    args = (spark, src, store.customers_s2.schema, scd2_seed(store.customers_s1), root, ckpt,
            scd2_step("id", lambda n: dt.date(2000, 6, 1)))
    first = incremental_load(*args)
    again = incremental_load(*args)  # same checkpoint: nothing new to read
    assert first == again and first.endswith("version=000000000")


def test_first_batch_creates_the_table(spark):
    store = Store(spark, SF_SMALL)
    src = fresh_table_path(spark, "customers_in")
    store.customers_s1.coalesce(1).write.parquet(f"{src}/load1")
    flat = fresh_table_path(spark, "customers_flat")
    spark.read.parquet(f"{src}/load1").coalesce(1).write.parquet(flat)
    out = incremental_load(
        spark, flat, store.customers_s1.schema, None,
        fresh_table_path(spark, "dim"), fresh_table_path(spark, "ckpt"), scd2_step("id", lambda n: dt.date(2000, 6, 1)),
    )
    got = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    assert got == sorted(map(tuple, scd2_seed(store.customers_s1).collect()), key=str)


def test_new_checkpoint_goes_on_from_the_table(spark):
    """A second stream over an existing table neither overwrites nor hides what is there."""
    schema = "id long, v string"
    root = fresh_table_path(spark, "table")
    for n, rows in enumerate([[(1, "a"), (2, "b")], [(2, "NEW"), (3, "c")]]):
        src = fresh_table_path(spark, f"in{n}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)
        out = incremental_load(spark, src, spark.createDataFrame([], schema).schema, None, root, fresh_table_path(spark, "ckpt"), upsert_step("id"))
    assert {r.id: r.v for r in spark.read.parquet(out).collect()} == {1: "a", 2: "NEW", 3: "c"}


def test_first_batch_refuses_a_repeated_key(spark):
    import pytest

    src = fresh_table_path(spark, "in")
    spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string").coalesce(1).write.parquet(src)
    with pytest.raises(Exception, match="more than one row"):
        incremental_load(spark, src, spark.createDataFrame([], "id long, v string").schema, None, fresh_table_path(spark, "t"), fresh_table_path(spark, "c"), upsert_step("id"))


def test_old_versions_are_removed(spark):
    from strata.sources import sinks

    src, root = fresh_table_path(spark, "in"), fresh_table_path(spark, "t")
    for k in range(4):
        spark.createDataFrame([(k, "v")], "id long, v string").coalesce(1).write.mode("append").parquet(src)
    out = incremental_load(spark, src, spark.createDataFrame([], "id long, v string").schema, None, root, fresh_table_path(spark, "c"), upsert_step("id"), files_per_batch=1)
    assert spark.read.parquet(out).count() == 4
    assert [sinks.exists(spark, f"{root}/version={k:09d}") for k in range(4)] == [False, False, True, True]


def test_registered_stream_reads_a_table_directory(spark):
    from strata.plans.queries import QUERIES

    base = fresh_table_path(spark, "sf")
    Store(spark, SF_SMALL).raw("events").repartition(3).write.parquet(f"{base}/events.parquet")
    got, want = (sorted(map(tuple, QUERIES[q](spark, base).collect()), key=str) for q in ("stream_latest_events", "dedupe_latest"))
    assert got == want and got
