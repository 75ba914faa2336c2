"""Observed writes, touched partitions, bucketed marts, drifting listings, stateful streams, filled periods."""

import contextlib
import datetime as dt
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import merge, merge_actions
from strata.plans import layers, marts, periods, upkeep, warehouse
from strata.plans.oracle import ORACLES
from strata.plans.warehouse import REPORT_DATE, Warehouse
from strata.session import fresh_table_path
from strata.sources import sinks
from strata.sources.drifting import parsed_lines, rejected_lines, runs_of
from strata.sources.observed import write_merged, write_observed
from strata.streaming.stateful import append_first_seen, append_latest
from tests.conftest import SF_SMALL
from tests.test_oracle import _rows, duck  # noqa: F401

SCHEMA = "id long, v string, part long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_merge_is_counted_by_its_write(spark):
    t = spark.createDataFrame([(i, "a", 0) for i in range(100)], SCHEMA).repartition(3)
    s = spark.createDataFrame([(i, "a" if i % 2 else None, 0) for i in range(90, 130)], SCHEMA)
    path, report = write_merged(spark, merge_actions(t, s, "id", when_changed="v"), "t", invalid=F.col("v").isNull())
    assert report == {"table_rows": 130, "insert_rows": 30, "update_rows": 5, "keep_rows": 5, "absent_rows": 90, "invalid_rows": 20}
    written = spark.read.parquet(path)
    assert written.columns == t.columns and rows(written) == rows(merge(t, s, "id", when_changed="v"))
    _, empty = write_observed(spark, t.limit(0), "none", {"n": F.count(F.lit(1))})
    assert empty == {"n": 0}


def files(path):
    return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_touched_partitions_are_read_and_written(spark, tmp_path):
    t = spark.createDataFrame([(i, "old", i // 10) for i in range(100)], SCHEMA)
    path = str(tmp_path / "t")
    sinks.overwrite(t, path, partition_by=["part"])
    before = files(path)
    s = spark.createDataFrame([(12, "new", 1), (15, "old", 1), (73, "new", 7), (205, "new", 20)], SCHEMA)
    out = layers.merge_touched(spark, path, s, "id", "part", when_changed="v")
    assert rows(out) == rows(merge(t, s, "id", when_changed="v"))
    gone = {f.split("part=")[1].split("/")[0] for f in before - files(path)}
    assert gone == {"1", "7"}
    # nothing of the way there is left in the shared folder
    assert not [n for n in os.listdir(os.path.dirname(fresh_table_path(spark, "x")).removeprefix("file:")) if n.startswith("touched-")]


def test_a_load_that_runs_again_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "loads")
    first, second = (spark.createDataFrame([(i, f"{load}", 0) for i in range(4)], SCHEMA) for load in "ab")
    for load, df in ((1, first), (2, second.limit(2)), (2, second), (2, second), (3, second.limit(0))):
        sinks.append_load(df, path, load)
    assert rows(spark.read.parquet(path).select("id", "v", "part")) == rows(first.union(second))
    with pytest.raises(ValueError, match="already"):
        sinks.append_load(first, path, 1, column="id")


def test_bucketed_orders_and_lines_are_not_shuffled(spark):
    w = Warehouse(spark, SF_SMALL)
    orders = sinks.write_bucketed(spark, w.fct_orders, "fct_orders", ["id"], 4)
    lines = sinks.write_bucketed(spark, w.orderdetails_by_order, "fct_orderdetails", ["orderId"], 4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mart = marts.city_sales(spark.table(orders), w.dim_addresses, spark.table(lines), w.dim_items, REPORT_DATE)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            mart.explain()
        found = rows(mart)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        for table in (orders, lines):
            sinks.drop_bucketed(spark, table)
    shuffles = [line for line in buf.getvalue().splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "(city" in shuffles[0]
    assert found == rows(marts.city_sales(w.fct_orders, w.dim_addresses, w.orderdetails_by_order, w.dim_items, REPORT_DATE))


def test_order_lines_are_dealt_by_their_rows(spark, tmp_path, monkeypatch):
    """A task rolls up and joins a bounded number of lines, however few bytes these are in a shuffle."""
    monkeypatch.setattr(warehouse, "LINES_PER_TASK", 100, raising=False)
    lines = [(n % 1000, n % 7, float(n % 50)) for n in range(2000)] + [(None, 1, 2.0), (3, None, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    w = Warehouse(spark, str(tmp_path))
    dealt = w.orderdetails_by_order
    assert rows(dealt) == rows(w.fct_orderdetails)
    orders = spark.range(1000).select(F.col("id").alias("orderId"), (F.col("id") % 3).alias("addressId"))
    for df in (dealt, orders.hint("merge").join(dealt, "orderId")):
        tasks = df.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 15 and max(t["count"] for t in tasks) < 250


def test_buckets_follow_the_order_lines(spark, monkeypatch):
    """Buckets hold a bounded number of lines and are one file each, so a task neither writes nor reads more."""
    monkeypatch.setattr(warehouse, "LINES_PER_TASK", 500, raising=False)
    seen = {}

    def drop(spark, table, plain=sinks.drop_bucketed):
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
        per_file = spark.table(table).groupBy(F.input_file_name()).count().collect()
        seen[table.rpartition("_")[0]] = int(described["Num Buckets"]), len(per_file), max(r["count"] for r in per_file)
        plain(spark, table)

    monkeypatch.setattr(sinks, "drop_bucketed", drop)
    found = rows(upkeep.mart_city_sales_bucketed(spark, SF_SMALL))
    w = Warehouse(spark, SF_SMALL)
    many = -(-w.store.raw("lineitem").count() // 500)
    assert many > 8 and set(seen) == {"fct_orders", "fct_orderdetails"}
    for buckets, count, most in seen.values():
        assert (buckets, count) == (many, many) and most < 700
    assert found == rows(marts.city_sales(w.fct_orders, w.dim_addresses, w.fct_orderdetails, w.dim_items, REPORT_DATE))


def test_fields_are_found_where_they_have_been(spark):
    lines = [
        json.dumps({"run_id": 1, "job_id": 2, "start_time": 1000, "end_time": 2000, "state": {"result_state": "FAILED"}, "tasks": [{"task_key": "a", "start_time": 5}]}),
        json.dumps({"id": 2, "job": {"id": 7}, "times": {"start": 3, "end": 4}, "status": "OK", "steps": [{"key": "b", "times": {"start": 6}}]}),
        json.dumps({"run_id": "3", "start_time": "1970-01-01T00:00:01Z", "result_state": None, "unknown": [1, {"x": 2}]}),
        json.dumps({"run_id": {"a": 1}}), json.dumps([1]), "7", "null", "", "{broken", None, json.dumps({"run_id": "x"}),
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = {r.run_id: r for r in runs_of(df).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].job_id, got[1].start_time, got[1].state.result_state, got[1].tasks[0].task_key) == (2, 1000, "FAILED", "a")
    assert (got[2].job_id, got[2].start_time, got[2].end_time, got[2].state.result_state) == (7, 3, 4, "OK")
    assert (got[2].tasks[0].task_key, got[2].tasks[0].start_time) == ("b", 6)
    assert (got[3].start_time, got[3].end_time, got[3].state.result_state, got[3].tasks) == (1000, None, None, None)
    reasons = sorted((str(r.value), r.rejected) for r in rejected_lines(df).collect())
    assert reasons == sorted(
        [('{"run_id": {"a": 1}}', "no run id"), ("[1]", "no object"), ("7", "no object"), ("null", "no object"), ("", "no JSON"), ("{broken", "no JSON"), ("None", "no JSON"), ('{"run_id": "x"}', "no run id")]
    )
    assert parsed_lines(df).count() == len(lines) and runs_of(df.limit(0)).count() == 0


EVENT = "k long, at timestamp, n long"


def event(k, day, n):
    return (k, dt.datetime(2024, 1, day), n)


def arrive(spark, path, batch):
    spark.createDataFrame(batch, EVENT).coalesce(1).write.mode("append").parquet(path)


def test_a_stream_appends_a_key_once_and_goes_on_after_a_restart(spark, tmp_path):
    src, table, check = (str(tmp_path / n) for n in ("src", "table", "check"))
    schema = spark.createDataFrame([], EVENT).schema

    def run():
        return append_first_seen(spark, src, schema, "k", "at", "5 days", table, check)

    arrive(spark, src, [event(1, 1, 0), event(2, 2, 0), event(1, 2, 0)])
    assert sorted(r.k for r in run().collect()) == [1, 2]
    before = files(table)
    arrive(spark, src, [event(2, 3, 0), event(3, 20, 0)])
    assert sorted(r.k for r in run().collect()) == [1, 2, 3]
    assert before < files(table)  # what was there has not been written again
    arrive(spark, src, [event(4, 2, 0), event(1, 21, 0), event(3, 22, 0)])  # too late; forgotten; known
    assert sorted(r.k for r in run().collect()) == [1, 1, 2, 3]


def test_a_stream_keeps_the_newest_row_and_writes_changes_only(spark, tmp_path):
    src, log, check = (str(tmp_path / n) for n in ("src", "log", "check"))
    schema = spark.createDataFrame([], EVENT).schema

    def run():
        return rows(append_latest(spark, src, schema, "k", ["at"], log, check).select("k", F.dayofmonth("at"), "n"))

    arrive(spark, src, [event(k, 5, 0) for k in range(50)] + [event(7, 6, 1)])
    assert run() == sorted([(k, 5, 0) for k in range(50) if k != 7] + [(7, 6, 1)], key=str)
    arrive(spark, src, [event(7, 9, 2), event(8, 1, 9), event(60, 1, 0), event(9, 5, 4)])
    want = {**{k: (k, 5, 0) for k in range(50)}, 7: (7, 9, 2), 9: (9, 5, 4), 60: (60, 1, 0)}
    assert run() == sorted(want.values(), key=str)
    sizes = {r.batch: r.n for r in spark.read.parquet(log).groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert max(sizes.values()) == 50 and sorted(sizes.values())[-2] <= 4


def test_periods_without_rows_are_zero(spark):
    days = [dt.date(2023, 12, 30), dt.date(2024, 2, 29), dt.date(2024, 2, 29)]
    fact = spark.createDataFrame([(days[0], "a"), (days[1], "a"), (days[2], None), (None, "b")], "d date, g string")
    got = rows(periods.period_rollup_filled(fact, "d", ["g"], measure="n"))
    by = {f: [r for r in got if r[0] == f] for f in ("daily", "weekly", "monthly", "yearly")}
    assert [len(by[f]) for f in by] == [2 * 62, 2 * 10, 2 * 3, 2 * 2]
    assert [r[-1] for r in sorted(by["monthly"], key=lambda r: (str(r[1]), r[2]))] == [0, 0, 1, 1, 0, 1]
    assert sum(r[-1] for r in by["daily"]) == sum(r[-1] for r in by["yearly"]) == 3
    kept = [r for r in got if r[-1]]
    assert {(r[0], r[2], r[3]) for r in kept} == {tuple(r)[:3] for r in periods.period_rollup(fact, "d").collect()}
    assert periods.period_rollup_filled(fact.limit(0), "d", ["g"]).count() == 0


WRONG = {
    "asof_by_fact_date": ("as_of_join_by_date", lambda f, d, *a, **o: upkeep_literal(f, d, *a)),
    "scd2_late_load": ("scd2_splice", lambda t, s, *a, **o: t),
    "mart_city_delivery_kept_up": ("apply_changes", lambda state, *a: state),
    "mart_city_sales_kept_up": ("state_changes", lambda state, changes, grain, m: changes.groupBy(*grain).agg(F.count("*").alias("rows_in"), F.sum(m["revenue"]).alias("revenue")).withColumn("change", F.lit(1))),
    "mart_customers_distinct": ("distinct_counts", lambda state, grain, name: state.groupBy(*grain).agg(F.count("*").alias(name))),
    "reconcile_differences": ("differences", lambda s, t, k: s.join(t, k, "left_anti").select(k, F.lit("missing").alias("difference"), F.lit(1).alias("source_rows"), F.lit(0).alias("target_rows"))),
}


def upkeep_literal(fact, dim, key, date, columns):
    """As of one day instead of each row's own."""
    from strata.operators.scd2 import scd2_as_of

    d = scd2_as_of(dim, REPORT_DATE).select(F.col("id").alias("__k"), *[F.col(c).alias(n) for c, n in columns.items()])
    return fact.join(d, F.col(key) == F.col("__k"), "left").drop("__k")


@pytest.mark.parametrize("name", sorted(WRONG))
def test_wrong_operators_turn_their_queries_red(spark, duck, monkeypatch, name):  # noqa: F811
    monkeypatch.setattr(upkeep, *WRONG[name])
    got = upkeep.QUERIES[name](spark, SF_SMALL)
    rel = duck.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.collect(), got.columns, sorted(columns)) != _rows(rel.fetchall(), columns, sorted(columns))
