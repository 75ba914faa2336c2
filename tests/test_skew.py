"""A key holding a third of all rows: results stay whole and exact, and the
plan splits or pre-reduces the hot group instead of sending it to one task."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_key
from strata.plans import marts
from strata.plans.warehouse import REPORT_DATE, Warehouse
from tests.conftest import SF_SMALL

SF_SKEW = "/root/testdata/sf0.01"  # enough rows per partition for the size statistics

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_orders(w):
    """Orders of the store where every third order ships to address 1.

    The testdata files are single row groups, so a scan is one map task and
    AQE (which splits a skewed partition by ranges of map tasks) would have
    nothing to split; a large table is many files, which the round-robin
    repartition stands in for.
    """
    o = w.fct_orders
    hot = o.withColumn("addressId", F.when(o.id % 3 == 0, F.lit(1).cast("long")).otherwise(o.addressId))
    return hot.repartition(8)


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_address_is_summed_before_the_shuffle(spark, skew_conf):
    """City delivery: a hot address is one row of sums for each task, and the result is exact."""
    w = Warehouse(spark, SF_SKEW)
    orders = hot_orders(w)
    got = marts.city_delivery(w.dim_addresses, orders, REPORT_DATE)
    plan = final_plan(got)
    assert "partial_count" in plan and "partial_sum" in plan
    assert sum(r.OrdersCount for r in got.collect()) == w.fct_orders.count()


def test_hot_address_join_is_split_and_exact(spark, skew_conf):
    w = Warehouse(spark, SF_SKEW)
    orders = hot_orders(w)
    got = marts.geo_orders(orders, w.dim_addresses, REPORT_DATE)
    assert "SortMergeJoin(skew=true) [addressId" in final_plan(got)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        want = marts.geo_orders(orders, w.dim_addresses, REPORT_DATE).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    assert sum(r.OrdersCount for r in want) == w.fct_orders.count()


def test_hot_key_latest_per_key_is_exact(spark):
    events = Warehouse(spark, SF_SMALL).store.raw("events")
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("user_id")))
    got = {(r.event_type, r.user_id): r.event_id for r in latest_per_key(hot, ["event_type", "user_id"], ["ts", "event_id"]).collect()}
    pdf = hot.toPandas().sort_values(["ts", "event_id"]).groupby(["event_type", "user_id"]).tail(1)
    want = {(r.event_type, r.user_id): r.event_id for r in pdf.itertuples()}
    assert got == want


def test_rows_without_a_key_are_spread_over_the_tasks_of_a_merge(spark):
    """99 % of the source lacks the key: neither the uniqueness check nor the join gathers them."""
    from strata.operators.merge import merge

    source = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, F.col("id")).alias("id"), F.col("id").alias("v")).repartition(4)
    target = spark.range(500).select("id", F.lit(0).cast("long").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merge(target, source, "id", spread_null_keys=True)
        per_task = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == 500 + 20_000 - 5 and max(per_task) < 2 * min(per_task)
    assert plan.count("Exchange hashpartitioning") == 2  # one for each side: the check uses the join's
    assert all("group__" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
