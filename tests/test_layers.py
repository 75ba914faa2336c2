"""The jobs chained through written snapshots, as a scheduler would run them."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.reconcile import reconcile_counts
from strata.plans import layers, marts
from strata.plans.warehouse import Warehouse
from strata.sources.fixtures import Store
from tests.conftest import SF_SMALL

DAY = dt.date(2000, 6, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_chain_through_snapshots_equals_in_memory(spark):
    st = Store(spark, SF_SMALL)
    read = spark.read.parquet

    # ingestion: first load creates, second load upserts (duplicates dropped, latest load wins)
    ing = layers.run_job(spark, layers.ingest_upsert(None, st.customers_s1), "customers")
    ing = layers.run_job(spark, layers.ingest_upsert(read(ing), st.customers_dup, order_by=["load_no"]).drop("load_no"), "customers")
    report = reconcile_counts(st.customers_dup, read(ing), "id").first()
    assert report.keys_match and not report.rows_match

    # processing: SCD2 customers over two loads, cleaned addresses, facts
    dim = layers.run_job(spark, layers.process_dimension(None, st.customers_s1, DAY), "dim_customers")
    dim = layers.run_job(spark, layers.process_dimension(read(dim), st.customers_s2, DAY), "dim_customers")
    assert rows(read(dim)) == rows(Warehouse(spark, SF_SMALL).dim_customers)
    again = layers.process_dimension(read(dim), st.customers_s2, DAY)
    assert rows(again) == rows(read(dim))

    adr = layers.run_job(spark, layers.process_dimension(None, st.addresses, DAY, clean=True), "dim_addresses")
    adr = layers.run_job(spark, layers.process_dimension(read(adr), st.addresses_s2, DAY, clean=True), "dim_addresses")
    assert rows(read(adr)) == rows(Warehouse(spark, SF_SMALL).dim_addresses)

    fct = layers.run_job(spark, layers.process_fact(None, st.customers_s1), "fct_customers")
    fct = read(layers.run_job(spark, layers.process_fact(read(fct), st.customers_s2), "fct_customers"))
    assert fct.filter(F.col("type") == "PREMIUM").count() > 0

    od = layers.run_job(spark, layers.process_orderdetails(None, st.raw_orderdetails_shipped_before("1998-01-01")), "fct_orderdetails")
    od = read(layers.run_job(spark, layers.process_orderdetails(read(od), st.raw_orderdetails), "fct_orderdetails"))
    assert rows(od) == rows(st.fct_orderdetails)

    # marts: a monthly run, then the next run replacing the overlapping month
    m = layers.run_job(spark, layers.merge_mart(None, marts.orders_monthly(st.fct_orders, "1995-01-01", "1999-06-15")), "dm_orders_monthly")
    m = read(layers.run_job(spark, layers.merge_mart(read(m), marts.orders_monthly(st.fct_orders, "1999-06-01", "2001-12-31")), "dm_orders_monthly"))
    assert rows(m) == rows(marts.orders_monthly(st.fct_orders, "1995-01-01", "2001-12-31"))


def test_bucketed_chain(spark):
    st = Store(spark, SF_SMALL)
    dim = layers.run_job(spark, layers.process_dimension(None, st.customers_s1, DAY), "dim_customers", bucket_by=["id"], buckets=4)
    nxt = layers.process_dimension(spark.table(dim), st.customers_s2, DAY, co_partitions=4)
    dim = layers.run_job(spark, nxt, "dim_customers", bucket_by=["id"], buckets=4)
    assert rows(spark.table(dim)) == rows(Warehouse(spark, SF_SMALL).dim_customers)


def test_partitioned_mart_rewrites_only_the_runs_periods(spark):
    import glob
    import os

    from strata.session import fresh_table_path

    st = Store(spark, SF_SMALL)
    path = fresh_table_path(spark, "dm_orders_monthly")
    local = path[len("file:"):] if path.startswith("file:") else path
    layers.write_mart_periods(spark, marts.orders_monthly(st.fct_orders, "1995-01-01", "1999-06-15"), path)

    def files(period):
        return sorted((f, os.path.getmtime(f)) for f in glob.glob(f"{local}/ReportingPeriod={period}/*.parquet"))

    untouched, replaced = files("1996-Mar"), files("1999-Jun")
    assert untouched and replaced
    got = layers.write_mart_periods(spark, marts.orders_monthly(st.fct_orders, "1999-06-01", "2001-12-31"), path)
    assert files("1996-Mar") == untouched
    assert files("1999-Jun") != replaced
    assert rows(got.select("ReportingPeriod", "Orders_Number")) == rows(
        marts.orders_monthly(st.fct_orders, "1995-01-01", "2001-12-31")
    )


MONTHLY_SQL = """
select date_format(trunc(deliveryDate, 'MM'), 'yyyy-MMM') as ReportingPeriod, count(1) as Orders_Number
from fct_orders where deliveryDate between :beg_date and :exp_date
group by 1
"""


def test_mart_job_with_merge_sink(spark):
    st = Store(spark, SF_SMALL)
    src = {"fct_orders": st.fct_orders}
    first = layers.run_mart_job(
        spark, MONTHLY_SQL, src, {"beg_date": dt.date(1995, 1, 1), "exp_date": dt.date(1999, 6, 15)}, "dm_orders_monthly", "merge"
    )
    second = layers.run_mart_job(
        spark, MONTHLY_SQL, src, {"beg_date": dt.date(1999, 6, 1), "exp_date": dt.date(2001, 12, 31)}, "dm_orders_monthly", "merge",
        current_path=first,
    )
    assert rows(spark.read.parquet(second)) == rows(marts.orders_monthly(st.fct_orders, "1995-01-01", "2001-12-31"))
    over = layers.run_mart_job(
        spark, MONTHLY_SQL, src, {"beg_date": dt.date(1999, 6, 1), "exp_date": dt.date(2001, 12, 31)}, "dm_orders_monthly", "overwrite"
    )
    assert rows(spark.read.parquet(over)) == rows(marts.orders_monthly(st.fct_orders, "1999-06-01", "2001-12-31"))


def test_partitioned_mart_keeps_other_grains_of_a_period(spark):
    from strata.session import fresh_table_path

    schema = "ReportingPeriod string, type string, n long"
    path = fresh_table_path(spark, "dm_by_type")
    grain = ["ReportingPeriod", "type"]
    layers.write_mart_periods(spark, spark.createDataFrame([("2024-Mar", "A", 1), ("2024-Mar", "B", 2), ("2024-Feb", "A", 3)], schema), path, grain=grain)
    run = spark.createDataFrame([("2024-Mar", "A", 9), ("2024-Apr", "A", 4)], schema)
    got = layers.write_mart_periods(spark, run, path, grain=grain)
    assert rows(got.select(*grain, "n")) == [("2024-Apr", "A", 4), ("2024-Feb", "A", 3), ("2024-Mar", "A", 9), ("2024-Mar", "B", 2)]


def test_first_loads_refuse_a_repeated_key(spark):
    import pytest
    from pyspark.errors import PySparkException

    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string")
    for first in (layers.process_dimension(None, twice, DAY), layers.process_fact(None, twice)):
        with pytest.raises(PySparkException):
            first.collect()


def test_fact_values_are_cast_before_they_are_hashed(spark):
    first = layers.process_fact(None, spark.createDataFrame([(1, "1.50")], "id long, v string").selectExpr("id", "cast(v as decimal(9,2)) v"))
    path = layers.run_job(spark, first, "fct")
    same = spark.createDataFrame([(1, 1.5)], "id long, v double")
    assert rows(layers.process_fact(spark.read.parquet(path), same)) == rows(spark.read.parquet(path))


def test_named_table_moves_its_pointer_and_drops_old_snapshots(spark):
    from strata.sources import sinks

    name = f"named_{id(spark)}"
    assert sinks.current(spark, name) is None
    paths = []
    for n in range(4):
        sinks.publish(spark, name, spark.range(n + 1), keep=2)
        paths.append(sinks.snapshots(spark, name)[-1])
    assert sinks.current(spark, name).count() == 4
    assert [sinks.exists(spark, p) for p in paths] == [False, False, True, True]


def test_bucketed_job_needs_a_bucket_count(spark):
    import pytest

    with pytest.raises(ValueError):
        layers.run_job(spark, spark.range(3), "t", bucket_by=["id"])


def test_queries_leave_no_tables_and_views_behind(spark):
    from strata.plans.queries import QUERIES

    spark.range(3).createOrReplaceTempView("fct_orders")
    before = {t.name for t in spark.catalog.listTables()}
    try:
        for name in ("scd2_third_load", "asof_dim", "upsert_bucketed", "mart_runner_sql"):
            assert QUERIES[name](spark, SF_SMALL).count() > 0
        assert {t.name for t in spark.catalog.listTables()} == before
        assert spark.table("fct_orders").columns == ["id"] and spark.table("fct_orders").count() == 3
    finally:
        spark.catalog.dropTempView("fct_orders")


def test_the_order_detail_job_merges_on_plain_keys(spark):
    from strata.sources.fixtures import Store

    st = Store(spark, SF_SMALL)
    job = layers.process_orderdetails(layers.process_orderdetails(None, st.raw_orderdetails_shipped_before("1998-01-01")), st.raw_orderdetails)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = job._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # the roll-ups' partitioning by (order, item) serves the check and the join
    assert plan.count("Exchange hashpartitioning") == 2 and "coalesce(__t_orderId" not in plan
