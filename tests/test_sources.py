"""Readers see a table as it is now."""

from pyspark.sql import functions as F

from strata.session import fresh_table_path
from strata.sources.fixtures import Store
from strata.sources.tables import read_table


def test_a_rewritten_table_shows_its_new_column(spark):
    base = fresh_table_path(spark, "base")
    spark.range(3).write.parquet(f"{base}/t.parquet")
    assert read_table(spark, base, "t").columns == ["id"]
    spark.range(3).withColumn("x", F.lit(1)).write.mode("overwrite").parquet(f"{base}/t.parquet")
    assert read_table(spark, base, "t").columns == ["id", "x"]


def test_appended_rows_are_seen(spark):
    base = fresh_table_path(spark, "base")
    for n in (10, 20):
        spark.range(10).write.mode("append").parquet(f"{base}/events.parquet")
        assert Store(spark, base).raw("events").count() == n


def test_customers_without_orders_stay(spark):
    base = fresh_table_path(spark, "base")
    spark.createDataFrame([(1, "A", 9500.0), (2, "B", 10.0)], "c_custkey long, c_mktsegment string, c_acctbal double").write.parquet(f"{base}/customer.parquet")
    spark.sql("select 1L as o_custkey, timestamp_ntz'1997-01-01 00:00:00' as o_orderdate").write.parquet(f"{base}/orders.parquet")
    assert sorted((r.id, r.status, str(r.createdOn)) for r in Store(spark, base).customers.collect()) == [(1, "VIP", "1997-01-01"), (2, "REGULAR", "None")]


def test_dimensions_are_written_once_until_their_files_change(spark):
    from strata.plans.warehouse import Warehouse

    base = fresh_table_path(spark, "base")
    schema = "p_partkey long, p_brand string, p_name string, p_retailprice double"
    for n in (3, 5):
        rows = [(k, "b", f"item {k}", 1.0 + k) for k in range(1, n)]
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{base}/part.parquet")
        a, b = (Warehouse(spark, base).dim_items for _ in range(2))
        assert a.inputFiles() == b.inputFiles()
        assert a.count() == n - 1
