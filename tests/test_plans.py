"""Physical-plan properties: pushdown, pruning, top-k, map-side limits, no Python."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from strata.operators.scd2 import scd2_as_of, scd2_seed
from strata.plans import marts
from strata.plans.queries import QUERIES
from strata.plans.warehouse import REPORT_DATE, Warehouse
from strata.session import fresh_table_path
from strata.sources.fixtures import Store
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_as_of_bounds_reach_the_parquet_scan(spark):
    path = fresh_table_path(spark, "dim_items")
    scd2_seed(Store(spark, SF_SMALL).items).write.parquet(path)
    text = plan(scd2_as_of(spark.read.parquet(path), "2000-06-01"))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][0]
    assert "LessThanOrEqual(beg_date,2000-06-01)" in pushed
    assert "GreaterThan(exp_date,2000-06-01)" in pushed


def test_column_pruning_in_geo_mart(spark):
    text = plan(E.queries()["mart_geo_orders"](spark, SF_SMALL))
    schemas = [line for line in text.splitlines() if "ReadSchema" in line and "o_orderkey" in line]
    assert schemas and all("o_orderdate" not in s and "o_totalprice" not in s for s in schemas)


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(E.queries()["mart_vip_cities"](spark, SF_SMALL))


def test_latest_per_key_limits_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(E.queries()["dedupe_latest"](spark, SF_SMALL))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_flagship_reads_three_order_line_columns(spark):
    text = plan(E.queries()["mart_city_sales"](spark, SF_SMALL))
    schemas = [line for line in text.splitlines() if "ReadSchema" in line and "l_orderkey" in line]
    assert schemas and all(
        s.split("ReadSchema: ")[1].strip() == "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>"
        for s in schemas
    )


@pytest.mark.parametrize("name", ["mart_city_sales", "mart_city_delivery", "mart_vip_cities", "mart_product_performance", "mart_valid_addresses"])
def test_as_of_bounds_reach_the_scans_of_registered_marts(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line and "exp_date" in line]
    assert pushed and all("LessThanOrEqual(beg_date,2000-05-31)" in x and "GreaterThan(exp_date,2000-05-31)" in x for x in pushed)


def simple_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def at_scale(spark):
    """No broadcast by size, as where both sides are large."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def shuffles(df) -> int:
    return simple_plan(df).count("Exchange hashpartitioning")


def test_column_upsert_scans_each_load_once(spark):
    text = plan(E.queries()["upsert_column"](spark, SF_SMALL))
    assert text.count("lineitem.parquet") == 2


def test_vip_cities_moves_the_orders_once(spark, at_scale):
    text = simple_plan(E.queries()["mart_vip_cities"](spark, SF_SMALL))
    # one exchange of the orders by customer serves the join and the distinct
    assert "Exchange hashpartitioning(customerId" in text
    assert text.count("orders.parquet") == 1


def test_city_sales_moves_the_lines_once_where_items_are_broadcast(spark):
    w = Warehouse(spark, SF_SMALL)
    lines = w._stored("fct_orderdetails", ("lineitem",), lambda: w.fct_orderdetails)
    orders = w._stored("fct_orders", ("orders",), lambda: w.fct_orders)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from pyspark.sql import functions as F

        df = marts.city_sales(orders, w.dim_addresses, lines, F.broadcast(w.dim_items), REPORT_DATE)
        text = simple_plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("Exchange hashpartitioning(orderId") == 2  # orders and lines, each once
    assert "hint" not in text


def test_row_reconciliation_moves_no_keys(spark):
    assert shuffles(E.queries()["reconcile_counts"](spark, SF_SMALL)) <= 2  # those of its own source


def test_registered_flagship_moves_the_lines_once(spark, at_scale):
    """Roll-up and join to the orders share one shuffle of the lines by order."""
    lines = simple_plan(E.queries()["mart_city_sales"](spark, SF_SMALL)).splitlines()
    at = next(k for k, x in enumerate(lines) if "l_orderkey" in x and "FileScan" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    above, level = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < level:
            level = depth(x)
            above.append(x)
            if "SortMergeJoin [orderId" in x:
                break
    assert sum("Exchange" in x for x in above) == 1


def test_column_upsert_shuffles_each_load_once(spark, at_scale):
    assert shuffles(E.queries()["upsert_column"](spark, SF_SMALL)) == 2
