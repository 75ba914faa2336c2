"""The oracles tell a right operator from a wrong one: broken ones turn their queries red."""

import pytest
from pyspark.sql import functions as F

from strata.functions.dates import OPEN_END
from strata.plans import layers, queries
from strata.plans.oracle import ORACLES
from tests.conftest import SF_SMALL
from tests.test_oracle import _rows, duck  # noqa: F401

UPSERTS = ["upsert_all", "upsert_bucketed", "upsert_composite", "upsert_if_changed", "upsert_column", "runlog_jobs_upsert", "mart_new_customers_merge", "mart_orders_daily_merge"]
AS_OF = ["asof_before", "asof_dim", "asof_after", "asof_join", "mart_city_sales", "mart_product_performance", "mart_vip_cities", "mart_new_customers", "mart_city_delivery"]


def red(spark, duck, name) -> bool:  # noqa: F811
    got = queries.QUERIES[name](spark, SF_SMALL)
    rel = duck.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    order = sorted(columns)
    if sorted(got.columns) != order:
        return True
    return _rows(got.collect(), got.columns, order) != _rows(rel.fetchall(), columns, order)


@pytest.mark.parametrize("name", UPSERTS)
def test_a_merge_that_returns_its_source_is_found(spark, duck, monkeypatch, name):  # noqa: F811
    def broken(target, source, keys, **_):
        types = dict(target.dtypes)
        return source.select(*[F.col(c) if c in source.columns else F.lit(None).cast(types[c]).alias(c) for c in target.columns])

    monkeypatch.setattr(queries, "merge", broken)
    monkeypatch.setattr(layers, "merge", broken)
    assert red(spark, duck, name)


@pytest.mark.parametrize("name", ["upsert_if_changed", "upsert_bucketed", "upsert_column"])
def test_a_merge_that_ignores_its_conditions_is_found(spark, duck, monkeypatch, name):  # noqa: F811
    from strata.operators.merge import merge

    def broken(target, source, keys, **options):
        return merge(target, source, keys, **{k: v for k, v in options.items() if k in ("null_safe", "co_partitions")})

    monkeypatch.setattr(queries, "merge", broken)
    monkeypatch.setattr(layers, "merge", broken)
    assert red(spark, duck, name)


@pytest.mark.parametrize("how", ["always open", "no filter"])
@pytest.mark.parametrize("name", AS_OF)
def test_a_wrong_version_choice_is_found(spark, duck, monkeypatch, name, how):  # noqa: F811
    from strata.operators import scd2
    from strata.plans import marts

    def broken(dim, report_date, inclusive=False):
        return dim.filter(F.col("exp_date") == F.lit(OPEN_END)) if how == "always open" else dim

    for module in (scd2, queries, marts):
        monkeypatch.setattr(module, "scd2_as_of", broken)
    if (name, how) == ("asof_after", "always open"):
        pytest.skip("after the last load the open versions are the valid ones")
    assert red(spark, duck, name)


def test_an_inclusive_range_without_a_filter_is_found(spark, duck, monkeypatch):  # noqa: F811
    monkeypatch.setattr(queries, "scd2_as_of", lambda dim, day, inclusive=False: dim)
    assert red(spark, duck, "asof_inclusive")
