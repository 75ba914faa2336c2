"""As-of join by the fact's own date, against a loop over all versions."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.asof import as_of_join_by_date, date_edges

DAY = dt.date(2020, 1, 1)
DIM = "id long, v string, w int, beg_date date, exp_date date"
FACT = "n long, k long, day date"


def day(i):
    return None if i is None else DAY + dt.timedelta(days=i)


def history(rng, keys):
    rows = []
    for k in keys:
        at = rng.randrange(0, 10)
        while at < 60:
            end = at + rng.randrange(1, 15)
            rows.append((k, f"{k}@{at}", at, day(at), dt.date(4444, 1, 1) if rng.random() < 0.1 else day(end)))
            if rows[-1][4].year == 4444:
                break
            at = end + rng.choice((0, 0, 0, 3))
    return rows


def brute(facts, dim, inclusive, how):
    out = []
    for n, k, d in facts:
        fits = [v for v in dim if k is not None and d is not None and v[0] == k and v[3] <= d and (d <= v[4] if inclusive else d < v[4])]
        if fits:
            best = max(fits, key=lambda v: v[3])
            out.append((n, k, d, best[1], best[2]))
        elif how == "left":
            out.append((n, k, d, None, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_rows", [1_000_000, 40, 3])
@pytest.mark.parametrize(("inclusive", "how"), [(False, "inner"), (True, "left")])
def test_against_all_versions(spark, slice_rows, inclusive, how):
    rng = random.Random(slice_rows)
    dim = history(rng, [None, *range(12)])
    facts = [(n, rng.choice([None, 1, 1, 1, 1, 2, 3, *range(15)]), day(rng.choice([None, 7, 7, 7, *range(-5, 75)]))) for n in range(600)]
    facts += facts[:50]
    f, d = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    out = as_of_join_by_date(f, d, "k", "day", {"v": "value", "w": "since"}, inclusive=inclusive, how=how, slice_rows=slice_rows)
    assert out.columns == ["n", "k", "day", "value", "since"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(facts, dim, inclusive, how)


def test_empty_tables_and_timestamps(spark):
    d = spark.createDataFrame([(1, "a", 1, day(0), day(5))], DIM)
    empty = spark.createDataFrame([], FACT)
    assert as_of_join_by_date(empty, d, "k", "day", {"v": "v"}).count() == 0
    f = spark.createDataFrame([(1, 1, dt.datetime(2020, 1, 4, 23, 59)), (2, 1, dt.datetime(2020, 1, 6))], "n long, k int, day timestamp")
    none = d.limit(0)
    assert [(r.n, r.v) for r in as_of_join_by_date(f, d, "k", "day", {"v": "v"}).collect()] == [(1, "a")]
    assert sorted((r.n, r.v) for r in as_of_join_by_date(f, none, "k", "day", {"v": "v"}, how="left").collect()) == [(1, None), (2, None)]
    with pytest.raises(ValueError, match="already has"):
        as_of_join_by_date(f, d, "k", "day", {"v": "n"})


def test_a_hot_key_is_cut_into_slices_of_its_dates(spark):
    """Half of the rows have one key, a third of them on one day: no slice holds much more than a slice's rows."""
    facts = spark.range(6_000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).cast("long").alias("k"),
        F.date_add(F.lit(DAY), F.when(F.col("id") % 3 == 0, F.lit(100)).otherwise(F.col("id") % 365).cast("int")).alias("day"),
    )
    assert date_edges(facts, "k", "day", 5_000) is None
    [row] = date_edges(facts, "k", "day", 300).collect()
    assert row.key == 1 and row.edges == sorted(row.edges) and 8 <= len(row.edges) <= 10
    assert row.edges.count(DAY + dt.timedelta(days=100)) >= 3  # the one day has slices of its own
    dim = spark.createDataFrame([(1, "old", 1, day(-10), day(150)), (1, "new", 2, day(150), dt.date(4444, 1, 1))], DIM)
    out = as_of_join_by_date(facts, dim, "k", "day", {"v": "v"}, slice_rows=300)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out = as_of_join_by_date(facts, dim, "k", "day", {"v": "v"}, slice_rows=300)
        sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 3_001 and max(sizes) <= 900  # the even ids and id 1; two or three slices may share a task


def test_no_join_of_facts_with_versions(spark):
    f, d = spark.createDataFrame([(1, 1, day(3))], FACT), spark.createDataFrame([(1, "a", 1, day(0), day(5))], DIM)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        as_of_join_by_date(f, d, "k", "day", {"v": "v"}).explain()
    assert "Join" not in buf.getvalue() and buf.getvalue().count("Exchange") == 1
