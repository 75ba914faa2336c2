"""Late loads: the table that the loads give in order, and hand-written cases."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.errors import PySparkException

from strata.functions.dates import BEGINNING, OPEN_END
from strata.operators.scd2 import scd2_apply, scd2_seed
from strata.operators.splice import scd2_replay, scd2_splice
from strata.session import cut_lineage

SCHEMA = "id long, v string"
D = [dt.date(2024, m, 1) for m in range(1, 13)]


def rows(df):
    return sorted(((r.id, r.v, r.beg_date, r.exp_date) for r in df.collect()), key=str)


def in_order(spark, loads):
    table = scd2_seed(spark.createDataFrame(loads[0][1], SCHEMA))
    for day, load in loads[1:]:
        table = cut_lineage(spark, scd2_apply(table, spark.createDataFrame(load, SCHEMA), day))
    return table


@pytest.mark.parametrize("seed", range(4))
def test_loads_of_all_ids_in_any_order_give_the_table_of_their_order(spark, seed):
    rng = random.Random(seed)
    loads = [(D[i], [(k, rng.choice("ab")) for k in (None, 1, 2, 3, 4)]) for i in range(5)]
    late = rng.choice([p for p in itertools.permutations(range(1, 5)) if p != (1, 2, 3, 4)])
    table = scd2_seed(spark.createDataFrame(loads[0][1], SCHEMA))
    applied = [0]
    for i in late:
        later = [D[k] for k in applied if k > i]
        table = cut_lineage(spark, scd2_splice(table, spark.createDataFrame(loads[i][1], SCHEMA), D[i], min(later, default=None)))
        applied.append(i)
    assert rows(table) == rows(in_order(spark, loads))


@pytest.mark.parametrize("seed", range(2))
def test_the_latest_load_is_scd2_apply(spark, seed):
    rng = random.Random(seed)
    loads = [(D[i], [(k, rng.choice("abc")) for k in range(8) if rng.random() < 0.7]) for i in range(3)]
    table = in_order(spark, loads[:2])
    load = spark.createDataFrame(loads[2][1], SCHEMA)
    assert rows(scd2_splice(table, load, D[2])) == rows(scd2_apply(table, load, D[2]))
    again = cut_lineage(spark, scd2_splice(table, load, D[2]))
    assert rows(scd2_splice(again, load, D[2])) == rows(again)


@pytest.mark.parametrize("seed", range(4))
def test_replay_is_the_loads_one_after_the_other(spark, seed):
    rng = random.Random(seed)
    loads = [(D[i], [(k, rng.choice("ab")) for k in (None, *range(7)) if rng.random() < 0.7]) for i in range(5)]
    mixed = [(k, v, day) for day, load in loads for k, v in load]
    rng.shuffle(mixed)
    got = scd2_replay(spark.createDataFrame(mixed, SCHEMA + ", loaded date"), "loaded")
    assert rows(got) == rows(in_order(spark, loads))


def table(spark, versions):
    seeded = scd2_seed(spark.createDataFrame([(k, v) for k, v, *_ in versions], SCHEMA)).collect()
    hashes = {(r.id, r.v): r.hash for r in seeded}
    return spark.createDataFrame([(k, v, hashes[k, v], b, e) for k, v, b, e in versions], SCHEMA + ", hash string, beg_date date, exp_date date")


def spliced(spark, versions, load, day, until=None):
    return rows(scd2_splice(table(spark, versions), spark.createDataFrame(load, SCHEMA), day, until))


def test_a_version_is_cut_in_three(spark):
    assert spliced(spark, [(1, "a", BEGINNING, OPEN_END)], [(1, "b")], D[3], D[5]) == [
        (1, "a", BEGINNING, D[3]), (1, "a", D[5], OPEN_END), (1, "b", D[3], D[5])
    ]


def test_neighbours_with_the_same_values_become_one_version(spark):
    versions = [(1, "a", BEGINNING, D[3]), (1, "b", D[3], D[6]), (1, "c", D[6], OPEN_END)]
    # a correction of the day a version began on, to what was valid before
    assert spliced(spark, versions, [(1, "a")], D[3], D[6]) == [(1, "a", BEGINNING, D[6]), (1, "c", D[6], OPEN_END)]
    # a late load that already tells what the next version has
    assert spliced(spark, versions, [(1, "c")], D[4], D[6]) == [(1, "a", BEGINNING, D[3]), (1, "b", D[3], D[4]), (1, "c", D[4], OPEN_END)]
    # both at once
    versions = [(1, "a", BEGINNING, D[3]), (1, "b", D[3], D[6]), (1, "a", D[6], OPEN_END)]
    assert spliced(spark, versions, [(1, "a")], D[3], D[6]) == [(1, "a", BEGINNING, OPEN_END)]
    # the same values change nothing
    assert spliced(spark, versions, [(1, "b")], D[4], D[6]) == versions[:1] + [versions[2], versions[1]]


def test_ids_that_are_closed_or_unknown_on_the_day(spark):
    versions = [(1, "a", BEGINNING, D[1]), (1, "z", D[8], OPEN_END), (2, "b", BEGINNING, D[2])]
    assert spliced(spark, versions, [(1, "m"), (2, "n"), (3, "new")], D[4], D[6]) == sorted(
        [*versions, (1, "m", D[4], D[6]), (2, "n", D[4], D[6]), (3, "new", BEGINNING, OPEN_END)], key=str
    )
    assert spliced(spark, versions, [(1, "m")], D[4], None) == sorted([*versions, (1, "m", D[4], D[8])], key=str)


def test_a_load_that_is_refused(spark):
    t = table(spark, [(1, "a", BEGINNING, OPEN_END)])
    with pytest.raises(ValueError, match="after the load"):
        scd2_splice(t, spark.createDataFrame([(1, "b")], SCHEMA), D[3], D[3])
    with pytest.raises(PySparkException):
        scd2_splice(t, spark.createDataFrame([(1, "b"), (1, "c")], SCHEMA), D[3]).collect()


def test_empty_tables(spark):
    t = table(spark, [(1, "a", BEGINNING, OPEN_END)])
    none = spark.createDataFrame([], SCHEMA)
    assert rows(scd2_splice(t, none, D[3])) == rows(t)
    assert rows(scd2_splice(t.limit(0), spark.createDataFrame([(1, "b")], SCHEMA), D[3], D[4])) == [(1, "b", BEGINNING, OPEN_END)]
    assert scd2_replay(spark.createDataFrame([], SCHEMA + ", loaded date"), "loaded").count() == 0
