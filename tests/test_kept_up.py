"""States kept up by change sets, distinct sets, and differences, each against recomputation."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.deltas import ROWS, apply_changes, state_changes, state_of
from strata.operators.digest import bucket_digests, differences, differing_buckets
from strata.operators.distinct import distinct_counts, distinct_state, united
from strata.operators.merge import ACTION, merge, merge_actions, merge_changes

SCHEMA = "id long, g string, h string, x long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def tables(spark, seed):
    rng = random.Random(seed)

    def some(ids):
        return [(i, rng.choice(["a", "b", "c", None]), rng.choice("pqrs"), rng.choice([None, 1, 2, 30])) for i in ids]

    return spark.createDataFrame(some(range(0, 60)), SCHEMA), spark.createDataFrame(some(range(30, 80)), SCHEMA)


def measures():
    return {"total": F.col("x"), "known": F.when(F.col("x").isNotNull(), 1)}


@pytest.mark.parametrize("seed", range(3))
def test_a_state_kept_up_is_the_state_of_the_merged_table(spark, seed):
    t, s = tables(spark, seed)
    changes = merge_changes(t, s, "id")
    state = apply_changes(state_of(t, ["g"], measures()), changes, ["g"], measures())
    whole = state_of(merge(t, s, "id"), ["g"], measures())
    assert state.columns == whole.columns and rows(state) == rows(whole)
    # a second load on top
    more = spark.createDataFrame([(1, "new", "p", 5), (2, "a", "p", None)], SCHEMA)
    merged = merge(t, s, "id")
    state = apply_changes(state, merge_changes(merged, more, "id"), ["g"], measures())
    assert rows(state) == rows(state_of(merge(merged, more, "id"), ["g"], measures()))


@pytest.mark.parametrize("seed", range(3))
def test_states_on_states_count_distinct_things(spark, seed):
    t, s = tables(spark, seed)
    by_both = state_of(t, ["g", "h"], {"total": F.col("x")})
    by_g = state_of(by_both, ["g"], {"total": F.col("total")})
    moved = state_changes(by_both, merge_changes(t, s, "id"), ["g", "h"], {"total": F.col("x")})
    got = apply_changes(by_g, moved, ["g"], {"total": F.col("total")})
    want = merge(t, s, "id").groupBy("g").agg(F.count_distinct("h").alias(ROWS), F.coalesce(F.sum("x"), F.lit(0)).alias("total"))
    assert rows(got) == rows(want)


def test_changes_are_the_old_and_new_rows_of_what_a_merge_changes(spark):
    t = spark.createDataFrame([(1, "a", "p", 1), (2, "b", "p", 2), (3, "c", "p", 3)], SCHEMA)
    s = spark.createDataFrame([(1, "a", "p", 1), (2, "b", "p", 5), (9, "z", "p", None)], SCHEMA)
    assert rows(merge_changes(t, s, "id")) == sorted([(2, "b", "p", 2, -1), (2, "b", "p", 5, 1), (9, "z", "p", None, 1)], key=str)
    assert rows(merge_changes(t, s, "id", when_changed=lambda a, b: a("x") > b("x"))) == [(9, "z", "p", None, 1)]
    assert merge_changes(t, s.limit(0), "id").count() == 0
    done = {r.id: r[ACTION] for r in merge_actions(t, s, "id", when_changed="x").collect()}
    assert done == {1: "keep", 2: "update", 3: "absent", 9: "insert"}


def test_a_group_without_rows_leaves_and_an_empty_state_starts(spark):
    t = spark.createDataFrame([(1, "a", "p", 1)], SCHEMA)
    s = spark.createDataFrame([(1, "b", "p", 1)], SCHEMA)
    state = apply_changes(state_of(t, ["g"], measures()), merge_changes(t, s, "id"), ["g"], measures())
    assert rows(state) == [("b", 1, 1, 1)]
    empty = state_of(t.limit(0), ["g"], measures())
    assert rows(apply_changes(empty, merge_changes(t.limit(0), s, "id"), ["g"], measures())) == [("b", 1, 1, 1)]


def test_distinct_sets_add_up(spark):
    ids = [None, 0, 1, -1, -32768, 32768, 32769, 2**31, 2**62, *range(0, 100_000, 997)]
    data = [(k % 5, k % 2, i) for k in range(5) for i in ids[k:] for _ in range(2)]
    df = spark.createDataFrame(data, "m int, g int, id long")
    state = distinct_state(df, ["m", "g"], "id")
    for grain in (["m", "g"], ["m"], ["g"], []):
        want = df.groupBy(*grain).agg(F.count_distinct("id").alias("n"))
        assert rows(distinct_counts(state, grain, "n")) == rows(want)
    assert rows(distinct_counts(united(state, ["m"]), [], "n")) == rows(df.agg(F.count_distinct("id")))
    assert distinct_state(df.limit(0), ["m"], "id").count() == 0


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_differences_against_bags(spark, buckets):
    rng = random.Random(buckets)
    source = [(i % 90 if i % 11 else None, rng.choice("ab"), "p", rng.choice([None, 1])) for i in range(200)]
    target = [r for r in source if rng.random() < 0.9] + [(500, "a", "p", 1), (7, "a", "q", 1)]
    target = [(i, g, h, x if rng.random() < 0.95 else 77) for i, g, h, x in target]
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA).repartition(3)
    want = []
    for key in {r[0] for r in source + target}:
        a, b = (sorted((r for r in side if r[0] == key), key=str) for side in (source, target))
        if a != b:
            want.append((key, "missing" if not b else "extra" if not a else "changed", len(a), len(b)))
    assert rows(differences(s, t, "id", buckets=buckets)) == sorted(want, key=str)
    stored = bucket_digests(t, "id", sorted(SCHEMA.replace(" long", "").replace(" string", "").split(", ")), buckets)
    assert rows(differences(s, t, "id", buckets=buckets, target_digests=stored)) == sorted(want, key=str)


def test_only_rows_of_differing_buckets_are_read_again(spark):
    s = spark.range(10_000).select("id", F.lit("v").alias("g"), F.lit("w").alias("h"), F.col("id").alias("x"))
    t = s.withColumn("x", F.when(F.col("id") == 1234, -1).otherwise(F.col("x")))
    found = differing_buckets(bucket_digests(s, "id"), bucket_digests(t, "id"))
    assert len(found) == 1
    assert rows(differences(s, t, "id")) == [(1234, "changed", 1, 1)]
    assert differences(s, s.repartition(3), "id").count() == 0 and differences(s.limit(0), t.limit(0), "id").count() == 0
    # swapped values within a row, and between rows, are differences
    a = spark.createDataFrame([(1, "p", "q", 1), (2, "r", None, 1)], SCHEMA)
    b = spark.createDataFrame([(1, "q", "p", 1), (2, None, "r", 1)], SCHEMA)
    assert [r[1] for r in rows(differences(a, b, "id"))] == ["changed", "changed"]
