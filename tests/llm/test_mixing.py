from collections import defaultdict

import duckdb
import pytest

from strata.llm.mixing import ORACLE, mix, mixed_documents, source_targets

NOISE = ["rank", "slot", "before", "finish", "shuffle", "copies", "row"]


def water_fill(sizes, weights, num=3, den=2, cap=2):
    """Targets by the plain rule: share by weight, stop at the cap, reshare the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, full, target = sum(sizes.values()) * num / den, set(), {}
    while True:
        left = budget - sum(cap * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else left * weight[s] / total for s in names}
        above = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 100, "c": 1000}, {"a": 1000, "b": 5, "c": 5, "d": 700, None: 300}, {"z": 7}, {"a": 0, "b": 10}, {"é": 50, "z": 50, "Z": 50, "": 50, "𝄞": 900, "": 3}],
)
def test_targets_equal_the_plain_rule(spark, sizes):
    rows = [(s, n) for s, total in sizes.items() for n in ([total - 1, 1] if total else [0])]
    got = source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    expected = water_fill(sizes, (5, 2, 1))
    assert {r.source: pytest.approx(r.target) for r in got} == expected
    assert sum(r.target for r in got) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix_keeps_to_targets_and_reruns_agree(spark, whole):
    first, again = ([tuple(r) for r in mix(whole.repartition(n)).orderBy("doc_id").collect()] for n in (3, 7))
    assert first == again
    taken, target, largest, total = defaultdict(int), {}, defaultdict(int), 0
    source = {r.doc_id: r.source for r in whole.collect()}
    for doc_id, _, size, _, t, copies, words in first:
        s = source[doc_id]
        assert words == size * copies <= 2 * size
        taken[s] += words
        target[s] = t
        largest[s] = max(largest[s], size)
        total += size
    assert total * 1.5 - max(largest.values()) <= sum(taken.values()) <= total * 1.5
    for s in target:
        assert taken[s] >= target[s] - largest[s]


def test_sql_agrees(spark, whole):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    expected = sorted(con.execute(ORACLE).fetchall())
    got = sorted(tuple(r) for r in mix(whole).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == expected


def test_defined_cases(documents):
    rows = [(1, "a b c", "en", None), (2, None, "en", None), (3, "", "en", "x"), (4, "d e", "en", "x"), (4, "d e", "en", "x"), (None, "f", "en", "x"), (5, "w " * 100_000, "en", "y")]
    docs = documents(rows, NOISE)
    got = mix(docs)
    assert got.count() == len(rows)
    assert all(r.copies <= 1 for r in got.collect() if not r.size)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    assert out.count() == got.agg({"copies": "sum"}).first()[0]
    assert mix(documents([])).count() == 0
    assert mixed_documents(documents([])).count() == 0
    assert [r.taken for r in mix(documents([(1, None), (2, " ")])).collect()] == [0, 0]


def test_hot_rows_follow_each_other(documents):
    """Equal rows, a third of all, are taken as if each had a place of its own."""
    rows = [(None, "a b c d", "en", "s1")] * 60 + [(k, "w " * (k % 9), "en", ("s1", "s2", None)[k % 3]) for k in range(120)]
    out = mix(documents(rows)).collect()
    assert len(out) == 180
    hot = [r for r in out if r.doc_id is None]
    assert len(hot) == 60 and {r.size for r in hot} == {4} and {r.taken for r in hot} <= {0, 4, 8}
    by_source = {}
    for r in out:
        by_source.setdefault((r.source_size, r.target), []).append(r.taken)
    for (size, target), taken in by_source.items():
        assert abs(sum(taken) - target) <= 2 * 9 and sum(taken) <= 2 * size
