import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm.exact_dedup import CUT, IDENTIFIERS, chunks, exact_dedup, keep_exact, long_id, normalised, text_id, verified_identifier

NOISE = ["rank", "recipe", "keep_id", "row", "copies", "chunk", "sha"]


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (doc_id, text), n in zip(rows, norm, strict=True):
        groups[n].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return sorted(
        ((d, min(groups[n])[3], len(groups[n]), hashlib.sha256(n.encode()).hexdigest()) for (d, _), n in zip(rows, norm, strict=True)),
        key=repr,
    )


ROWS = [
    (5, "One two."), (3, "One  two."), (9, "Onetwo."), (4, None), (2, ""), (7, " \t\n"), (None, "Onetwo."), (11, "other"),
    (12, "Word. Next " * 9000), (13, "Word.  Next " * 9000), (14, "Word. Next " * 9000 + "x"), (15, "a" * 40000), (16, "a" * 20000 + " " + "a" * 20000), (17, "a" * 40001),
    (20, "one\x85two"), (21, "onetwo"),
]


def test_groups_equal_brute_force(documents):
    got = exact_dedup(documents(ROWS, NOISE)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(ROWS)
    assert {r.doc_id for r in got if r.kept} == {3, 7, 11, 13, 14, 16, 17, 20, 21}


def test_chunks_join_to_the_text_and_are_bounded(documents):
    docs = documents(ROWS).select(normalised(F.col("text")).alias("t")).select("t", chunks(F.col("t")).alias("c"))
    for r in docs.collect():
        assert "".join(r.c) == r.t
        assert all(len(x) <= 8192 for x in r.c)
    assert CUT.startswith("(?s)")


def test_an_insertion_leaves_most_chunks_alone(spark, documents):
    text = "".join(f"Sentence number {i} says {i * i}. " for i in range(4000))
    a, b = (set(r.c) for r in documents([(1, text), (2, "Inserted words here " + text)]).select(chunks(normalised(F.col("text"))).alias("c")).collect())
    assert len(a & b) > 0.9 * len(a)


def test_a_clashing_identifier_is_not_used(documents):
    docs = documents([(1, "ab"), (2, "cd"), (3, "a b")])
    weak = F.length
    assert verified_identifier(docs, (weak, text_id)) is text_id
    assert verified_identifier(docs, (weak, long_id, text_id)) is long_id
    assert verified_identifier(docs) is IDENTIFIERS[0]
    assert {r.doc_id: r.keep_id for r in exact_dedup(docs, (weak, text_id)).collect()} == {1: 3, 2: 2, 3: 3}


def test_repeated_rows_leave_one(documents):
    docs = documents([(1, "x y"), (1, "x y"), (1, "x y"), (2, "z"), (None, "z"), (None, None), (None, None)], NOISE)
    got = exact_dedup(docs)
    assert got.count() == 7
    assert got.where("kept").count() == 3
    kept = keep_exact(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text, r["rank"]) for r in kept.collect() if r.doc_id) == [(1, "x y", "clash rank"), (2, "z", "clash rank")]
    assert kept.count() == 3


def test_empty_table(documents):
    assert exact_dedup(documents([])).count() == 0
    assert keep_exact(documents([])).count() == 0


def test_hot_group_of_copies(spark, documents):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("own "), F.col("id"))).alias("text"))
    got = exact_dedup(docs).where("group_size > 1").agg(F.count("*"), F.min("group_size"), F.max("keep_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (1000, 1000, 0, 1)


@pytest.mark.parametrize("name", ["op7_exact_dedup"])
def test_no_python_in_the_plan(spark, name):
    from strata.llm.registry import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
