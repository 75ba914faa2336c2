from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.common import DOCUMENT_COLUMNS, n_words
from strata.llm.exact_dedup import exact_dedup
from strata.llm.quality import THRESHOLD, score_udf, train
from strata.llm.registry import ORACLES, QUERIES
from strata.llm.simhash_dedup import fingerprint
from tests.llm.test_simhash_dedup import roots

SF = "/root/testdata/sf0.001"


def by_hand(spark):
    """Each stage's documents by plain Python over what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = score_udf(train(docs, labels))
    good = docs.where(score("text") >= THRESHOLD).collect()
    groups = defaultdict(list)
    for r in good:
        groups[b"".join((r.text or "").encode().split())].append(r)
    unique = sorted((min(g, key=lambda r: (-len(r.text or ""), r.doc_id)) for g in groups.values()), key=lambda r: r.doc_id)
    fps = [fingerprint(r.text) for r in unique]
    links = [(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 2]
    near = [r for k, r in enumerate(unique) if roots(len(unique), links)[k] == k]
    return good, unique, near


def test_stages_equal_plain_python(spark):
    good, unique, near = by_hand(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == DOCUMENT_COLUMNS
        kept.append(docs.collect())
        docs = spark.createDataFrame(kept[-1], docs.schema)
    for got, expected in zip(kept, (good, unique, near), strict=False):
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in expected)
    mixed = kept[3]
    copies = defaultdict(int)
    for r in mixed:
        copies[r.doc_id] += 1
    assert set(copies) <= {r.doc_id for r in near} and max(copies.values()) <= 2
    total = sum(len((r.text or "").encode().split()) for r in near)
    assert sum(len((r.text or "").encode().split()) for r in mixed) <= total * 1.5


def test_run_packs_what_the_stages_kept(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    used = defaultdict(list)
    for r in out:
        used[r.sequence_id].append((r.offset, r.length))
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_take_odd_tables(spark, documents, tmp_path):
    """Nulls, empty texts, repeated rows and extra columns; then no rows at all."""
    spark.createDataFrame([(3, 1), (4, 0), (None, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, None), (1, None), (2, ""), (None, "a b"), (3, "a b c d"), (3, "a b c d"), (4, "A b c  d", None, None), (5, "x " * 30_000)]
    docs = documents(rows, ["row", "fp", "copies", "nth", "shuffle", "rank"])
    for table in (docs, documents([])):
        for _, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, str(tmp_path))
            table.collect()


def test_names_of_the_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_dedup", "mix_sources", "best_fit_packing"]


def test_word_counts(spark):
    texts = [None, "", " ", "a", " a b\t\nc\x0b\x0cd\r", "x\x85y \xa0", "a " * 1000]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").select("k", n_words(F.col("text")).alias("n")).collect()
    assert {r.k: r.n for r in got} == {k: len((t or "").encode().split()) for k, t in enumerate(texts)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(rel.fetchall())


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert exact_dedup.__doc__
