import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm.substring_dedup import AGAIN_BIT, WINDOW, _WordHash, dedup_substrings, runs, words_of

NOISE = ["rid", "row_key", "unknown", "counts", "packed", "text_key", "bucket", "packed", "start", "kept", "run"]


def brute(rows, window=WINDOW):
    """rows: (doc_id, text); a null id is after all others."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    first, out = {}, {}
    for k in order:
        words = words_of(rows[k][1])
        for i in range(len(words) - window + 1):
            at = first.setdefault(tuple(words[i : i + window]), (rows[k][0], i))
            if at[0] == rows[k][0]:  # rows that share an id: the earliest start of any
                first[tuple(words[i : i + window])] = (at[0], min(at[1], i))
    for k in order:
        words = words_of(rows[k][1])
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] != (rows[k][0], i):
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[k] = (rows[k][0], len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=str)


def result(docs, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in dedup_substrings(docs, **options).collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd", b"e"]), max_size=120))
def test_runs_cover_every_window_once_and_share_minimisers(words):
    minimiser, place = runs(words, _WordHash())
    at = 0
    by_window = {}
    for m, p in zip(minimiser.tolist(), place.tolist(), strict=True):
        start, many = p >> 32, p & (AGAIN_BIT - 1)
        assert start == at and many > 0
        at += many
        inside = [tuple(words[i : i + WINDOW]) for i in range(start, start + many)]
        for w in inside:
            assert by_window.setdefault(w, m) == m  # equal windows meet in one bucket
        if len(set(inside)) < len(inside):
            assert p & AGAIN_BIT
    assert at == max(0, len(words) - WINDOW + 1)


def corpus():
    chance = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(chance.choice(vocabulary, 70))
    rows = []
    for k in range(60):
        text = " ".join(chance.choice(vocabulary, chance.integers(0, 150)))
        if k % 3 == 0:
            text = f"{text} {passage} tail{k}"
        if k % 10 == 7:
            text = rows[k - 5][1] + " more"
        rows.append((1000 - k, text))
    rows += [(7, "the " * 300), (8, "a b " * 100 + "c"), (9, "x\ty\nz\x0b" * 40), (2, None), (3, ""), (4, "short text"), (5, "é\x85\xa0ü " * 30)]
    return rows


@pytest.mark.parametrize("heavy", [16_384, 30, 3, 1])
def test_equals_brute_force(documents, heavy):
    rows = corpus()
    assert result(documents(rows, NOISE), heavy=heavy) == brute(rows)


def test_defined_cases(documents):
    same = " ".join(f"u{k}" for k in range(40))
    rows = [(None, same), (5, same + " end"), (1, "w " * 50_000)]
    assert result(documents(rows)) == brute(rows)
    # rows that repeat a doc_id aren't earlier than each other
    twice = dedup_substrings(documents([(5, same), (5, same), (6, same)])).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_removed, r.kept) for r in twice] == [(5, 0, same), (5, 0, same), (6, 40, "")]
    assert dedup_substrings(documents([])).count() == 0


def test_hot_passage(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit(passage + " z"), F.col("id"))).otherwise(F.concat(F.lit("own "), F.col("id"))).alias("text"))
    for heavy in (16_384, 50, 2):
        got = dedup_substrings(docs, heavy=heavy).where("n_removed > 0").agg(F.count("*"), F.min("n_removed"), F.max("n_removed")).first()
        assert tuple(got) == (299, 60, 60)


@pytest.mark.parametrize("heavy", [16_384, 3])
def test_rows_that_share_an_id_have_places_of_their_own(documents, heavy):
    rows = [(7 if k % 2 else None, text) for k, (_, text) in enumerate(corpus()[:40])]
    rows = [r for r in rows if r[0] is not None]  # the order of null ids is that of a hash
    assert result(documents(rows), heavy=heavy) == brute(rows)
