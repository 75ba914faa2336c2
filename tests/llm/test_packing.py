import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.packing import WordIds, pack, plan_slots, word_tokenizer_path


def reference(texts):
    full = Tokenizer.from_file(word_tokenizer_path())
    return [np.array([*full.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for t in texts]


def best_fit(lengths, size):
    """One by one: into the fullest sequence with room."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= n
        else:
            free.append(size - n)
    return len(free)


HARD = [
    "It's the dog's, they'LL don't!! 12345 x2y", "ÄÖÜ straße ß éÉ İstanbul Σίσυφος ΟΔΟΣ", "a\x1cb c\x85d e\xa0f g h", "<|endoftext|> a<|startoftext|>b <|x|>", "é ñ ﬁ ﬂ Å",
    "汉字 かな 한국어 emoji 😀👍🏽", "a.,b ...,, *** $$$ word*** (word) \"q\" a_b _", "tab\tnew\nline\x0bv\x0cf\rr", "'s 't 're abc's' ''", "×÷ª º µ x×y", "ABC!!", "…—word—",
]


def test_word_ids_equal_the_tokenizer():
    ids = WordIds(word_tokenizer_path())
    for text, expected in zip(HARD, reference(HARD), strict=True):
        assert b"".join(ids[w] for w in text.encode().split()) == expected[:-1].tobytes(), text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_word_ids_equal_the_tokenizer_on_any_text(text):
    got = b"".join(_IDS[w] for w in text.encode("utf-8", "ignore").split())
    assert got == reference([text.encode("utf-8", "ignore").decode()])[0][:-1].tobytes()


_IDS = WordIds(word_tokenizer_path())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120), st.sampled_from([64, 100]))
def test_plan_is_best_fit(lengths, size):
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    used = defaultdict(list)
    for length, first, many, each, sequence, offset in plan_slots(dict(counts), size):
        for k in range(many):
            used[sequence + k // each].append((offset + k % each * length, length))
        assert first + many <= counts[length]
    assert sorted(n for slots in used.values() for _, n in slots) == sorted(lengths)
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= size
    assert len(used) == best_fit(lengths, size)


def check(docs, rows):
    pieces = pack(docs, word_tokenizer_path()).collect()
    ids = reference([t for _, t in rows])
    expected = sorted((str(d), k // 2048, k, len(x[k : k + 2048]), zlib.crc32(x[k : k + 2048].tobytes())) for (d, _), x in zip(rows, ids, strict=True) for k in range(0, len(x), 2048))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == expected
    used = defaultdict(list)
    for r in pieces:
        used[r.sequence_id].append((r.offset, r.length))
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(used) == best_fit([r.length for r in pieces], 2048)


def test_whole_table(whole):
    check(whole, [(r.doc_id, r.text) for r in whole.select("doc_id", "text").collect()])


def test_defined_cases(documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (None, "two three"), (5, "word " * 2047), (6, "word " * 2048), (7, "word " * 9000), *((100 + k, "same") for k in range(300))]
    check(documents(rows, ["rank", "length", "piece", "_slot", "each", "at"]), rows)
    assert pack(documents([]), word_tokenizer_path()).count() == 0


def test_hot_rows_are_placed_as_one(spark):
    """Nine of ten rows are equal, without id and text: they take neighbouring places, none twice."""
    docs = spark.range(3_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("word "), F.col("id"))).alias("text"))
    rows = pack(docs, word_tokenizer_path(), max_tokens=64).collect()
    assert len(rows) == 3_000 and sum(r.doc_id is None for r in rows) == 2_700
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) == best_fit([r.length for r in rows], 64)
