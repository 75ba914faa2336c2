import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import piecewise_hash as ph


def plain_fingerprint(text):
    """One code point at a time."""
    points = [ord(c) for c in text]
    if not points:
        return "1::"
    size = 1
    while len(points) > 96 * size:
        size *= 2

    def ends_chunk(i, size):
        h = sum(points[i - k] * int(ph.FACTORS[k]) for k in range(ph.CONTEXT) if i >= k) % 2**32
        h ^= h >> 16
        h = h * int(ph.MIX[0]) % 2**32
        h ^= h >> 15
        h = h * int(ph.MIX[1]) % 2**32
        h ^= h >> 16
        return h % size == 0

    def signs(size):
        out, chunk = "", ""
        for i, c in enumerate(text):
            chunk += c
            enough = len(chunk) >= max(size // 2, 1)
            if enough and ends_chunk(i, size) or len(chunk) == 4 * size or i == len(text) - 1:
                h = zlib.crc32(chunk.encode("utf-32-le", "surrogatepass"))
                h = (h ^ h >> 12) % 4096
                out, chunk = out + ph.SIGNS[h // 64] + ph.SIGNS[h % 64], ""
        return out

    return f"{size}:{signs(size)}:{signs(2 * size)}"


def plain_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        here = [i]
        for j, y in enumerate(b, 1):
            here.append(min(before[j] + 1, here[-1] + 1, before[j - 1] + (x != y)))
        before = here
    return before[-1]


def plain_likeness(one, other):
    if one == other:
        return 1.0
    found = [0.0]
    for i in (1, 2):
        for j in (1, 2):
            a, b = one.split(":"), other.split(":")
            x, y = ([v[k : k + 2] for k in range(0, len(v), 2)] for v in (a[i], b[j]))
            if int(a[0]) * i == int(b[0]) * j and x and y:
                found.append(1 - plain_distance(x, y) / max(len(x), len(y)))
    return max(found)


def brute(rows):
    """The contract, on sorted (doc_id, text) rows."""
    rows = [(i, t or "") for i, t, *_ in rows]
    rows.sort(key=lambda r: hashlib.sha256(r[1].encode()).hexdigest())
    rows.sort(key=lambda r: -(2**70) if r[0] is None else r[0], reverse=True)
    out = []
    for at, (doc_id, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = (plain_fingerprint(t) for t in (text, changed, following))
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, plain_likeness(a, b), plain_likeness(a, c)))
    return out


def shown(rows):
    return sorted((*r[:5], *(round(v, 12) for v in r[5:])) for r in ((str(r[0]), *r[1:]) for r in rows))


@pytest.fixture
def run(tmp_path):
    def go(df, name="t"):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = ph.op11_document_fingerprints(df.sparkSession, f"{tmp_path}/{name}")
        assert out.columns == ph.NAMES
        return shown(tuple(r) for r in out.collect())

    return go


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(900)}" for _ in range(words))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=400), st.text(alphabet="ab", max_size=300))
def test_fingerprint_against_plain_loops(one, other):
    for text in (one, other, one + other * 3):
        assert ph.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_long_texts_in_spans(monkeypatch):
    texts = [prose(1, 5_000), "aaa " * 3_000, "x" * 7_000, "\U0001f600é" * 2_000]
    whole = [ph.fingerprint(t) for t in texts]
    monkeypatch.setattr(ph, "SPAN", 1_000)
    assert [ph.fingerprint(t) for t in texts] == whole == [plain_fingerprint(t) for t in texts]
    assert all(len(part) <= 2 * (2 * ph.CHUNKS + 1) for f in whole for part in f.split(":"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=80), st.lists(st.integers(0, 4), max_size=80))
def test_distance_against_the_table(a, b):
    assert ph.distance(a, b) == plain_distance(a, b)


def test_a_small_edit_moves_few_signs_and_unrelated_texts_share_few():
    for seed in range(30):
        text = prose(seed, 800)
        at = 100 * (seed % 9) + 300
        assert ph.likeness(ph.fingerprint(text), ph.fingerprint(text[:at] + " an inserted phrase " + text[at:])) > 0.85
        assert ph.likeness(ph.fingerprint(text), ph.fingerprint(text + text)) > 0.4  # at half the block size
        assert ph.likeness(ph.fingerprint(text), ph.fingerprint(prose(seed + 1000, 800))) < 0.15


def test_against_brute_force(run, documents):
    rows = [(i, prose(i, 7 * i)) for i in range(60)]
    rows += [(2**53 + 1, "a"), (2**53 + 3, "b"), (2**63 - 1, "c é"), (None, "d"), (None, None), (3, "again"), (-7, ""), (61, " ")]
    df = documents(rows, extra=["fingerprint", "first_text", "part", "spread", "edited_sha256"])
    assert run(df, "many") == shown(brute(rows))
    assert run(df.coalesce(1), "one") == shown(brute(rows))


def test_repeated_rows_one_row_and_no_rows(run, documents):
    rows = [(5, "same text here")] * 40 + [(6, "other")] * 3
    assert run(documents(rows), "same") == shown(brute(rows))
    assert run(documents([(1, "alone, " * 20)]), "one") == shown(brute([(1, "alone, " * 20)]))
    assert run(documents([]), "none") == []


def test_very_long_text(run, documents):
    rows = [(1, prose(3, 60_000)), (2, "short one"), (3, "z" * 200_000)]
    assert run(documents(rows)) == shown(brute(rows))


def test_whole_table(run, whole):
    rows = [(r["doc_id"], r["text"]) for r in whole.collect()]
    assert run(whole) == shown(brute(rows))


def test_columns_of_fingerprints_and_likeness(spark):
    df = spark.createDataFrame([("one two three " * 9, "x"), (None, "x")], "text string, fingerprint2 string")
    found = ph.fingerprints(df).withColumn("near", ph.likeness_of(F.col("fingerprint"), F.lit("1::"))).collect()
    assert [r["fingerprint"] for r in found] == [ph.fingerprint("one two three " * 9), "1::"]
    assert [r["near"] for r in found] == [0.0, 1.0]


def test_rolling_hash_sees_its_context_only():
    a, b = (np.array([ord(c) for c in t], dtype=np.uint32) for t in ("xyz common", "ab common"))
    assert (ph.rolling(a)[-1], len(b)) == (ph.rolling(b)[-1], 9)
