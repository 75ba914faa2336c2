"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of ``CONTEXT`` code points goes over the whole text; wherever it
ends in so many zero bits, a chunk ends, so a chunk's borders depend on the text
around them alone and an edit moves only those near it. Every chunk gives one
sign of the signature. The block size, a power of two, is about the length of a
chunk; a fingerprint holds the signatures at its block size and at twice that,
so two fingerprints are compared by the edit distance of their signatures where
block sizes are equal or one is twice the other.

The block size follows from the length. A chunk is half a block size long at
least and four at most, so that a text that repeats itself, where all places
trigger or none, has about as many signs as any other, and no signature is longer
than ``2 * CHUNKS + 1`` signs, whatever the text's length. A sign has 12 bits, so
texts that have nothing in common hardly share any.

The likeness is 1 less the Levenshtein distance as a share of the longer
signature; the better one where two block sizes are common; 1 for equal
fingerprints, 0 where block sizes are further apart.

Defined cases: a null text is empty. The fingerprint of the empty text has no
signs, is like itself and like no other. For the edited texts, documents follow
each other by descending doc_id (nulls last), then by the SHA-256 of the text;
a single document is its own next one. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import read_table, written

CONTEXT = 7  # code points that decide whether a chunk ends
CHUNKS = 96  # block sizes in a text, at most
SPAN = 1 << 20  # code points hashed at a time
# An odd factor for each place of the context and two for mixing.
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0x2C1B3C6D, 0x297A2D39], dtype=np.uint32)
MIX = (np.uint32(0x7FEB352D), np.uint32(0x846CA68B))
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
SIGN_BITS = 12


def rolling(points: np.ndarray) -> np.ndarray:
    """Hash of the last ``CONTEXT`` code points at each place; zeros precede the text."""
    out = points * FACTORS[0]
    for back in range(1, CONTEXT):
        out[back:] += points[:-back] * FACTORS[back]
    out ^= out >> np.uint32(16)
    out *= MIX[0]
    out ^= out >> np.uint32(15)
    out *= MIX[1]
    return out ^ (out >> np.uint32(16))


def _triggers(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash ends a chunk, and the hashes; a span of the text at a time."""
    at, hashes = [], []
    for start in range(0, len(points), SPAN):
        before = min(start, CONTEXT - 1)
        here = rolling(points[start - before : start + SPAN])[before:]
        hit = np.flatnonzero((here & np.uint32(size - 1)) == 0)
        at.append(hit + start)
        hashes.append(here[hit])
    return np.concatenate(at), np.concatenate(hashes)


def _signs(raw: memoryview, at: list[int], size: int) -> list[int]:
    """The signs of a text's chunks at this block size."""
    out, start, n = [], 0, len(raw) // 4
    while start < n:
        i = bisect_left(at, start + max(size // 2, 1) - 1)
        end = min(at[i] + 1 if i < len(at) else n, start + 4 * size, n)
        h = zlib.crc32(raw[4 * start : 4 * end])
        out.append((h ^ h >> SIGN_BITS) & (1 << SIGN_BITS) - 1)
        start = end
    return out


def _shown(signs: list[int]) -> str:
    return "".join(SIGNS[s >> 6] + SIGNS[s & 63] for s in signs)


def fingerprint(text: str) -> str:
    """``block size:signature:signature at twice the block size``."""
    raw = text.encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, dtype=np.uint32)
    n = len(points)
    if not n:
        return "1::"
    size = 1
    while n > CHUNKS * size:
        size *= 2
    at, hashes = _triggers(points, size)
    twice = at[(hashes & np.uint32(2 * size - 1)) == 0]  # they are among those of the smaller size
    view = memoryview(raw)
    return f"{size}:{_shown(_signs(view, at.tolist(), size))}:{_shown(_signs(view, twice.tolist(), 2 * size))}"


def distance(a: list, b: list) -> int:
    """Levenshtein distance, a column of the table at a time as bits of one integer."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    at: dict = {}
    for i, sign in enumerate(a):
        at[sign] = at.get(sign, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, out = full, 0, len(a)
    for sign in b:
        equal = at.get(sign, 0)
        across = (((equal & up) + up) ^ up) | equal | down
        plus = down | ~(across | up) & full
        minus = up & across
        out += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        equal |= down
        up, down = minus | ~(equal | plus) & full, plus & equal
    return out


@lru_cache(1_000)
def _parsed(shown: str) -> tuple[int, list[str], list[str]]:
    size, one, two = shown.split(":")
    return int(size), *([s[i : i + 2] for i in range(0, len(s), 2)] for s in (one, two))


def _alike(a: list[str], b: list[str]) -> float:
    return 1 - distance(a, b) / max(len(a), len(b)) if a and b else 0.0


def likeness(one: str, other: str) -> float:
    """How much two fingerprints have in common, 0 to 1."""
    if one == other:
        return 1.0
    size, signs, twice = _parsed(one)
    other_size, other_signs, other_twice = _parsed(other)
    if size == other_size:
        return max(_alike(signs, other_signs), _alike(twice, other_twice))
    if size == 2 * other_size:
        return _alike(signs, other_twice)
    if other_size == 2 * size:
        return _alike(twice, other_signs)
    return 0.0


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``fingerprint``, of the column ``text``."""
    return docs.withColumn("fingerprint", _fingerprint_column()(F.col(text)))


def likeness_of(one: Column, other: Column) -> Column:
    """The likeness of two fingerprint columns; null if one is null."""

    def each(batch_one, batch_other):
        return batch_one.combine(batch_other, lambda a, b: None if a is None or b is None else likeness(a, b)).astype("Float64")

    return F.pandas_udf(each, "double")(one, other)


def _fingerprint_column():
    def each(batch):
        return batch.map(lambda t: fingerprint(t or ""))

    return F.pandas_udf(each, "string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of the other one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [f.split()[0] for f in OUT.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
EDGE = "part long, first_text string, first_print string, last_id long, last_text string, last_print string"
EDGE_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]


def _result(doc_id: int | None, text: str, shown: str, following: str, following_print: str) -> tuple:
    changed = edited(text, following)
    changed_print = shown if changed == text else fingerprint(changed)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), sha, shown, changed_print, likeness(shown, changed_print), likeness(shown, following_print)


def _batch(rows: list[tuple], edge: tuple | None = None) -> pa.RecordBatch:
    """Results, and the first and last document of a partition as a row of its own."""
    rows = [(*r, *[None] * len(EDGE_TYPES)) for r in rows] + ([(*[None] * len(TYPES), *edge)] if edge else [])
    columns = zip(*rows, strict=True) if rows else [[]] * (len(TYPES) + len(EDGE_TYPES))
    names = [*NAMES, *(f.split()[0] for f in EDGE.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, [*TYPES, *EDGE_TYPES], strict=True)], names)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document of a sorted partition with the one behind it."""
    first = last = None
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            here = (doc_id, text, fingerprint(text))
            if last is not None:
                out.append(_result(*last, *here[1:]))
            first, last = first or here, here
        yield _batch(out)
    if first is not None:
        yield _batch([], (TaskContext.get().partitionId(), *first[1:], *last))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        out = [_result(*row) for row in rows]
        columns = zip(*out, strict=True) if out else [[]] * len(TYPES)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, TYPES, strict=True)], NAMES)


def against_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, the fingerprints of every text and its edited text, and how like they are.

    Documents are sorted by ranges, so each one meets the next within its task;
    where a task ends, the first document of the next one is looked up, one row a task.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("text_key"),
        (F.monotonically_increasing_id() % 1024).alias("spread"),
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_key")]
    # equal documents may lie in several tasks, their order is no matter
    placed = rows.repartitionByRange(*order, "spread").sortWithinPartitions(*order).select("doc_id", "text")
    found = written(placed.mapInArrow(_along, f"{OUT}, {EDGE}"), "fingerprints")
    edges = found.where("part IS NOT NULL")
    # a number for each task that had rows
    parts = edges.select("part", F.row_number().over(Window.orderBy("part")).alias("nth"))
    many = F.count(F.lit(1)).over(Window.partitionBy())
    follows = parts.select(F.col("part").alias("of"), (F.col("nth") % many + 1).alias("nth")).join(parts, "nth").select("of", F.col("part").alias("behind"))
    starts = edges.select(F.col("part").alias("behind"), "first_text", "first_print")
    ends = edges.select(F.col("part").alias("of"), "last_id", "last_text", "last_print").join(follows, "of").join(starts, "behind")
    last = ends.select("last_id", "last_text", "last_print", "first_text", "first_print").mapInArrow(_across, OUT)
    return found.where("part IS NULL").select(*NAMES).unionByName(last)


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return against_next(read_table(spark, sf_dir, "documents"))
