"""Vector code compression: product codes whose nearest entries are found by an integer Walsh-Hadamard transform.

Vectors become integers, are cut into ``PARTS`` equal parts and every part is
replaced by the number of its nearest codebook entry. Parts and entries, filled
up with zeros to a power of two, are transformed by the Walsh-Hadamard matrix,
which only adds and subtracts: d times the squared distance is the sum of
squared differences of the d coefficients. These are summed in sequency order,
and an entry is given up as soon as its sum passes the distance of one that is
known. All of it are integers, so ties are ties.

Rows stay in their partition. A round of training sends one partial sum for
each part, entry and partition; the driver holds the codebooks, whose size
follows from the parameters and the vectors' length alone.

Defined cases: a row whose vector is null, or holds a null or a component that is
not finite, takes no part; a null id or label does. Repeated ids are rows of their
own; the first entries come in the order of id (nulls last), then of the vector.
Vectors count as filled up with zeros to the longest one, and that to a multiple
of ``PARTS``. Fewer rows than entries give fewer entries. Components of any size
are exact; an error that a long can't hold stops the run. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
ROWS = 4096  # rows of which a task compares all entries at a time
EXACT = 2**53  # floats beyond are whole numbers


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))


def whole_numbers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as Python's integers where floats would round; ``scale`` is a power of two."""
    x = x.astype(np.float64)
    if np.abs(x).max(initial=0.0) < EXACT / scale:
        return np.floor(x * scale).astype(np.int64)
    flat = [int(v) * scale if abs(v) >= EXACT else int(v * scale // 1) for v in x.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(x.shape)


def walsh(width: int) -> np.ndarray:
    """The Walsh-Hadamard matrix for parts of ``width``: rows in sequency order (sign changes), columns for the part alone."""
    h = np.ones((1, 1), dtype=np.int64)
    while h.shape[0] < width:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable"), :width]


def _fits(*arrays: np.ndarray, matrix: np.ndarray) -> bool:
    """Whether sums of squared differences of coefficients stay within a long."""
    largest = max((int(np.abs(a).max(initial=0)) for a in arrays), default=0)
    return 4 * len(matrix) ** 3 * largest**2 < 2**62


def nearest(parts: np.ndarray, entries: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry (the lowest of equal ones), squared distance, and how many squared differences were summed up."""
    kind = np.int64 if _fits(parts, entries, matrix=matrix) else object
    x, e = (a.astype(kind) @ matrix.T.astype(kind) for a in (parts, entries))
    sums = (x[:, :1] - e[None, :, 0]) ** 2
    rows, which = np.divmod(np.arange(sums.size), len(e))
    sums, known, summed = sums.ravel(), None, sums.size
    for c in range(1, x.shape[1] + 1):
        # an entry that is least so far bounds what the nearest one can be at
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        least = np.minimum.reduceat(sums, first)
        if c == x.shape[1]:
            break
        equal = np.flatnonzero(sums == np.repeat(least, np.diff(np.append(first, len(rows)))))
        lowest = which[equal[np.append(True, rows[equal[1:]] != rows[equal[:-1]])]]
        apart = ((x - e[lowest]) ** 2).sum(axis=1)
        summed += x.size
        known = apart if known is None else np.minimum(known, apart)
        left = (sums <= known[rows]).astype(bool)
        rows, which, sums = rows[left], which[left], sums[left]
        sums = sums + (x[rows, c] - e[which, c]) ** 2
        summed += len(rows)
    equal = np.flatnonzero(sums == np.repeat(least, np.diff(np.append(first, len(rows)))))
    lowest = equal[np.append(True, rows[equal[1:]] != rows[equal[:-1]])]
    return which[lowest], least // len(matrix), summed


class Codebooks:
    """For each part the integer entries, an array of parts x entries x width."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.matrix = walsh(entries.shape[2])

    @property
    def length(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def numbers(self, batch: pa.RecordBatch, column: str) -> np.ndarray:
        """The batch's vectors as whole numbers, rows x parts x width."""
        vectors = batch.column(column)
        sizes = np.diff(np.asarray(vectors.offsets))
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        parts, _, width = self.entries.shape
        if len(sizes) and (sizes == self.length).all():
            full = flat.reshape(len(sizes), self.length)
        else:
            full = np.zeros((len(sizes), self.length))
            full[np.arange(self.length)[None, :] < sizes[:, None]] = flat
        return whole_numbers(full).reshape(len(sizes), parts, width)

    def assign(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows x parts) and the squared distances."""
        codes = np.zeros(numbers.shape[:2], dtype=np.int64)
        apart = np.zeros(numbers.shape[:2], dtype=object)
        for part, entries in enumerate(self.entries):
            for at in range(0, len(numbers), ROWS):
                rows = slice(at, at + ROWS)
                codes[rows, part], apart[rows, part], _ = nearest(numbers[rows, part], entries, self.matrix)
        return codes, apart

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    return vectors.where(usable(F.col(column)))


def first_codebooks(kept: DataFrame, column: str, by: str, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the rows with the least ids; None if there is no row."""
    longest = kept.agg(F.max(F.size(column))).first()[0]
    if longest is None:
        return None
    width = max(-(-longest // parts), 1)
    rows = kept.orderBy(F.col(by).asc_nulls_last(), column).limit(entries).select(column).collect()
    full = np.zeros((len(rows), parts * width))
    for i, row in enumerate(rows):
        full[i, : len(row[0])] = row[0]
    return Codebooks(whole_numbers(full).reshape(len(rows), parts, width).transpose(1, 0, 2))


def trained_once(kept: DataFrame, column: str, books: Codebooks) -> Codebooks:
    """Every entry becomes the floor of the mean of its parts; unused ones stay."""
    parts, entries, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width), dtype=object)
        used = np.zeros(parts * entries, dtype=np.int64)
        for batch in batches:
            numbers = books.numbers(batch, column)
            codes, _ = books.assign(numbers)
            at = (codes + np.arange(parts) * entries).ravel()
            own = np.zeros_like(total, dtype=numbers.dtype)
            np.add.at(own, at, numbers.reshape(-1, width))
            total = total + own
            used += np.bincount(at, minlength=len(used))
        some = np.flatnonzero(used)
        values = [[Decimal(v) for v in row] for row in total[some].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(used[some]), pa.array(values, pa.list_(pa.decimal128(38, 0)))], ["entry", "used", "total"])

    found = kept.select(column).mapInArrow(sums, "entry long, used long, total array<decimal(38,0)>")
    each = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]
    out = books.entries.astype(object).reshape(parts * entries, width)
    for row in found.groupBy("entry").agg(F.sum("used").alias("used"), *each).collect():  # a row for each entry
        out[row["entry"]] = [int(row[f"t{i}"]) // row["used"] for i in range(width)]
    if not _fits(out, matrix=books.matrix):
        return Codebooks(out.reshape(books.entries.shape))
    return Codebooks(out.astype(np.int64).reshape(books.entries.shape))


def train(vectors: DataFrame, column: str, by: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after so many rounds over all vectors; None if no vector is usable."""
    kept = _usable(vectors, column)
    books = first_codebooks(kept, column, by, parts, entries)
    for _ in range(rounds if books else 0):
        books = trained_once(kept, column, books)
    return books


def encode(vectors: DataFrame, column: str, books: Codebooks | None, *others: str) -> DataFrame:
    """code and error of every usable vector, beside the columns ``others``."""
    kept = _usable(vectors, column).select(*dict.fromkeys([*others, column]))
    if books is None:
        return kept.select(*others, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    digits = max(2, len(f"{books.entries.shape[1] - 1:x}"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, apart = books.assign(books.numbers(batch, column))
            text = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
            errors = pa.array([sum(row) for row in apart.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(text, pa.string()), errors], [*others, "code", "error"])

    types = ", ".join(f"`{c}` {t}" for c, t in kept.select(*others).dtypes)
    return kept.mapInArrow(coded, f"{types}, code string, error long")


def decode(codes: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """The rows with ``decoded``: the integer vector that a code stands for, as longs."""
    digits = max(2, len(f"{books.entries.shape[1] - 1:x}"))
    parts = range(len(books.entries))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(code).to_pylist()
            vectors = [None if t is None else [v for p in parts for v in books.entries[p][int(t[digits * p : digits * (p + 1)], 16)].tolist()] for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors, pa.list_(pa.int64()))], [*batch.schema.names, "decoded"])

    types = ", ".join(f"`{c}` {t}" for c, t in codes.dtypes)
    return codes.mapInArrow(decoded, f"{types}, decoded array<bigint>")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = train(vectors, "embedding", "vec_id")
    coded = written(encode(vectors, "embedding", books, "vec_id", "label"), "vector_codes")
    of_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    of_label = of_label.withColumnRenamed("label", "of")
    return coded.join(of_label, coded["label"].eqNullSafe(of_label["of"])).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256")
    )


def _round(n: int) -> str:
    """The assignment to codebook ``n`` and the codebook after it, as SQL."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT r, part, x, min({{'d': d, 'e': e}}) AS near FROM (
    SELECT p.r, p.part, p.x, c.e, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.y[i]) * (p.x[i] - c.y[i])))::BIGINT AS d
    FROM p JOIN c{n} c USING (part)) GROUP BY r, part, x),
m{n} AS (
  SELECT part, e, list(((s - (s % n + n) % n) / n)::BIGINT ORDER BY i) AS y
  FROM (SELECT part, near.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{n}, (SELECT unnest(range(1, 1 + (SELECT w FROM shape))) AS i) GROUP BY ALL)
  GROUP BY part, e),
c{n + 1} AS MATERIALIZED (SELECT c.part, c.e, coalesce(m.y, c.y) AS y FROM c{n} c LEFT JOIN m{n} m USING (part, e))"""


ORACLE = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
shape AS MATERIALIZED (SELECT ceil(max(len(embedding)) / {PARTS})::BIGINT AS w FROM v),
p AS MATERIALIZED (
  SELECT r, part, list_transform(range(part * w + 1, part * w + w + 1), lambda i: coalesce(floor({SCALE} * embedding[i]::DOUBLE), 0)::BIGINT) AS x
  FROM v, shape, (SELECT unnest(range({PARTS})) AS part)),
c0 AS MATERIALIZED (SELECT part, r AS e, x AS y FROM p WHERE r < {ENTRIES}),{_round(0)},{_round(1)},
a2 AS (
  SELECT r, part, min({{'d': d, 'e': e}}) AS near FROM (
    SELECT p.r, p.part, c.e, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.y[i]) * (p.x[i] - c.y[i])))::BIGINT AS d
    FROM p JOIN c2 c USING (part)) GROUP BY r, part),
o AS (SELECT r, string_agg(printf('%02x', near.e), '' ORDER BY part) AS code, sum(near.d)::BIGINT AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, e)) FROM c2) AS codebooks_sha256
FROM o JOIN v USING (r)
"""
