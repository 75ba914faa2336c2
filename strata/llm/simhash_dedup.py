"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are sorted by their rank in the reflected Gray code, so that
neighbours share leading bit patterns, and cut into pages. A node above keeps
the bits on which all its fingerprints agree: the bits of ``ones & ~zeros``
logic, stored as the AND and the OR of what lies below. The self-join walks the
tree from the root in pairs of nodes, one equi-join on the parent for a level;
a pair goes on only if the shared bits of its two nodes differ in at most
``max_bits`` places. Pairs of pages that are left meet in a task, which walks
on through smaller and smaller blocks down to fingerprints, so that every link
is found and only surviving groups are compared. Equal fingerprints are one
entry, whatever their number. Components of the links are found by
``strata.llm.components``.

Defined cases: a null text is empty; a text without words has fingerprint zero
and links like any other. Component ids ignore null doc_ids; a component in
which all are null has a null id. Rows are never merged: repeated rows come back
repeated. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import DOCUMENT_COLUMNS, read_table, written
from strata.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
PAGE = 2048  # fingerprints of a page
FAN = 4  # a node has 2**FAN children
HASH_SEED = 42
BLOCK = 65_536  # shingles of a text that are counted at a time
BLOCKS = (256, 32, 4, 1)  # sizes of the groups inside a page, each divides the one before


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text: a bit is set if over half of its shingles' hashes set it."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    ones, many, shingles = np.zeros(64, dtype=np.int64), 0, iter(shingles)
    while block := [xxh64_intdigest(s, HASH_SEED) for s in islice(shingles, BLOCK)]:
        hashes = np.array(block, dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        many += len(block)
    return int(np.packbits(2 * ones > many, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp (the fingerprint as a signed long) of every row."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle_words) for t in batch], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), fp("text").alias("fp"))


def gray_rank(fp: Column) -> Column:
    """Rank in the reflected Gray code, as a signed long that sorts as the unsigned one."""
    for s in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, s))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages of a Gray-sorted partition: its number, theirs, the AND and OR of the fingerprints, and these."""
    part, seq, held = TaskContext.get().partitionId(), 0, np.empty(0, dtype=np.int64)

    def page(values: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "seq": [seq], "all_of": [np.bitwise_and.reduce(values)], "any_of": [np.bitwise_or.reduce(values)], "fps": [values.tobytes()]})

    for batch in batches:
        held = np.concatenate([held, batch["fp"].to_numpy(dtype=np.int64)])
        while len(held) >= PAGE:
            yield page(held[:PAGE])
            seq, held = seq + 1, held[PAGE:]
    if len(held):
        yield page(held)


def _differ(a_all: np.ndarray, a_any: np.ndarray, b_all: np.ndarray, b_any: np.ndarray) -> np.ndarray:
    """Least number of bits in which members of two groups differ: those that each group agrees on."""
    return np.bitwise_count((a_all ^ b_all) & ~(a_all ^ a_any) & ~(b_all ^ b_any))


def _grouped(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(0, len(values), size)
    return np.bitwise_and.reduceat(values, at), np.bitwise_or.reduceat(values, at)


def page_links(a: np.ndarray, b: np.ndarray, same: bool, max_bits: int) -> np.ndarray:
    """Index pairs (i, j) with at most ``max_bits`` differing bits; i < j if both pages are the same."""
    i = j = np.zeros(1, dtype=np.int64)
    before = PAGE
    for size in BLOCKS:
        a_all, a_any = _grouped(a, size)
        b_all, b_any = (a_all, a_any) if same else _grouped(b, size)
        k = np.arange(before // size)
        n = len(k)
        ci = np.repeat((i[:, None] * n + k), n, axis=1).ravel()
        cj = np.tile((j[:, None] * n + k), (1, n)).ravel()
        keep = (ci < len(a_all)) & (cj < len(b_all))
        if same:
            keep &= (ci < cj) if size == 1 else (ci <= cj)
        ci, cj = ci[keep], cj[keep]
        near = _differ(a_all[ci], a_any[ci], b_all[cj], b_any[cj]) <= max_bits
        i, j, before = ci[near], cj[near], size
        if not len(i):
            break
    return np.stack([i, j], axis=1)


def _forest(pairs: np.ndarray, offset: int) -> list[tuple[int, int]]:
    """A spanning forest of the links: as many components with at most one link for each node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in pairs.tolist():
        p, q = root(x), root(y + offset)
        if p != q:
            parent[q] = p
            out.append((x, y))
    return out


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) between the distinct fingerprints in ``fps`` (column fp) that join all at most ``max_bits`` apart.

    Of the links inside a pair of pages a spanning forest is returned, so the components are those of all links.
    """
    ordered = fps.repartitionByRange(gray_rank(F.col("fp"))).sortWithinPartitions(gray_rank(F.col("fp")))
    pages = written(ordered.select("fp").mapInPandas(_pages, "part long, seq long, all_of long, any_of long, fps binary"), "gray_pages")
    top = pages.agg(F.max("part"), F.max("seq")).first()
    if top[0] is None:
        return fps.sparkSession.createDataFrame([], "u long, v long")
    seq_bits = int(top[1]).bit_length()
    key = F.shiftleft("part", seq_bits).bitwiseOR(F.col("seq"))
    pages = pages.withColumn("page", key)
    height = -(-(int(top[0]).bit_length() + seq_bits) // FAN)
    shared = pages.select("page", "all_of", "any_of")

    def nodes(level: int, name: str) -> DataFrame:
        own = shared.withColumn("id", F.shiftright("page", FAN * level)).groupBy("id").agg(F.bit_and("all_of").alias("all_of"), F.bit_or("any_of").alias("any_of"))
        return own.select(F.shiftright("id", FAN).alias(f"{name}_up"), F.col("id").alias(f"{name}_id"), F.col("all_of").alias(f"{name}_all"), F.col("any_of").alias(f"{name}_any"))

    pairs = None
    for level in reversed(range(max(1, height))):
        x, y = nodes(level, "x"), nodes(level, "y")
        agreed = [F.bitwise_not(F.col(f"{n}_all").bitwiseXOR(F.col(f"{n}_any"))) for n in "xy"]
        apart = F.bit_count(F.col("x_all").bitwiseXOR(F.col("y_all")).bitwiseAND(agreed[0]).bitwiseAND(agreed[1]))
        ordered_pair = F.col("x_id") <= F.col("y_id")
        if pairs is None:  # the root's children
            met = x.join(y, (F.col("x_up") == F.col("y_up")) & ordered_pair)
        else:
            met = pairs.join(x, F.col("a") == F.col("x_up")).join(y, (F.col("b") == F.col("y_up")) & ordered_pair)
        pairs = met.where(apart <= max_bits).select(F.col("x_id").alias("a"), F.col("y_id").alias("b"))
    blobs = pages.select("page", "fps")
    left = blobs.select(F.col("page").alias("a"), F.col("fps").alias("a_fps"))
    right = blobs.select(F.col("page").alias("b"), F.col("fps").alias("b_fps"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "a_fps", "b_fps")

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a, b = np.frombuffer(row.a_fps, dtype=np.int64), np.frombuffer(row.b_fps, dtype=np.int64)
                found = _forest(page_links(a, b, row.a == row.b, max_bits), 0 if row.a == row.b else len(a))
                if found:
                    i, j = np.array(found).T
                    yield pd.DataFrame({"u": a[i], "v": b[j]})

    return met.mapInPandas(links, "u long, v long")


def _rooted(docs: DataFrame, shingle_words: int, max_bits: int) -> DataFrame:
    """One row per input row: doc_id, text_key, fp, component_id, and root, the least fingerprint of the component."""
    rows = written(with_fingerprint(docs, shingle_words), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint_classes")
    roots = components(near_links(classes.select("fp"), max_bits))
    members = classes.join(roots, classes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    least = written(members.groupBy("root").agg(F.min("first_id").alias("component_id")), "component_ids")
    of_fp = written(members.join(least, "root").select("fp", "root", "component_id"), "component_of")
    return rows.join(of_fp, "fp").select("doc_id", "text_key", "fp", "component_id", "root")


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, text_key, fp, component_id (the least doc_id reachable over links)."""
    return _rooted(docs, shingle_words, max_bits).drop("root")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group, the one with the least doc_id, with its columns, whatever these are called."""
    groups = _rooted(docs, shingle_words, max_bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # of rows that share the least doc_id of a group, or have none, those of the least fingerprint and text
    stay = groups.groupBy("root").agg(F.min(F.struct("fp", "doc_id", "text_key")).alias("least")).select("root", "least.doc_id", "least.text_key")
    own = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("own_key"))
    both = own.join(stay, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key")))
    # rows that repeat the text: the first in the order of the other columns
    first = Window.partitionBy("root").orderBy(*(f"row.{c}" for c in DOCUMENT_COLUMNS[1:]))
    return both.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
