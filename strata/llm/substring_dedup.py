"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words; its minimiser is the least hash among
the runs of ``SEED`` words in it. Equal windows have equal minimisers, and
consecutive windows mostly share theirs: such a run of windows travels as one
packed string, a super-k-mer, to the bucket of its minimiser, where its windows
are sorted by place and every one that has been seen before is a repeat.

1. Every run's minimiser is counted. A run whose minimiser occurs once, in
   itself too, holds no repeat and stays where it is; so only text that may repeat is ever moved.
2. Documents meet the places of their other runs and send these to the buckets.
   A bucket of up to ``HEAVY`` runs is one sorted group of a task. Of the runs of
   a more frequent minimiser, equal ones become one first, whose earliest place
   is an aggregate that combines before the shuffle. The runs left are cut again
   by the next of ``SEEDS``, a longer one, and go, packed as before, to the bucket
   of both minimisers; and so on.
3. What is still frequent by the longest seed becomes single windows, of which
   equal ones become one in the same way.
4. Documents meet the words found repeated, and drop them.

Nothing is approximate: hashes only say where to meet, windows are compared as
text.

Defined cases: a null or empty text has no words. Earlier means a smaller
doc_id, or the same and an earlier start; rows with a null doc_id come after all
others, in the order of a hash of their text. Rows that repeat a doc_id are not
earlier than each other at the same start, so exact repeats of a row keep their
words alike. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table, written

WINDOW = 20
SEEDS = (4, 8, 16)  # words of a minimiser, level by level
HEAVY = 2_048
CACHED_WORDS = 300_000
# a run's place is start << 32 | heavy | again | windows
HEAVY_BIT = 1 << 31
AGAIN_BIT = 1 << 30  # its minimiser occurs more than once in the run itself


class _WordHash(dict):
    """Hashes of words; a worker keeps a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxh64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def runs(words: list[bytes], hashes: dict, window: int = WINDOW, seed: int = SEEDS[0]) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser and place of each run of windows that share a minimiser."""
    n = len(words) - window + 1
    if n < 1:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    word = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    seeds = len(words) - seed + 1
    least = np.zeros(seeds, dtype=np.uint64)
    for k in range(seed):
        least = (least ^ word[k : k + seeds]) * np.uint64(0x9E3779B97F4A7C15)
        least ^= least >> np.uint64(29)
    # least hash of so many neighbours, doubling up to those of a window
    here = least
    span, width = 1, window - seed + 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    new = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    # a window that starts with its minimiser leaves it to those behind, unless it comes again
    left = here[:n] == least
    left[np.append(new[1:] - 1, n - 1)] = False
    again = np.where(np.logical_or.reduceat(left, new), AGAIN_BIT, 0)
    return least[new].view(np.int64), new << 32 | again | np.diff(np.append(new, n))


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _WordHash()
    for batch in batches:
        minimisers, rows, places = [], [], []
        for row_key, text in zip(batch["row_key"].tolist(), batch["text"].tolist(), strict=True):
            minimiser, place = runs(words_of(text), hashes)
            minimisers.append(minimiser)
            rows.append(np.full(len(place), row_key, dtype=np.int64))
            places.append(place)
        if rows:
            yield pd.DataFrame({"minimiser": np.concatenate(minimisers), "row_key": np.concatenate(rows), "place": np.concatenate(places)})


RUN = ["bucket", "counts", "packed", "unknown", "rid", "row_key", "start"]
RUN_SCHEMA = "bucket long, counts int, packed string, unknown boolean, rid long, row_key long, start long"


def _super_kmers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The packed strings of a document's runs; counts is 0 where the minimiser is heavy."""
    for batch in batches:
        out = []
        for unknown, rid, row_key, text, places, minimisers in zip(*(batch[c].tolist() for c in ("unknown", "rid", "row_key", "text")), batch["places"], batch["minimisers"], strict=True):
            words = words_of(text)
            for place, minimiser in zip(places.tolist(), minimisers.tolist(), strict=True):
                start, many = place >> 32, place & (AGAIN_BIT - 1)
                here = words[start : start + many + WINDOW - 1]
                if len(here) >= WINDOW:  # the place may be one in another row with this key
                    out.append((minimiser, 0 if place & HEAVY_BIT else 1, b" ".join(here).decode(), unknown, rid, row_key, start))
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=RUN)
                out = []
        if out:
            yield pd.DataFrame(out, columns=RUN)


def _cut_again(seed: int):
    """Cuts packed strings into the runs by minimisers of ``seed`` words, for buckets within theirs."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh64_intdigest

        hashes = _WordHash()
        for batch in batches:
            out = []
            for bucket, packed, *own, start in zip(*(batch[c].tolist() for c in ("bucket", "packed", "unknown", "rid", "row_key", "start")), strict=True):
                words = words_of(packed)
                for minimiser, place in zip(*(x.tolist() for x in runs(words, hashes, seed=seed)), strict=True):
                    at, many = place >> 32, place & (AGAIN_BIT - 1)
                    both = xxh64_intdigest(b"%d %d" % (bucket, minimiser)) - (1 << 63)
                    out.append((both, 2 if place & AGAIN_BIT else 1, b" ".join(words[at : at + many + WINDOW - 1]).decode(), *own, start + at))
            if out:
                yield pd.DataFrame(out, columns=RUN)

    return cut


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every window of every run."""
    for batch in batches:
        for packed, *own, start in zip(*(batch[c].tolist() for c in ("packed", "unknown", "rid", "row_key", "start")), strict=True):
            words = packed.split(" ")
            yield pd.DataFrame([(" ".join(words[i : i + WINDOW]), *own, start + i) for i in range(len(words) - WINDOW + 1)], columns=["packed", "unknown", "rid", "row_key", "start"])


def _repeats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Word ranges (first, behind the last) of the windows seen before, from buckets whose rows come in order of place."""
    current, seen, whole = None, {}, {}
    for batch in batches:
        out = []
        for bucket, packed, unknown, rid, key, start in zip(*(batch[c].tolist() for c in ("bucket", "packed", "unknown", "rid", "row_key", "start")), strict=True):
            if bucket != current:
                current, seen, whole = bucket, {}, {}
            own = (unknown, rid, start)
            first = whole.setdefault(packed, own)
            ends = list(accumulate(len(w) + 1 for w in packed.split(" ")))
            many = len(ends) - WINDOW + 1
            if first != own:  # all of it has been seen
                out.append((rid, key, start, start + many + WINDOW - 1))
                continue
            since = None
            begins = [0, *ends]
            for i in range(many):
                at = (unknown, rid, start + i)
                if seen.setdefault(packed[begins[i] : ends[i + WINDOW - 1] - 1], at) != at:
                    since = i if since is None else since
                elif since is not None:
                    out.append((rid, key, start + since, start + i + WINDOW - 1))
                    since = None
            if since is not None:
                out.append((rid, key, start + since, start + many + WINDOW - 1))
        if out:
            yield pd.DataFrame(out, columns=["rid", "row_key", "first", "behind"])


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, rid, rids, firsts, behinds in zip(batch["text"].tolist(), batch["rid"].tolist(), batch["rids"], batch["firsts"], batch["behinds"], strict=True):
            words = words_of(text)
            stay = words
            if firsts is not None:
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                own = rids == rid  # not those of another row with this key
                np.add.at(edge, firsts[own], 1)
                np.add.at(edge, behinds[own], -1)
                stay = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            joined = b" ".join(stay)
            out.append((len(words), len(words) - len(stay), hashlib.sha256(joined).hexdigest(), joined.decode()))
        frame = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept"])
        frame.insert(0, "doc_id", pd.arrays.IntegerArray(batch["rid"].to_numpy(dtype=np.int64), batch["unknown"].to_numpy(dtype=bool)))
        yield frame


RANGE_SCHEMA = "rid long, row_key long, first long, behind long"


def _collapsed(packed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of equal strings the rows at the earliest place, and the word ranges of those behind it, which are repeats."""
    at = F.struct("unknown", "rid", "start")
    earliest = written(packed.groupBy("packed").agg(F.min(at).alias("earliest")), "earliest_places")
    met = packed.join(earliest, "packed")
    again = met.where(at != F.col("earliest"))
    behind = F.col("start") + F.regexp_count("packed", F.lit(" ")) + 1
    return met.where(at == F.col("earliest")).drop("earliest").distinct(), again.select("rid", "row_key", F.col("start").alias("first"), behind.alias("behind"))


def dedup_substrings(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words left, joined by a space) of every row."""
    text_key, doc_id = F.xxhash64("text"), F.col("doc_id").cast("long")
    rows = docs.select(doc_id.isNull().alias("unknown"), F.coalesce(doc_id, text_key).alias("rid"), F.xxhash64(F.coalesce(doc_id, text_key), text_key).alias("row_key"), "text")
    every = rows.select("row_key", "text").mapInPandas(_places, "minimiser long, row_key long, place long")
    repeated = written(every.groupBy("minimiser").agg(F.sum(F.when(F.col("place").bitwiseAND(F.lit(AGAIN_BIT)) != 0, 2).otherwise(1)).alias("n")).where("n > 1"), "repeated_minimisers")
    place = F.col("place") + F.when(F.col("n") > heavy, F.lit(HEAVY_BIT)).otherwise(F.lit(0))
    found = every.join(repeated, "minimiser").select("row_key", F.struct(place.alias("place"), "minimiser").alias("run"))
    of_row = found.groupBy("row_key").agg(F.collect_set("run").alias("runs")).select("row_key", F.col("runs.place").alias("places"), F.col("runs.minimiser").alias("minimisers"))
    sent = written(rows.join(of_row, "row_key").mapInPandas(_super_kmers, RUN_SCHEMA), "super_kmers")

    light, ranges = sent.where("counts > 0"), []
    left = sent.where("counts = 0")
    some = not repeated.where(F.col("n") > heavy).isEmpty()
    for seed in SEEDS[1:] if some else ():
        first, again = _collapsed(left)
        ranges.append(again)
        cut = written(first.mapInPandas(_cut_again(seed), RUN_SCHEMA), "super_kmers")
        sizes = cut.groupBy("bucket").agg(F.sum("counts").alias("n")).where("n > 1")
        sized = written(cut.join(sizes, "bucket"), "sized_super_kmers")
        light = light.unionByName(sized.where(F.col("n") <= heavy).select(*RUN))
        left = sized.where(F.col("n") > heavy).select(*RUN)
        some = not left.isEmpty()
        if not some:
            break
    if some:
        first, again = _collapsed(left)
        windows = written(first.select("packed", "unknown", "rid", "row_key", "start").mapInPandas(_windows, "packed string, unknown boolean, rid long, row_key long, start long"), "windows")
        ranges += [again, _collapsed(windows)[1]]
    placed = light.select("bucket", "packed", "unknown", "rid", "row_key", "start").repartition("bucket").sortWithinPartitions("bucket", "unknown", "rid", "start")
    drop = placed.mapInPandas(_repeats, RANGE_SCHEMA)
    for found in ranges:
        drop = drop.unionByName(found)
    drop = drop.groupBy("row_key").agg(F.collect_set(F.struct("rid", "first", "behind")).alias("r"))
    drop = drop.select("row_key", F.col("r.rid").alias("rids"), F.col("r.first").alias("firsts"), F.col("r.behind").alias("behinds"))
    return rows.join(drop, "row_key", "left").mapInPandas(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(read_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (
  SELECT doc_id, s AS start, array_to_string(list_slice(words, s, s + 19), ' ') AS window_text
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM d WHERE len(words) >= 20)),
later AS (
  SELECT doc_id, start FROM (
    SELECT doc_id, start, row_number() OVER (PARTITION BY window_text ORDER BY doc_id, start) AS nth FROM w) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM later),
p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM d),
k AS (
  SELECT p.doc_id, sum((gone.place IS NOT NULL)::INT)::BIGINT AS n_removed, count(*) AS n_words,
         string_agg(CASE WHEN gone.place IS NULL THEN word END, ' ' ORDER BY p.place) AS kept
  FROM p LEFT JOIN gone USING (doc_id, place) GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
