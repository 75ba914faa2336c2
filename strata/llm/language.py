"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (one to three, words
padded with a blank), most frequent first, ties by n-gram. A document's profile
is compared to each language's by the out-of-place distance: for every n-gram of
the document, how far its rank is from that in the language, or ``PROFILE`` if
the language doesn't have it. The nearest language wins, ties by name.

Language profiles count all rows that may be learned from; counts are summed in
the tasks before they are shuffled, and at most ``PROFILE`` rows for a language
reach the driver.

Defined cases: a null text or one without a letter is ``und`` with score 0; so
is every text if no language can be learned. Rows with a null lang are not
learned from but predicted. Repeated rows count as often as they occur. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import read_table
from strata.llm.quality import held_out

PROFILE = 400
BLANK = 32
UNKNOWN = "und"
FLUSH = 2_000_000  # n-gram counts that a task holds before it sums them up
SPAN = 500_000  # characters of a text that are counted at a time


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str | None, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text as integers of 21 bits a letter, ascending, and their counts.

    No n-gram crosses from word to word, so a long text is counted span by span, cut between words.
    """
    text = text or ""
    if len(text) <= span:
        return _grams(text)
    found, counts = _grams("")
    at = 0
    while at < len(text):
        end = at + span
        while end < len(text) and text[end].isalpha():
            end += 1
        more, n = _grams(text[at:end])
        merged, where = np.unique(np.concatenate([found, more]), return_inverse=True)
        total = np.zeros(len(merged), dtype=np.int64)
        np.add.at(total, where, np.concatenate([counts, n]))
        found, counts, at = merged, total, end
    return found, counts


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    letter = _is_letter()[codes]
    if not letter.any():
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    codes = np.concatenate([[BLANK], np.where(letter, codes, BLANK), [BLANK]]).astype(np.uint64)
    blank = codes == BLANK
    keep = np.concatenate([[True], ~(blank[1:] & blank[:-1])])
    codes, blank = codes[keep], blank[keep]
    two = (codes[:-1] << np.uint64(21)) | codes[1:]
    three = (two[:-1] << np.uint64(21)) | codes[2:]
    return np.unique(np.concatenate([codes[~blank], two, three[~blank[1:-1]]]), return_counts=True)


def most_frequent(found: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The ``size`` most frequent, ties by n-gram; ``found`` ascends."""
    return found[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """The profile of every language in docs(text, lang)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        n = 0

        def flush() -> Iterator[pd.DataFrame]:
            for lang, parts in held.items():
                found, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                total = np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(found))
                yield pd.DataFrame({"lang": lang, "gram": found.astype(np.int64), "n": total.astype(np.int64)})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                part = grams(text)
                held.setdefault(lang, []).append(part)
                n += len(part[0])
                if n > FLUSH:
                    yield from flush()
                    n = 0
        yield from flush()

    counted = docs.where("lang IS NOT NULL").select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    rows = top.select("lang", "gram", "rank").toPandas().sort_values(["lang", "rank"])
    return {lang: part["gram"].to_numpy(dtype=np.uint64) for lang, part in rows.groupby("lang")}


def predictor(profiles: dict[str, np.ndarray], size: int = PROFILE):
    """text -> (language, score): 1 for a profile in the language's very order, 0 for none of its n-grams."""
    langs = sorted(profiles)
    known = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.empty(0, dtype=np.uint64)
    ranks = np.full((len(known) + 1, len(langs)), size, dtype=np.int64)  # the last row: not in any profile
    missing = np.ones(ranks.shape, dtype=bool)
    for k, lang in enumerate(langs):
        at = np.searchsorted(known, profiles[lang])
        ranks[at, k] = np.arange(len(profiles[lang]))
        missing[at, k] = False

    def predict(text: str | None) -> tuple[str, float]:
        found, counts = grams(text)
        if not len(found) or not langs:
            return UNKNOWN, 0.0
        own = most_frequent(found, counts, size)
        at = np.searchsorted(known, own)
        at = np.where((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == own), at, len(known))
        apart = np.where(missing[at], size, np.abs(ranks[at] - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        return langs[best], float(1 - apart[best] / (size * len(own)))

    return predict


def identify(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """docs with the columns lang_pred and score added."""

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = predictor(profiles)
        for batch in texts:
            yield pd.DataFrame([predict(t) for t in batch], columns=["lang_pred", "score"])

    return docs.withColumn("_guess", guess("text")).withColumns({"lang_pred": F.col("_guess.lang_pred"), "score": F.col("_guess.score")}).drop("_guess")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, profiles).drop("text")


ORACLE = rf"""
WITH RECURSIVE bits AS (
  SELECT b, 0 AS n, b::BIGINT AS c FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, n + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM bits WHERE n < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits WHERE n = 8),
d AS MATERIALIZED (
  SELECT doc_id, lang,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 5 = 0 AS held_out,
    string_split(' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) || ' ', '') AS c
  FROM documents, crc),
g AS MATERIALIZED (
  SELECT doc_id, lang, held_out, gram, count(*) AS n FROM (
    SELECT doc_id, lang, held_out, unnest(list_concat(
      list_filter(c, lambda x: x <> ' '),
      list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1]),
      list_transform(list_filter(range(1, len(c) - 1), lambda i: c[i + 1] <> ' '), lambda i: c[i] || c[i + 1] || c[i + 2]))) AS gram
    FROM d WHERE len(list_filter(c, lambda x: x <> ' ')) > 0) GROUP BY ALL),
profile AS MATERIALIZED (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, length(gram), gram) - 1 AS rank FROM (
    SELECT lang, gram, sum(n) AS n FROM g WHERE lang IS NOT NULL AND NOT held_out GROUP BY ALL) QUALIFY rank < {PROFILE}),
own AS MATERIALIZED (
  SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, length(gram), gram) - 1 AS rank FROM g QUALIFY rank < {PROFILE}),
sizes AS (SELECT doc_id, count(*) AS grams FROM own GROUP BY doc_id),
met AS (
  SELECT own.doc_id, p.lang, count(*) AS known, sum(abs(p.rank - own.rank)) AS apart FROM own JOIN profile p USING (gram) GROUP BY ALL),
near AS (
  SELECT s.doc_id, l.lang, coalesce(apart, 0) + {PROFILE} * (grams - coalesce(known, 0)) AS apart, grams
  FROM sizes s CROSS JOIN (SELECT DISTINCT lang FROM profile) l LEFT JOIN met ON met.doc_id = s.doc_id AND met.lang = l.lang),
best AS (SELECT doc_id, lang, 1 - apart::DOUBLE / ({PROFILE} * grams) AS score FROM near QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY apart, lang) = 1)
SELECT d.doc_id, d.held_out, coalesce(best.lang, '{UNKNOWN}') AS lang_pred, coalesce(best.score, 0.0) AS score
FROM d LEFT JOIN best USING (doc_id)
"""
