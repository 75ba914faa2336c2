"""Quality classifier by Bradley-Terry ranking.

A document's worth is linear in a few lexical features. Pairs of a good and a
bad labelled document say which one is preferred; the logistic loss on the
difference of their features gives the weights. The worth is then turned into a
score by its quantile among the labelled documents, and the quantile that parts
the classes best is put at ``THRESHOLD``.

Only the fit uses labels: at most ``MAX_LABELLED`` documents of each class, the
first ones in the order of a hash, and ``PAIRS`` pairs. Scoring is one narrow
pass over the texts.

Defined cases: a null text scores as an empty one, by the model like any other.
Labels that are null, or whose document is unknown, are not used; if a class has
no document left, every score is 0.5. Rows that repeat a doc_id are scored each;
in the fit they count once. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table

MAX_LABELLED = 10_000
PAIRS = 200_000
THRESHOLD = 0.3
KNOTS = 1001
RIDGE = 1e-3
FOLDS = 5

FEATURES = (
    "log_words", "word_length", "long_words", "one_char_words", "upper", "digits", "full_stops", "marks", "symbols",
    "other_white", "distinct_words", "repeated_next", "top_word", "distinct_lines", "entropy", "marked_words",
)
_STOPS = np.isin(np.arange(256), list(b".,;:?'\"-"))
_SYMBOLS = np.isin(np.arange(256), [c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,;:?'\"-"])


def features(text: str | None) -> np.ndarray:
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    chars, words = raw.sum(), text.split()
    n = len(words)
    share = raw[raw > 0] / chars
    out[[4, 5, 6, 8, 9, 14]] = raw[65:91].sum() / chars, raw[48:58].sum() / chars, raw[_STOPS].sum() / chars, raw[_SYMBOLS].sum() / chars, raw[[9, 11, 12, 13]].sum() / chars, -(share * np.log(share)).sum()
    out[7] = raw[33] / chars
    lines = text.split("\n")
    out[13] = len(set(lines)) / len(lines)
    if n:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        counts = Counter(words)
        out[0] = np.log1p(n)
        out[1] = np.log(lengths.mean())
        out[2] = (lengths > 20).mean()
        out[3] = (lengths == 1).mean()
        out[10] = len(counts) / n**0.9
        out[11] = sum(map(operator.eq, words, words[1:])) / n
        out[12] = max(counts.values()) / n
        out[15] = sum(not (w.isalpha() or w[:-1].isalpha()) for w in counts) / len(counts)
    return out


class Ranker:
    """Weights of the features and the way from worth to score."""

    def __init__(self, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray, worths: np.ndarray, scores: np.ndarray):
        self.weights, self.mean, self.scale, self.worths, self.scores = weights, mean, scale, worths, scores

    def worth(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.worth(rows), self.worths, self.scores)


def fit_ranker(rows: np.ndarray, good: np.ndarray, share_good: float, pairs: int = PAIRS) -> Ranker:
    """Bradley-Terry by Newton steps on pairs; ``share_good`` is the share of good ones among all labels."""
    width = rows.shape[1] if rows.ndim == 2 else len(FEATURES)
    if not good.any() or good.all():
        return Ranker(np.zeros(width), np.zeros(width), np.ones(width), np.zeros(1), np.full(1, 0.5))
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    scaled = np.clip((rows - mean) / scale, -8, 8)
    chance = np.random.default_rng(0)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    diff = scaled[chance.choice(better, pairs)] - scaled[chance.choice(worse, pairs)]
    w = np.zeros(width)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        grad = diff.T @ (1 - p) / pairs - RIDGE * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + RIDGE * np.eye(width)
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    worth = scaled @ w
    weight = np.where(good, share_good / good.sum(), (1 - share_good) / (~good).sum())
    order = np.argsort(worth, kind="stable")
    worth, good, weight = worth[order], good[order], weight[order]
    quantile = np.cumsum(weight)  # of the labelled documents, up to and with each
    # right if everything up to here is called bad and the rest good
    right = np.concatenate([[0.0], np.cumsum(np.where(good, 0, weight))]) + share_good - np.concatenate([[0.0], np.cumsum(np.where(good, weight, 0))])
    cut = int(right.argmax())
    edge = worth[0] - 1 if cut == 0 else worth[-1] + 1 if cut == len(worth) else (worth[cut - 1] + worth[cut]) / 2
    at = quantile[cut - 1] if cut else 0.0
    score = np.where(np.arange(len(worth)) < cut, THRESHOLD * quantile / max(at, 1e-12), THRESHOLD + (1 - THRESHOLD) * (quantile - at) / max(1 - at, 1e-12))
    x, y = np.append(worth, edge), np.append(np.clip(score, 0, 1), THRESHOLD)
    # below the edge scores stay under the threshold
    y = np.where(x < edge, np.minimum(y, THRESHOLD * (1 - 1e-6)), y)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    keep = np.unique(np.concatenate([np.linspace(0, len(x) - 1, KNOTS).astype(int), np.searchsorted(x, edge) + np.arange(-1, 2)]).clip(0, len(x) - 1))
    x, y = x[keep], np.maximum.accumulate(y[keep])
    # one unit below the least worth seen scores 0, one above the largest 1
    return Ranker(w, mean, scale, np.concatenate([[x[0] - 1], x, [x[-1] + 1]]), np.concatenate([[0.0], y, [1.0]]))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranker:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = usable.where("quality = 1").orderBy(*order).limit(max_labelled).union(usable.where("quality = 0").orderBy(*order).limit(max_labelled))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            frame = pd.DataFrame(np.array([features(t) for t in batch["text"]]).reshape(-1, len(FEATURES)), columns=list(FEATURES))
            frame.insert(0, "quality", batch["quality"].to_numpy())
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    # at most 2 * max_labelled rows of two numbers are sent out, and as many rows of features come back
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    schema = "doc_id long, quality int, " + ", ".join(f"{f} double" for f in FEATURES)
    found = chosen.mapInPandas(measured, schema).groupBy("doc_id", "quality").agg(*(F.min(f).alias(f) for f in FEATURES)).toPandas().sort_values("doc_id")
    total = sum(counts.values())
    return fit_ranker(found[list(FEATURES)].to_numpy(dtype=float), found["quality"].to_numpy() == 1, counts.get(1, 0) / total if total else 0.5)


def score_udf(model: Ranker):
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.score(np.array([features(t) for t in batch]).reshape(-1, len(FEATURES))))

    return score


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with the columns of ``docs``."""
    score = score_udf(train(docs, labels))
    return docs.where(score("text") >= THRESHOLD).select(*docs.columns)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    score = score_udf(train(docs, read_table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
