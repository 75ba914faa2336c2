import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.quality import THRESHOLD, features, fit_ranker, held_out, keep_good, op5_quality_classifier, score_udf, train

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Held-out labelled documents: nearly all bad ones are found, nearly all good ones kept."""
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = op5_quality_classifier(spark, SF).where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    good = rows["quality"] == 1
    assert (rows["predicted"][good] == 1).mean() > 0.98
    assert (rows["predicted"][~good] == 0).mean() > 0.95
    order = rows["score"].rank()
    auc = (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.99
    assert rows["score"].between(0, 1).all()
    assert ((rows["score"] >= THRESHOLD).astype(int) == rows["predicted"]).all()


def test_ranker_learns_a_preference():
    chance = np.random.default_rng(0)
    rows = chance.normal(size=(400, 3))
    good = rows[:, 0] - 0.5 * rows[:, 1] > 0
    model = fit_ranker(rows, good, good.mean())
    score = model.score(rows)
    assert ((score >= THRESHOLD) == good).mean() > 0.97
    assert model.weights[0] > 0 > model.weights[1]
    assert score.min() >= 0 and score.max() <= 1
    # the share of bad documents is the quantile at the threshold
    assert abs((score < THRESHOLD).mean() - (~good).mean()) < 0.03


def test_features_of_any_text():
    for text in (None, "", " ", "\n", "x", "\ud800", "é" * 100_000, "a b " * 50_000, "\x00"):
        assert np.isfinite(features(text)).all()


def test_held_out_is_the_crc_of_the_id(spark):
    import zlib

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_held_out_labels_are_not_used(spark, documents):
    docs = documents([(k, "good words here" if k % 2 else "*** $$$ ###") for k in range(60)])
    labels = labelled(spark, [(k, k % 2) for k in range(60)])
    # labels of held-out rows turned round change nothing
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    a, b = train(docs, labels), train(docs.repartition(5), turned)
    assert np.allclose(a.weights, b.weights)


def test_defined_cases(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "text"), (3, "a b c"), (3, "a b c"), (4, "z " * 100_000)], ["score", "quality", "predicted"])
    none = labelled(spark, [(3, None), (99, 1), (None, 0)])
    model = train(docs, none)
    assert [r.s for r in docs.select(score_udf(model)("text").alias("s")).collect()] == [0.5] * 6
    kept = keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 6
    empty = documents([])
    assert keep_good(empty, labelled(spark, [])).count() == 0


@pytest.mark.parametrize("share", [0.1, 0.9])
def test_threshold_is_at_the_quantile_of_the_labels(share):
    chance = np.random.default_rng(1)
    rows = np.concatenate([chance.normal(2, 1, (300, 1)), chance.normal(-2, 1, (300, 1))])
    good = np.arange(600) < 300
    model = fit_ranker(rows, good, share)
    assert model.score(np.array([[6.0]]))[0] > 0.9 and model.score(np.array([[-6.0]]))[0] < 0.1


def slow_features(text):
    """Word by word and byte by byte."""
    import math

    if not text:
        return [0.0] * 16
    raw = list(text.encode("utf-8", "surrogatepass"))
    words, lines = text.split(), text.split("\n")

    def share(which):
        return sum(which(b) for b in raw) / len(raw)

    stops = b".,;:?'\"-"
    out = [0.0] * 16
    out[4], out[5], out[6] = share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in stops)
    out[7] = share(lambda b: b == ord("!"))
    out[8] = share(lambda b: 33 <= b < 127 and not chr(b).isalnum() and b not in stops)
    out[9] = share(lambda b: b in (9, 11, 12, 13))
    out[14] = -sum(raw.count(b) / len(raw) * math.log(raw.count(b) / len(raw)) for b in set(raw))
    out[13] = len(set(lines)) / len(lines)
    if words:
        n, distinct = len(words), set(words)
        out[0], out[1] = math.log(n + 1), math.log(sum(len(w) for w in words) / n)
        out[2], out[3] = sum(len(w) > 20 for w in words) / n, sum(len(w) == 1 for w in words) / n
        out[10] = len(distinct) / n**0.9
        out[11] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
        out[12] = max(words.count(w) for w in distinct) / n
        out[15] = sum(not (w.isalpha() or w[:-1].isalpha()) for w in distinct) / len(distinct)
    return out


def test_features_against_the_slow_form(whole):
    texts = [r.text for r in whole.select("text").collect()][:60] + ["", None, "a", "A1! \t x\n\nx x", "é — ü", "w " * 50]
    for text in texts:
        assert features((text or "")[:3000]) == pytest.approx(slow_features((text or "")[:3000]))


def test_scores_against_quantiles_row_by_row():
    """The score of a labelled document is its weighted quantile, stretched so that the best cut is at the threshold."""
    chance = np.random.default_rng(5)
    rows = chance.normal(size=(120, 4))
    good = rows[:, 0] + chance.normal(0, 0.5, 120) > 0
    share = 0.7
    model = fit_ranker(rows, good, share)
    worth = model.worth(rows)
    weight = [share / good.sum() if g else (1 - share) / (~good).sum() for g in good]
    ranked = sorted(range(120), key=lambda i: worth[i])

    def right(cut):
        return sum(weight[i] for i in ranked[:cut] if not good[i]) + sum(weight[i] for i in ranked[cut:] if good[i])

    cut = max(range(121), key=lambda c: (round(right(c), 12), -c))
    at = sum(weight[i] for i in ranked[:cut])
    upto = 0.0
    for place, i in enumerate(ranked):
        upto += weight[i]
        want = THRESHOLD * upto / at if place < cut else THRESHOLD + (1 - THRESHOLD) * (upto - at) / (1 - at)
        assert model.score(rows[i : i + 1])[0] == pytest.approx(want, abs=1e-6)


def test_weights_are_where_the_logistic_loss_is_least():
    from strata.llm.quality import PAIRS, RIDGE

    chance = np.random.default_rng(6)
    rows = chance.normal(size=(60, 3))
    good = rows[:, 0] - rows[:, 2] + chance.normal(0, 1, 60) > 0
    model = fit_ranker(rows, good, 0.5)
    scaled = np.clip((rows - model.mean) / model.scale, -8, 8)
    draw = np.random.default_rng(0)
    diff = scaled[draw.choice(np.flatnonzero(good), PAIRS)] - scaled[draw.choice(np.flatnonzero(~good), PAIRS)]

    def loss(w):
        return np.log1p(np.exp(-(diff @ w))).mean() + RIDGE / 2 * (w @ w)

    least = loss(model.weights)
    for k in range(3):
        for step in (-1e-2, 1e-2):
            assert loss(model.weights + step * np.eye(3)[k]) > least
