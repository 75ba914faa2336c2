from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm.language import PROFILE, grams, identify, learn_profiles, most_frequent, op6_language_id, predictor

SF = "/root/testdata/sf0.1"


def slow_grams(text):
    text = (text or "").lower()
    words = "".join(c if c.isalpha() else " " for c in text).split()
    out = Counter()
    for w in words:
        out.update(w)
    joined = f" {' '.join(words)} "
    if words:
        out.update(joined[i : i + 2] for i in range(len(joined) - 1))
        out.update(joined[i : i + 3] for i in range(len(joined) - 2) if joined[i + 1] != " ")
    return out


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_grams_equal_the_slow_form(text):
    found, counts = grams(text)
    assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == {code(g): n for g, n in slow_grams(text).items()}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab é.\n", max_size=80), st.integers(1, 20))
def test_spans_of_a_text_count_as_the_whole(text, span):
    for a, b in zip(grams(text, span), grams(text), strict=True):
        assert a.tolist() == b.tolist()


def slow_prediction(text, profiles):
    counted = slow_grams(text)
    if not counted:
        return "und"
    own = sorted(counted, key=lambda g: (-counted[g], code(g)))[:PROFILE]
    rank = {lang: {g: k for k, g in enumerate(p.tolist())} for lang, p in profiles.items()}
    # a missing n-gram costs PROFILE, a known one its difference
    apart = {lang: sum(abs(rank[lang][code(g)] - k) if code(g) in rank[lang] else PROFILE for k, g in enumerate(own)) for lang in profiles}
    return min(sorted(apart), key=apart.get)


def test_profiles_and_predictions_equal_brute_force(whole):
    rows = [(r.text, r.lang) for r in whole.select("text", "lang").collect()]
    profiles = learn_profiles(whole)
    for lang in {x for _, x in rows}:
        total = Counter()
        for text, own in rows:
            if own == lang:
                total.update(slow_grams(text))
        expected = sorted(total, key=lambda g: (-total[g], code(g)))[:PROFILE]
        assert profiles[lang].tolist() == [code(g) for g in expected]
    predict = predictor(profiles)
    for text, _ in rows[:60]:
        assert predict(text)[0] == slow_prediction(text, profiles)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op6_language_id(spark, SF).where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert got[0] > 0.99 and got[1] >= 0 and got[2] <= 1


def test_defined_cases(spark, documents):
    docs = documents([(1, "aaa bbb", "x"), (2, "ccc ddd", "y"), (3, "ccc", None), (4, None, "x"), (5, "123 !?", "y"), (6, "aaa " * 100_000, "x"), (6, "aaa", "x")], ["score", "lang_pred", "gram"])
    profiles = learn_profiles(docs)
    assert sorted(profiles) == ["x", "y"]
    got = {(r.doc_id, r.lang_pred) for r in identify(docs.drop("score", "lang_pred"), profiles).collect()}
    assert got == {(1, "x"), (2, "y"), (3, "y"), (4, "und"), (5, "und"), (6, "x")}
    assert learn_profiles(documents([])) == {}
    assert predictor({})("words") == ("und", 0.0)
    assert identify(documents([]), profiles).count() == 0


def test_ties_are_by_n_gram():
    found, counts = np.array([3, 5, 9], dtype=np.uint64), np.array([1, 2, 2])
    assert most_frequent(found, counts, 2).tolist() == [5, 9]
