import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gripelens.operators import language as lg
from gripelens.operators.sampling import stratified_split
from gripelens.runtime import materialise
from gripelens.checks import views

TRAIN = [
    (1, "en", "The cat, and THE dog!"),
    (2, "de", "der Hund und die Katze"),
    (3, "de", "über alles\nder Berg"),
]
PROBES = ["the and", "der über", "12 a", "", None, "qqq", "x\U00020000yz\U00020001w", "the\U00020000"]


def grams(text):
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    s = " " + " ".join(letters.split()) + " "
    return [s[i : i + 3] for i in range(len(s) - 2)], sum(c.isalpha() for c in letters)


def by_hand(text):
    counts = {}
    for _, lang, t in TRAIN:
        counts.setdefault(lang, Counter()).update(grams(t)[0])
    vocabulary = set().union(*counts.values())
    found, letters = grams(text)
    found = [g for g in found if g in vocabulary]
    if letters < 3 or not found:
        return "unknown"
    return max(
        (sum(round(1e6 * math.log((c[g] + 1) / (c.total() + len(vocabulary)))) for g in found), lang)
        for lang, c in counts.items()
    )[1]


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(TRAIN, "review_id int, lang string, text string")
    return lg.LanguageModel.from_counts(lg.gram_counts(df))


def test_counts_cover_whole_texts(spark):
    df = spark.createDataFrame(TRAIN, "review_id int, lang string, text string")
    got = {(r.lang, r.gram): r.n for r in lg.gram_counts(df).collect()}
    want = Counter((lang, g) for _, lang, t in TRAIN for g in grams(t)[0])
    assert got == dict(want)


@pytest.mark.parametrize("small", [True, False], ids=["broadcast", "salted shuffle"])
def test_detection_agrees_with_counting(spark, model, small):
    model = lg.LanguageModel(model.languages, model.scores, small)
    df = spark.createDataFrame(list(enumerate(PROBES)), "review_id int, text string")
    got = {r.review_id: r.lang_detected for r in lg.detect_language(df, model).collect()}
    assert got == {i: by_hand(t) for i, t in enumerate(PROBES)}


def test_held_out_accuracy(spark, sf_dir):
    docs = views.review_texts(spark, sf_dir)
    split = stratified_split(docs, "lang", "review_id")
    train = materialise(lg.gram_counts(split.where(~F.col("is_test"))), "train-counts")
    found = lg.detect_language(split.where("is_test"), lg.LanguageModel.from_counts(train))
    judged = found.join(docs.select("review_id", "lang"), "review_id")
    right = judged.where(F.col("lang") == F.col("lang_detected")).count()
    assert right / judged.count() > 0.95
