import random

import pytest
from pyspark.sql import functions as F

from gripelens.functions import text as tx
from gripelens.functions.names import display_name, sentence_name, title_name
from gripelens.operators.cleaning import drop_blank, melt, normalise_strings

SHAPE_ROWS = [
    # text, words, chars, exclamations, capital ratio
    (None, 0, 0, 0, 0.0),
    ("", 0, 0, 0, 0.0),
    ("\t \n", 0, 0, 0, 0.0),
    ("Great!", 1, 6, 1, 1 / 6),
    ("  Love  it ", 2, 8, 0, 1 / 8),
    ("ÉTÉ! WOW!!", 2, 10, 3, 6 / 10),
    ("a\x1cb\xa0c　d e", 5, 9, 0, 0.0),
    (" x\x85", 1, 1, 0, 0.0),
    ("😀 ok", 2, 4, 0, 0.0),
]


def shape(spark, texts, mode="regex"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    clean = df.select("i", tx.clean_text(F.col("text")).alias("c"))
    return tx.with_shape(clean, "c", mode).orderBy("i").collect()


def test_shape_of_literal_rows(spark):
    for row, want in zip(shape(spark, [r[0] for r in SHAPE_ROWS]), SHAPE_ROWS):
        got = (
            row.review_length_words,
            row.review_length_chars,
            row.exclamation_count,
            row.capital_ratio,
        )
        assert got == pytest.approx(want[1:]), want[0]


def test_words_chars_and_capitals_agree_with_python(spark):
    rng = random.Random(5)
    alphabet = "aB! .?\t\n\x0b\x1d\x85\xa0   漢É😀ⅠDž"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]
    for text, row in zip(texts, shape(spark, texts)):
        assert row.review_length_words == len(text.split())
        assert row.review_length_chars == len(text.strip())
        upper = sum(c.isupper() for c in text.strip())
        assert row.capital_ratio == pytest.approx(upper / max(len(text.strip()), 1))


def sentences_by_hand(text):
    """Words of each non-empty sentence, a sentence ending with a word that ends in a mark."""
    out, current = [], 0
    for word in text.split():
        current += bool(word.rstrip(".!?"))
        if word[-1] in ".!?" and current:
            out.append(current)
            current = 0
    return out + [current] if current else out


def test_sentence_length_agrees_with_counting(spark):
    rng = random.Random(9)
    alphabet = "ab .!?\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(400)]
    texts += ["...", "! ?", "One two. Three", "v1.2 is out!", "a . b"]
    for text, row in zip(texts, shape(spark, texts)):
        lengths = sentences_by_hand(text)
        want = sum(lengths) / len(lengths) if lengths else 0.0
        assert row.avg_sentence_length == pytest.approx(want), repr(text)


def test_breakiterator_mode(spark):
    rows = shape(spark, ["One two. Three four five six.", ""], "breakiterator")
    assert [r.avg_sentence_length for r in rows] == [3.0, 0.0]
    with pytest.raises(ValueError):
        tx.avg_sentence_length(F.col("x"), "other")


def test_tokens_and_terms(spark):
    df = spark.createDataFrame([("Don't STOP, it's été 3x",), (None,)], "t string")
    got = [r.k for r in df.select(tx.tokens(F.col("t")).alias("k")).collect()]
    assert got == [["don't", "stop", "it's", "été", "x"], []]
    counted = df.select(tx.term_count(tx.tokens(F.col("t")), ["Stop", "x"]).alias("n")).collect()
    assert [r.n for r in counted] == [2, 0]


def test_feature_names(spark):
    raw = [
        ("num_scaler__sentiment_polarity", "Sentiment Polarity", "Sentiment polarity"),
        (
            "verified_ohe__verified_purchase_True",
            "Verified Purchase True",
            "Verified purchase True",
        ),
        (
            "early_access_ohe__early_access_review_Early Access Review",
            "Early Access Review",
            "Early access review",
        ),
        ("cat_ohe__kind_x", "Cat Ohe Kind X", "Kind x"),
    ]
    df = spark.createDataFrame([(r[0],) for r in raw], "f string")
    got = df.select(title_name(F.col("f")), sentence_name(F.col("f"))).collect()
    # The title cleaner does not know the prefix of the last one.
    assert [tuple(g) for g in got] == [(t, s) for _, t, s in raw[:3]] + [("Cat Ohe  Kind X", "Kind x")]
    keys = spark.createDataFrame([("steam",), ("amazon_health",), ("other",)], "k string")
    names = [r[0] for r in keys.select(display_name(F.col("k"))).collect()]
    assert names == ["Steam", "Amazon (Health)", "other"]


def test_cleaning(spark):
    df = spark.createDataFrame([("a", 1), ("　 ", 2), (None, 3)], "review string, n int")
    assert [r.n for r in drop_blank(df, "review").collect()] == [1]
    filled = normalise_strings(df, ["review", "n", "absent"]).collect()
    assert [tuple(r) for r in filled] == [("a", "1"), ("　 ", "2"), ("", "3")]
    long = melt(df.where("n = 1").select("review", "n"), ["review"], ["n"], "name", "value").collect()
    assert [tuple(r) for r in long] == [("a", "n", 1)]
