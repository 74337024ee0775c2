import random
import re
from dataclasses import replace

import pytest

from gripelens.operators.markers import lexical_markers
from gripelens.operators.sentiment import Lexicon, negative_word_share, with_sentiment

WORDS = [("good", 0.7, 0.6), ("bad", -0.7, 0.65), ("fine", 0.4, 0.5), ("worst", -1.0, 1.0)]
MODIFIERS = [("very", "intensify", 1.3), ("not", "negate", -0.5), ("hardly", "negate", -0.5), ("so", "intensify", 2.0)]


def by_hand(text):
    words = {w: (p, q) for w, p, q in WORDS}
    boost = {w: f for w, k, f in MODIFIERS if k == "intensify"}
    flip = {w: f for w, k, f in MODIFIERS if k == "negate"}
    tokens = re.findall(r"[^\W\d_]+", (text or "").lower())
    found = []
    for i, t in enumerate(tokens):
        if t in words:
            p, q = words[t]
            b = boost.get(tokens[i - 1], 1.0) if i else 1.0
            f = next((flip[x] for x in reversed(tokens[max(0, i - 2) : i]) if x in flip), 1.0)
            found.append((max(-1, min(1, p * b * f)), max(0, min(1, q * b)), p < 0))
    if not found:
        return 0.0, 0.0, 0, 0
    n = len(found)
    return sum(f[0] for f in found) / n, sum(f[1] for f in found) / n, n, sum(f[2] for f in found)


@pytest.fixture(scope="module")
def lexicon(spark):
    return Lexicon.from_rows(spark, WORDS, MODIFIERS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    vocabulary = [w for w, *_ in WORDS] + [w for w, *_ in MODIFIERS] + ["the", "phone", "was", "good."]
    made = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(12))) for _ in range(300)]
    # One text holds far more hits than all others together.
    return made + [None, "", "Not very GOOD!", "nothing here", "good " * 20_000]


@pytest.mark.parametrize("small", [True, False], ids=["broadcast", "salted shuffle"])
def test_scores_agree_with_counting(spark, lexicon, texts, small):
    if not small:
        lexicon = replace(lexicon, small_words=False, small_modifiers=False)
    df = spark.createDataFrame(list(enumerate(texts)), "review_id int, text string")
    rows = {r.review_id: r for r in with_sentiment(df, lexicon, counts=True).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        p, q, n, negative = by_hand(text)
        assert rows[i].sentiment_polarity == pytest.approx(p, abs=1e-6), text
        assert rows[i].sentiment_subjectivity == pytest.approx(q, abs=1e-6), text
        assert (rows[i].scored_words, rows[i].negative_words) == (n, negative)


def test_other_columns_are_carried(spark, lexicon):
    df = spark.createDataFrame(
        [(1, "good", "a", 2.5, True, None), (2, "x", None, None, None, 7)],
        "review_id int, text string, tag string, num double, flag boolean, n bigint",
    )
    got = sorted(tuple(r) for r in with_sentiment(df, lexicon).select("review_id", "tag", "num", "flag", "n").collect())
    assert got == [(1, "a", 2.5, True, None), (2, None, None, None, 7)]


def test_result_does_not_depend_on_partitions(spark, lexicon, texts):
    df = spark.createDataFrame(list(enumerate(texts[:200])), "review_id int, text string")
    one = sorted(tuple(r) for r in with_sentiment(df.repartition(1), lexicon).collect())
    assert sorted(tuple(r) for r in with_sentiment(df.repartition(7), lexicon).collect()) == one


def test_lexicon_tables_average_senses(spark):
    words = spark.createDataFrame([("Good", 1.0, 0.5), ("good", 0.5, 0.7)], "term string, polarity double, subjectivity double")
    modifiers = spark.createDataFrame([("very", "intensify", 1.3)], "term string, kind string, factor double")
    built = Lexicon.build(words, modifiers)
    assert built.small_words and built.small_modifiers
    df = spark.createDataFrame([(1, "good")], "review_id int, text string")
    row = with_sentiment(df, built).first()
    assert (row.sentiment_polarity, row.sentiment_subjectivity) == pytest.approx((0.75, 0.6))


def test_negative_share_and_markers(spark, lexicon):
    df = spark.createDataFrame([(1, "bad bad good thing"), (2, "")], "review_id int, text string")
    rows = {r.review_id: r for r in negative_word_share(df, lexicon).collect()}
    assert rows[1].negative_share_scored == pytest.approx(2 / 3)
    assert rows[1].negative_share_words == pytest.approx(0.5)
    assert rows[2].negative_share_words == 0.0
    marks = spark.createDataFrame([("Very bad, extremely broken; refund refund",)], "text string")
    row = lexical_markers(marks).first()
    assert (row.intensifier_count, row.complaint_count) == (2, 3)
