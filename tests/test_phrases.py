"""Phrases against a plain scan of every text."""

import random
import re

import pytest

from gripelens.operators.phrases import PhraseBook, phrase_counts, phrase_sentiment
from gripelens.operators.sentiment import Lexicon, with_sentiment

BOOK = [
    ("good", "praise", 0.8, 0.5), ("not good", "complaint", -0.5, 0.6), ("not good at all", "complaint", -0.9, 0.9),
    ("at all", None, None, None), ("All Good", "praise", 0.6, None), ("money back", "complaint", None, None), ("!!", "x", 1.0, 1.0),
]
MODIFIERS = [("very", "intensify", 1.5), ("never", "negate", -0.5)]
SCHEMA = "phrase string, kind string, polarity double, subjectivity double"


def plain(text):
    """Matches (start, entry) by trying the longest phrase at every token."""
    words = re.findall(r"[^\W\d_']+(?:['\w]*)|'+", (text or "").lower())
    table = {tuple(p.lower().split()): (k, a, b) for p, k, a, b in BOOK if p != "!!"}
    found, i = [], 0
    while i < len(words):
        for n in (4, 3, 2, 1):
            if tuple(words[i : i + n]) in table and i + n <= len(words):
                found.append((i, table[tuple(words[i : i + n])]))
                i += n
                break
        else:
            i += 1
    return words, found


@pytest.fixture(scope="module")
def reviews(spark):
    rnd = random.Random(1)
    names = ["good", "not", "at", "all", "money", "back", "very", "never", "x", "y"]
    texts = [" ".join(rnd.choices(names, k=rnd.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "good", "not good at", "very not good at all good", "money " * 3000 + "back"]
    return spark.createDataFrame(list(enumerate(texts)), "review_id int, text string").repartition(4)


@pytest.mark.parametrize("small", [True, False])
def test_counts_and_scores_equal_a_plain_scan(spark, reviews, small):
    book = PhraseBook.build(spark.createDataFrame(BOOK, SCHEMA))
    assert book.lengths == (1, 2, 4) and book.small
    book = PhraseBook(book.table, book.lengths, small)
    lexicon = Lexicon.from_rows(spark, [], MODIFIERS)
    texts = {r.review_id: r.text for r in reviews.collect()}
    counts = {r.review_id: r for r in phrase_counts(reviews, book, ["complaint", "praise"]).collect()}
    moods = {r.review_id: r for r in phrase_sentiment(reviews, book, lexicon).collect()}
    assert counts.keys() == moods.keys() == texts.keys()
    for i, text in texts.items():
        words, found = plain(text)
        kinds = [k for _, (k, _, _) in found]
        assert (counts[i].matches, counts[i].complaint_count, counts[i].praise_count) == (
            len(found), kinds.count("complaint"), kinds.count("praise")
        )
        polarity = []
        for at, (_, p, _) in found:
            if p is not None:
                boost = 1.5 if at and words[at - 1] == "very" else 1
                flip = -0.5 if "never" in words[max(at - 2, 0) : at] else 1
                polarity.append(max(-1, min(1, p * boost * flip)))
        assert moods[i].scored_units == len(polarity)
        assert moods[i].sentiment_polarity == pytest.approx(sum(polarity) / len(polarity) if polarity else 0, abs=1e-6)


def test_single_words_score_as_the_word_lexicon_does(spark, reviews):
    words = [("good", 0.8, 0.5), ("all", -0.3, 0.9), ("x", 0.1, 0.2)]
    lexicon = Lexicon.from_rows(spark, words, MODIFIERS)
    book = PhraseBook.build(spark.createDataFrame([(w, None, p, s) for w, p, s in words], SCHEMA))
    both = with_sentiment(reviews, lexicon).alias("a").join(phrase_sentiment(reviews, book, lexicon).alias("b"), "review_id")
    same = "abs(a.sentiment_polarity - b.sentiment_polarity) < 1e-9 AND abs(a.sentiment_subjectivity - b.sentiment_subjectivity) < 1e-9"
    assert both.where(same).count() == reviews.count()


def test_no_phrases_and_no_reviews(spark, reviews):
    book = PhraseBook.build(spark.createDataFrame([], SCHEMA))
    assert {r.matches for r in phrase_counts(reviews, book, ["a"]).collect()} == {0}
    assert phrase_counts(reviews.limit(0), book, ["a"]).count() == 0
