"""Text-shape measures as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's str.strip()/str.split() treat as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set without the space, as a Java class. The left part lets printable ASCII and the
# common letter blocks fail on two range checks before the set itself is consulted.
_OTHER_BLANK = (
    r"[[^ -~\xa1-\x{167f}]&&[\t-\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
# On cleaned text the only blank is the space.
_SENTENCE_END = r"[.!?]++(?: ++|\z)"
# A word made of end marks only; looks back only once an end mark is found.
_BARE_END = r"[.!?](?<=(?<![^ ]).)[.!?]*+(?= |\z)"
_TOKEN = r"[\p{L}']+"

SHAPE_FEATURES = (
    "review_length_words",
    "review_length_chars",
    "avg_sentence_length",
    "exclamation_count",
    "capital_ratio",
)
SENTIMENT_FEATURES = ("sentiment_polarity", "sentiment_subjectivity")
# Order in which feature tables list the seven text features.
TEXT_FEATURES = SENTIMENT_FEATURES + SHAPE_FEATURES


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def clean_text(text: Column) -> Column:
    """Any value as stripped text in which every blank is a plain space; null becomes ''.

    One pass over the characters lets all later patterns deal with a single blank.
    """
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _OTHER_BLANK, " ")
    return F.trim(plain)


def has_text(text: Column) -> Column:
    return strip(text.cast("string")) != ""


def word_count(clean: Column) -> Column:
    return F.size(F.array_remove(F.split(clean, " "), "")).cast("bigint")


def char_count(text: Column) -> Column:
    """Length in code points."""
    return F.char_length(text).cast("bigint")


def exclamation_count(text: Column) -> Column:
    kept = F.replace(text, F.lit("!"), F.lit(""))
    return (F.char_length(text) - F.char_length(kept)).cast("bigint")


def capital_ratio(text: Column) -> Column:
    upper = F.char_length(F.regexp_replace(text, r"\P{IsUppercase}+", ""))
    return upper / F.greatest(F.char_length(text), F.lit(1))


def sentence_count(clean: Column) -> Column:
    """Pieces of cleaned text between runs of ``.``, ``!`` or ``?`` that precede a blank or
    the end; empty pieces do not count."""
    return F.size(F.array_remove(F.split(clean, _SENTENCE_END, -1), "")).cast("bigint")


def avg_sentence_length(clean: Column, mode: str = "regex", words: Column | None = None) -> Column:
    """Mean words per sentence, 0.0 when there is no sentence.

    ``regex`` cuts at end marks: all words but those made of end marks only belong to some
    sentence, so no sentence needs to be cut into words. ``words`` may pass a known word
    count. ``breakiterator`` uses Spark's locale-aware ``sentences``, which also drops
    punctuation tokens.
    """
    if mode == "regex":
        total = word_count(clean) if words is None else words
        return F.coalesce(
            F.try_divide(
                (total - F.regexp_count(clean, F.lit(_BARE_END))).cast("double"), sentence_count(clean)
            ),
            F.lit(0.0),
        )
    if mode == "breakiterator":
        return F.coalesce(
            F.try_divide(
                F.size(F.flatten(F.sentences(clean))).cast("double"), F.size(F.sentences(clean))
            ),
            F.lit(0.0),
        )
    raise ValueError(f"unknown sentence mode: {mode}")


def with_shape(df: DataFrame, clean_col: str, sentence_mode: str = "regex") -> DataFrame:
    """Add the five shape features of a column that went through ``clean_text``.

    Empty text needs no special case: every expression yields 0 for it.
    """
    clean = F.col(clean_col)
    return df.withColumns(
        {
            "review_length_words": word_count(clean),
            "review_length_chars": char_count(clean),
            "exclamation_count": exclamation_count(clean),
            "capital_ratio": capital_ratio(clean),
        }
    ).withColumn(
        "avg_sentence_length",
        avg_sentence_length(clean, sentence_mode, F.col("review_length_words")),
    )


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and apostrophes."""
    lowered = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(_TOKEN), F.lit(0))


def term_count(token_array: Column, terms) -> Column:
    """Occurrences of any of a short, fixed list of terms."""
    wanted = [t.lower() for t in terms]
    return F.size(F.filter(token_array, lambda t: t.isin(wanted))).cast("bigint")
