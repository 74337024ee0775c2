"""Lexicon sentiment as a distributed join.

Each review is cut into tokens, every token keeps its two predecessors, the
token rows meet the lexicon in a broadcast join in the stage that read the text,
and only matches are aggregated back to one row per review. The text is read
once and never shuffled. Scores are summed as whole millionths, so the result
does not depend on the order in which tasks finish.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gripelens.functions.text import tokens
from gripelens.runtime import BROADCAST_BYTES, fits_broadcast, lookup_join

_MICRO = 1_000_000
_END = ""  # lexicon entry for the one extra row per review; no real token is empty


@dataclass(frozen=True)
class Lexicon:
    """Scored terms (with the end entry) and modifiers, one row per term, and whether each
    was measured to be small enough to broadcast."""

    words: DataFrame
    modifiers: DataFrame
    small_words: bool
    small_modifiers: bool

    @staticmethod
    def build(words: DataFrame, modifiers: DataFrame) -> "Lexicon":
        """``words``: term, polarity, subjectivity; several senses of a term are averaged.
        ``modifiers``: term, kind ('intensify' or 'negate'), factor."""
        words = words.groupBy(F.lower("term").alias("term")).agg(
            F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity")
        )
        end = words.sparkSession.range(1).select(
            F.lit(_END).alias("term"),
            F.lit(None).cast("double").alias("polarity"),
            F.lit(None).cast("double").alias("subjectivity"),
        )
        words = words.where(F.col("term") != _END).unionByName(end)
        modifiers = modifiers.groupBy(F.lower("term").alias("term")).agg(
            F.max(F.when(F.col("kind") == "intensify", F.col("factor"))).alias("boost"),
            F.min(F.when(F.col("kind") == "negate", F.col("factor"))).alias("flip"),
        )
        return Lexicon(words, modifiers, fits_broadcast(words), fits_broadcast(modifiers))

    @staticmethod
    def from_rows(spark: SparkSession, words, modifiers) -> "Lexicon":
        """A short word list given in code, one row per term; it becomes part of the plan."""
        words = [*words, (_END, None, None)]
        boost = {t.lower(): f for t, kind, f in modifiers if kind == "intensify"}
        flip = {t.lower(): f for t, kind, f in modifiers if kind == "negate"}
        terms = sorted(boost.keys() | flip.keys())
        number, text = pa.float64(), pa.string()
        scored = pa.table(
            {
                "term": pa.array([w[0].lower() for w in words], text),
                "polarity": pa.array([w[1] for w in words], number),
                "subjectivity": pa.array([w[2] for w in words], number),
            }
        )
        changed = pa.table(
            {
                "term": pa.array(terms, text),
                "boost": pa.array([boost.get(t) for t in terms], number),
                "flip": pa.array([flip.get(t) for t in terms], number),
            }
        )
        small_words, small_modifiers = (t.nbytes <= BROADCAST_BYTES for t in (scored, changed))
        return Lexicon(
            spark.createDataFrame(scored), spark.createDataFrame(changed), small_words, small_modifiers
        )


def _first_or_key(df: DataFrame, id_col: str, keep: list[str]) -> tuple[list[str], list[str]]:
    """Split carried columns into grouping keys (text-like) and fixed-width ones.

    Fixed-width columns can sit in a hash-aggregation buffer; text cannot, so
    it joins the grouping key.
    """
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    types = {f.name: f.dataType for f in df.schema.fields}
    buffered = [c for c in keep if c != id_col and isinstance(types[c], fixed)]
    return [id_col] + [c for c in keep if c != id_col and c not in buffered], buffered


def with_sentiment(
    df: DataFrame,
    lexicon: Lexicon,
    id_col: str = "review_id",
    text_col: str = "text",
    counts: bool = False,
) -> DataFrame:
    """Replace the text column by ``sentiment_polarity`` and ``sentiment_subjectivity``.

    All other columns are carried along; ``id_col`` must be unique. A review
    without a lexicon term scores 0.0. With ``counts``, also return how many
    terms matched and how many of them are negative words.
    """
    keep = [c for c in df.columns if c != text_col]
    keys, buffered = _first_or_key(df, id_col, keep)
    words = F.concat(F.col("_tokens"), F.array(F.lit(_END)))
    nothing = F.lit(None).cast("string")
    trail = F.arrays_zip(
        words.alias("term"),
        F.concat(F.array(nothing), F.col("_tokens")).alias("prev1"),
        F.concat(F.array(nothing, nothing), F.col("_tokens")).alias("prev2"),
    )
    spread = (
        df.select(*keep, tokens(F.col(text_col)).alias("_tokens"))
        .select(*keep, F.explode(trail).alias("_w"))
        .select(
            *keep,
            F.col("_w.term").alias("term"),
            F.col("_w.prev1").alias("prev1"),
            F.col("_w.prev2").alias("prev2"),
        )
    )
    hits = lookup_join(spread, lexicon.words, "term", "inner", lexicon.small_words, id_col)
    near = lexicon.modifiers.select(
        F.col("term").alias("prev1"), F.col("boost"), F.col("flip").alias("flip1")
    )
    far = lexicon.modifiers.select(F.col("term").alias("prev2"), F.col("flip").alias("flip2"))
    hits = lookup_join(hits, near, "prev1", "left", lexicon.small_modifiers, id_col)
    hits = lookup_join(hits, far.where("flip2 IS NOT NULL"), "prev2", "left", lexicon.small_modifiers, id_col)
    boost = F.coalesce(F.col("boost"), F.lit(1.0))
    flip = F.coalesce(F.col("flip1"), F.col("flip2"), F.lit(1.0))
    polarity = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("polarity") * boost * flip))
    subjectivity = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("subjectivity") * boost))

    def micro(score: Column) -> Column:
        # least() and greatest() skip nulls, so the end entry is excluded here.
        return F.when(F.col("polarity").isNotNull(), F.round(score * _MICRO).cast("bigint"))

    summed = hits.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in buffered],  # the same value on all rows of a review
        F.count("polarity").alias("_n"),
        F.sum(micro(polarity)).alias("_p"),
        F.sum(micro(subjectivity)).alias("_s"),
        F.count(F.when(F.col("polarity") < 0, F.lit(1))).alias("_neg"),
    )
    scored = F.col("_n") > 0
    out = [
        *[F.col(c) for c in keep],
        F.when(scored, F.col("_p") / F.col("_n") / _MICRO).otherwise(0.0).alias("sentiment_polarity"),
        F.when(scored, F.col("_s") / F.col("_n") / _MICRO).otherwise(0.0).alias("sentiment_subjectivity"),
    ]
    if counts:
        out += [F.col("_n").alias("scored_words"), F.col("_neg").alias("negative_words")]
    return summed.select(*out)


def negative_word_share(
    df: DataFrame, lexicon: Lexicon, id_col: str = "review_id", text_col: str = "text"
) -> DataFrame:
    """Negative words per review, as a share of the scored words and of all words."""
    narrow = df.select(
        id_col, text_col, F.size(tokens(F.col(text_col))).cast("bigint").alias("words")
    )
    share = with_sentiment(narrow, lexicon, id_col, text_col, counts=True)
    negative = F.col("negative_words")
    return share.select(
        id_col,
        "words",
        "scored_words",
        "negative_words",
        F.coalesce(F.try_divide(negative, F.col("scored_words")), F.lit(0.0)).alias(
            "negative_share_scored"
        ),
        F.coalesce(F.try_divide(negative, F.col("words")), F.lit(0.0)).alias("negative_share_words"),
    )
