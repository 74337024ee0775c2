"""Review-shaped views of the driver tables.

``documents`` gives text, platform (its source) and outcome columns; ``events`` gives
time and numeric metadata for the same id; ``labels`` gives model outcomes.
``conversations`` is a second corpus. Every view covers its tables whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelens.operators.sentiment import Lexicon
from gripelens.runtime import use_utc
from gripelens.sources.tables import read_table

AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
# Terms that occur in the invented texts.
LEXICON_ROWS = (
    ("that", 0.5, 0.6),
    ("with", 0.8, 0.75),
    ("this", -0.6, 0.9),
    ("from", -0.4, 0.3),
    ("was", -0.2, 0.4),
    ("rewh", 0.3, 1.0),
)
MODIFIER_ROWS = (("are", "intensify", 1.5), ("for", "negate", -0.5))
INTENSIFIERS = ("and", "are")
COMPLAINTS = ("from", "was")


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    return read_table(use_utc(spark), f"{sf_dir}/{name}.parquet", spread_by=spread_by)


def lexicon(spark: SparkSession) -> Lexicon:
    return Lexicon.from_rows(spark, LEXICON_ROWS, MODIFIER_ROWS)


def review_texts(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Text side: one row per document, no join. ``spread`` for queries that work on the text."""
    d = table(spark, sf_dir, "documents", "doc_id" if spread else None)
    return d.select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("platform"),
        "lang",
        "text",
        (1 + F.col("doc_id") % 5).cast("double").alias("rating"),
        (F.col("doc_id") % 5).cast("int").alias("label"),
        F.when(F.col("doc_id") % 3 == 0, "Recommended")
        .when(F.col("doc_id") % 3 == 1, "Not Recommended")
        .otherwise("")
        .alias("recommend"),
        (F.col("doc_id") % 4 != 0).alias("verified_purchase"),
    )


def review_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata side: one row per event."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(
        F.col("event_id").alias("review_id"),
        F.col("ts").alias("event_ts"),
        F.unix_millis("ts").alias("timestamp"),
        F.floor("value").cast("bigint").alias("helpful_vote"),
        F.col("user_id").alias("helpfulness"),
        F.col("value").alias("playtime"),
        F.when(F.col("event_type") == "signup", "Early Access Review")
        .otherwise("")
        .alias("early_access_review"),
        F.when(F.col("event_id") % 17 == 0, "")
        .when(F.col("event_id") % 17 == 1, "soon")
        .when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "MMM d, yyyy"))
        .alias("post_date"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    negative = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.select(
        F.col("doc_id").alias("review_id"),
        F.when(negative, 1).otherwise(0).cast("int").alias("negative_experience"),
    )


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second corpus: one row per conversation turn, with a 0-4 label."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("review_id"),
        "role",
        ((F.col("conv_id") + F.col("turn")) % 5).cast("int").alias("label"),
        "text",
    )
