"""End-user comparisons across platforms and outcome groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelens.functions.names import DISPLAY_NAMES
from gripelens.operators.cleaning import has_columns, melt, tag_and_stack
from gripelens.operators.distributions import trimmed_distribution


def negative_polarity(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(platform, sentiment_polarity) of negative reviews from all frames that have
    the needed columns; frames without them are left out."""
    needed = ("sentiment_polarity", "negative_experience")
    usable = {
        DISPLAY_NAMES.get(key, key): df.where(F.col("negative_experience") == 1).select("sentiment_polarity")
        for key, df in frames.items()
        if has_columns(df, needed)
    }
    if not usable:
        return _nothing("platform string, sentiment_polarity double")
    return tag_and_stack(usable, "platform")


def _nothing(schema: str) -> DataFrame:
    return SparkSession.getActiveSession().createDataFrame([], schema)


def sentiment_by_platform(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Distribution summary of the polarity of negative reviews per platform."""
    return trimmed_distribution(negative_polarity(frames), ["platform"], "sentiment_polarity")


def outcome_group(key: str) -> Column | None:
    """Grouping key of a platform: stars, or the recommendation; None if there is none."""
    if key.startswith("amazon"):
        return F.bround(F.nanvl(F.col("rating").cast("double"), F.lit(None)), 0).cast("int").cast("string")
    if key == "yelp":
        return (F.col("label") + 1).cast("int").cast("string")
    if key == "steam":
        return F.col("recommend")
    return None


def outcome_columns(key: str) -> tuple[str, ...]:
    return {"yelp": ("label",), "steam": ("recommend",)}.get(key, ("rating",))


def sentiment_by_outcome(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Distribution summary of polarity per dataset and outcome group.

    All datasets are stacked first and summarised in one job. A dataset of unknown kind has
    no outcome group and is left out, as is one without the needed columns.
    """
    grouped = {
        key: df.select(outcome_group(key).alias("outcome"), "sentiment_polarity")
        for key, df in frames.items()
        if outcome_group(key) is not None and has_columns(df, (*outcome_columns(key), "sentiment_polarity"))
    }
    schema = "dataset string, outcome string, sentiment_polarity double"
    stacked = tag_and_stack(grouped, "dataset") if grouped else _nothing(schema)
    return trimmed_distribution(stacked, ["dataset", "outcome"], "sentiment_polarity")


def feature_distribution(
    features: DataFrame, measures: Sequence[str], platform_col: str = "platform"
) -> DataFrame:
    """Distribution summary of several features of negative reviews per platform."""
    numbers = features.where(F.col("negative_experience") == 1).select(
        platform_col, *[F.col(m).cast("double").alias(m) for m in measures]
    )
    long = melt(numbers, [platform_col], measures, "feature", "value")
    return trimmed_distribution(long, [platform_col, "feature"], "value")

