"""From raw reviews to the feature table of a platform."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripelens.functions.dates import age_days, from_epoch_ms, parse_date
from gripelens.functions.text import clean_text, strip, with_shape
from gripelens.operators.cleaning import drop_missing, with_label
from gripelens.operators.sentiment import Lexicon, with_sentiment
from gripelens.plans.presets import PlatformPreset


def text_features(
    df: DataFrame,
    lexicon: Lexicon | None = None,
    id_col: str = "review_id",
    text_col: str = "text",
    sentence_mode: str = "regex",
    scorer=None,
) -> DataFrame:
    """Replace the text by its seven features; all other columns are carried along.

    Text is read once. ``scorer`` may be an Arrow ``pandas_udf`` from text to
    struct(polarity, subjectivity) for users who own a sentiment library; then no
    lexicon is needed and nothing is shuffled.
    """
    keep = [c for c in df.columns if c != text_col]
    if scorer is None:
        if lexicon is None:
            raise ValueError("give a lexicon or a scorer")
        clean = df.select(*keep, clean_text(F.col(text_col)).alias("_clean"))
        return with_sentiment(with_shape(clean, "_clean", sentence_mode), lexicon, id_col, "_clean")
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    clean = df.select(
        *keep, clean_text(F.col(text_col)).alias("_clean"), scorer(strip(raw)).alias("_score")
    )
    empty = F.col("_clean") == ""
    return (
        with_shape(clean, "_clean", sentence_mode)
        .withColumns(
            {
                "sentiment_polarity": F.when(empty, 0.0).otherwise(F.col("_score.polarity")),
                "sentiment_subjectivity": F.when(empty, 0.0).otherwise(F.col("_score.subjectivity")),
            }
        )
        .drop("_score", "_clean")
    )


def project_and_label(reviews: DataFrame, preset: PlatformPreset, id_col: str = "review_id") -> DataFrame:
    """Needed columns, rows with text, outcome rule; neutral rows go."""
    wanted = [id_col, *[c for c in preset.source_columns if c in reviews.columns]]
    return with_label(drop_missing(reviews.select(*wanted), preset.text), preset.label())


def _timestamp(preset: PlatformPreset) -> Column:
    raw = F.col(preset.age_from)
    if preset.age_format == "epoch_ms":
        return from_epoch_ms(raw)
    return parse_date(raw.cast("string"), preset.date_formats)


def add_age(df: DataFrame, preset: PlatformPreset, as_of: dt.datetime) -> DataFrame:
    """Replace the date column by ``review_age_days``; unparseable date strings drop the row."""
    if preset.age_from is None:
        return df
    dated = df.withColumn("_ts", _timestamp(preset))
    if preset.age_format == "date":
        dated = dated.where(F.col("_ts").isNotNull())
    return dated.withColumn("review_age_days", age_days(F.col("_ts"), as_of)).drop(
        "_ts", preset.age_from
    )


def build_features(
    reviews: DataFrame,
    preset: PlatformPreset,
    lexicon: Lexicon | None,
    as_of: dt.datetime,
    metadata: DataFrame | None = None,
    id_col: str = "review_id",
    sentence_mode: str = "regex",
    scorer=None,
) -> DataFrame:
    """Feature table of one platform.

    Cheap filters come before the text work. Where review metadata lives in a table of its
    own, pass it as ``metadata`` (keyed by the review id): it is joined after the
    text has become numbers, so the join moves narrow rows only.
    """
    labelled = project_and_label(reviews, preset, id_col)
    if metadata is None:
        labelled = add_age(labelled, preset, as_of)
    features = text_features(labelled, lexicon, id_col, preset.text, sentence_mode, scorer)
    if metadata is not None:
        features = add_age(features.join(metadata, id_col), preset, as_of)
    return features.select(id_col, *preset.feature_columns)
