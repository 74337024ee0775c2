"""Projection, cleaning and labelling of review tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripelens.functions.text import has_text


def drop_missing(df: DataFrame, column: str) -> DataFrame:
    return df.dropna(subset=[column])


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose text has a non-blank character; null text goes too."""
    return df.where(has_text(F.col(column)))


def normalise_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null to empty string and everything to string, for those columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in present})


def keep_language(df: DataFrame, code: str = "en", column: str = "lang") -> DataFrame:
    return df.where(F.col(column) == code)


def with_label(df: DataFrame, rule: Column, name: str = "negative_experience") -> DataFrame:
    """Add the outcome and keep only rows that have one."""
    return df.withColumn(name, rule).where(F.col(name).isNotNull())


def has_columns(df: DataFrame, columns: Sequence[str]) -> bool:
    return set(columns) <= set(df.columns)


def union_missing(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column absent from one frame is null there."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def tag_and_stack(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    return union_missing([df.withColumn(tag, F.lit(key)) for key, df in frames.items()])


def melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per key and column. A generator over one array: the row is read once and, unlike
    with an expand step, the generated code stays small for many columns."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in columns]
    return df.select(*keys, F.inline(F.array(*pairs)))
