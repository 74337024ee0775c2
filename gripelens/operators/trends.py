"""Daily averages and their moving mean per platform."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_trend(
    df: DataFrame, measures: Sequence[str], ts_col: str = "event_ts", platform_col: str = "platform"
) -> DataFrame:
    """(platform, day, n, avg_<measure>...): one tumbling day per row."""
    return (
        df.groupBy(platform_col, F.window(ts_col, "1 day").alias("w"))
        .agg(F.count("*").alias("n"), *[F.avg(m).alias(f"avg_{m}") for m in measures])
        .select(platform_col, F.col("w.start").alias("day"), "n", *[f"avg_{m}" for m in measures])
    )


def moving_trend(
    daily: DataFrame, measures: Sequence[str], rows: int = 7, platform_col: str = "platform"
) -> DataFrame:
    """Mean of the last ``rows`` daily rows; the window runs over days, not reviews."""
    recent = Window.partitionBy(platform_col).orderBy("day").rowsBetween(-(rows - 1), 0)
    return daily.select(
        platform_col, "day", *[F.avg(f"avg_{m}").over(recent).alias(f"moving_{m}") for m in measures]
    )
