"""Breaks in daily series: penalised least squares over segments, exact.

A series is one platform's days, so its length is bounded by the calendar and not by the number
of reviews: reviews become one row per platform and day where they are read, and only those rows
are grouped by platform. Calendar gaps become days without reviews. They count as days of
a segment and carry no weight, and no segment starts with one.

Of all divisions of a series into segments of at least ``min_days`` days, the one with the least
sum over segments of (weighted squared distances of the day averages from the segment's
average) + penalty is returned; of equally good starts of a segment the earliest. A series shorter than
``min_days`` is one segment. The penalty is ``strength`` * noise * ln(days), the noise being estimated
from neighbouring days with reviews. Rows without platform form a series of their own; rows
without day or measure are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Measures are summed as whole millionths, so that sums do not depend on the order of tasks.
_MICRO = 1_000_000
# Costs that differ by less than this part of the series' total squares are equal.
_TIE = 1e-9


def daily_sums(
    df: DataFrame, measure: str, ts_col: str = "event_ts", platform_col: str = "platform"
) -> DataFrame:
    """(platform, day, n, total): one row per platform and calendar day between the platform's
    first and last, days without reviews included; total in millionths."""
    value = F.col(measure).cast("double")
    found = df.where(value.isNotNull() & ~F.isnan(value) & F.col(ts_col).isNotNull())
    daily = found.groupBy(F.col(platform_col).alias("platform"), F.to_date(ts_col).alias("day")).agg(
        F.count("*").alias("n"), F.sum(F.round(value * _MICRO).cast("bigint")).alias("total")
    )
    coming = F.lead("day").over(Window.partitionBy("platform").orderBy("day"))
    until = F.coalesce(F.date_sub(coming, 1), F.col("day"))
    spans = daily.withColumn("until", until)
    days = spans.select("platform", "day", "n", "total", F.explode(F.sequence("day", "until")).alias("on"))
    first = F.col("on") == F.col("day")
    return days.select(
        "platform",
        F.col("on").alias("day"),
        F.when(first, F.col("n")).otherwise(0).alias("n"),
        F.when(first, F.col("total")).otherwise(0).alias("total"),
    )


def best_starts(n: np.ndarray, total: np.ndarray, strength: float, min_days: int) -> list[int]:
    """First day numbers of the best segments of one series (day 0 has reviews).

    ``best[t]`` is the least cost of the days before t. A start s that costs more up to a later
    start t than ``best[t]`` can never be the last one of a best division once t may be, and is dropped.
    """
    days = len(n)
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(n > 0, total / n / _MICRO, 0.0)
    weight = np.concatenate([[0], np.cumsum(n)]).astype(float)
    level = np.concatenate([[0.0], np.cumsum(n * mean)])
    square = np.concatenate([[0.0], np.cumsum(n * mean * mean)])

    def cost(s, t):
        return square[t] - square[s] - (level[t] - level[s]) ** 2 / (weight[t] - weight[s])

    full = np.flatnonzero(n > 0)
    near = np.diff(mean[full]) ** 2 / (1 / n[full][1:] + 1 / n[full][:-1])
    penalty = strength * (float(near.mean()) if len(near) else 0.0) * np.log(max(days, 2))
    tie = _TIE * max(float(square[-1]), 1.0)
    best = np.full(days + 1, np.inf)
    best[0] = -penalty
    before = np.zeros(days + 1, dtype=int)
    starts = np.array([0])
    for t in range(min_days, days + 1):
        new = t - min_days
        if new > 0 and n[new] > 0 and np.isfinite(best[new]):
            starts = np.append(starts[best[starts] + cost(starts, new) <= best[new] + tie], new)
        costs = best[starts] + cost(starts, t) + penalty
        before[t] = starts[np.flatnonzero(costs <= costs.min() + tie)[0]]
        best[t] = costs.min()
    found, t = [], days if days >= min_days else 0
    while t > 0:
        t = int(before[t])
        found.append(t)
    return found[::-1] or [0]


def trend_breaks(
    df: DataFrame,
    measure: str,
    ts_col: str = "event_ts",
    platform_col: str = "platform",
    strength: float = 3.0,
    min_days: int = 3,
) -> DataFrame:
    """(platform, segment, first_day, last_day, days, n, level, shift): the segments of every
    platform's daily averages; ``shift`` is the level's change from the segment before (null for the first)."""
    if min_days < 1 or strength <= 0:
        raise ValueError("min_days must be at least 1 and strength above 0")

    def cut(series: pd.DataFrame) -> pd.DataFrame:
        series = series.sort_values("day", ignore_index=True)
        n, total = series["n"].to_numpy(np.int64), series["total"].to_numpy(np.int64)
        starts = best_starts(n, total, strength, min_days)
        number = np.searchsorted(starts, np.arange(len(n)), side="right")
        return series.assign(segment=number)[["platform", "day", "segment", "n", "total"]]

    daily = daily_sums(df, measure, ts_col, platform_col)
    kind = daily.schema["platform"].dataType.simpleString()
    cuts = daily.groupBy("platform").applyInPandas(
        cut, f"platform {kind}, day date, segment int, n bigint, total bigint"
    )
    segments = cuts.groupBy("platform", "segment").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count("*").alias("days"),
        F.sum("n").alias("n"),
        (F.sum("total") / F.sum("n") / _MICRO).alias("level"),
    )
    previous = F.lag("level").over(Window.partitionBy("platform").orderBy("segment"))
    return segments.withColumn("shift", F.col("level") - previous)
