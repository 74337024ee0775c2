"""Distributions that grow: mergeable summaries per day and group, refined to exact quantiles.

A summary has one row for each group, day and bucket of the value: how many rows, the smallest and the
largest value. Buckets grow by the factor BASE on either side of zero, so a quantile read from
a summary is off by less than BASE - 1 of its size, and its rank by less than the rows of its bucket; both
bounds are in the result of ``brackets``. Summaries of days, files or clusters add up: merged they
equal the summary of all rows, whatever the order, so a new day is one more small table.

``refine`` makes a bracketed quantile exact by a second pass that keeps only rows in the buckets that
hold a wanted rank. Values there are counted before they are ordered, so a common value is one
row, and no group is gathered.

Rows without a group, day or value (null, not-a-number) are left out; infinite values have buckets
of their own. An empty table gives an empty summary and no quantiles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelens.runtime import lookup_join

BASE = 1.02
_TINY = 1e-300  # sizes below it share the bucket of zero
_FAR = 1 << 30


def bucket(x: Column) -> Column:
    """Number of a value's bucket; it never falls as the value grows."""
    size = F.floor((F.log(F.abs(x)) - math.log(_TINY)) / math.log(BASE)).cast("int") + 1
    number = F.when(F.abs(x) == float("inf"), _FAR).when(F.abs(x) < _TINY, 0).otherwise(size)
    return F.when(x < 0, -number).otherwise(number)


def _valued(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    rows = df.select(*keys, F.col(value).cast("double").alias("x")).dropna(subset=[*keys, "x"])
    return rows.withColumn("bucket", bucket(F.col("x")))


def summarise(df: DataFrame, groups: Sequence[str], value: str, day_col: str = "day") -> DataFrame:
    """(groups..., day, bucket, n, low, high), to be stored and added to."""
    keys = [*groups, day_col]
    return _valued(df, keys, value).groupBy(*keys, "bucket").agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )


def merge(summaries: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups..., bucket, n, low, high): summaries of any parts, added up by ``groups``."""
    return summaries.groupBy(*groups, "bucket").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def brackets(merged: DataFrame, groups: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(groups..., rows, p, fraction, side, rank, bucket, low, high): for either neighbour of each
    quantile its rank within the bucket that holds it, and the bounds of its value. Windows run
    over a group's buckets, some thousands at most."""
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = merged.withColumn("_upto", F.sum("n").over(upto)).withColumn("rows", F.sum("n").over(whole))
    asked = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    position = F.col("p") * (F.col("rows") - 1)
    below = F.floor(position).cast("bigint")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), below.alias("rank")),
        F.struct(F.lit(1).alias("side"), F.least(below + 1, F.col("rows") - 1).alias("rank")),
    )
    before = F.col("_upto") - F.col("n")
    return (
        placed.withColumn("p", asked)
        .withColumn("fraction", position - below)
        .withColumn("_s", F.explode(sides))
        .where((F.col("_s.rank") >= before) & (F.col("_s.rank") < F.col("_upto")))
        .select(
            *groups, "rows", "p", "fraction", "_s.side", (F.col("_s.rank") - before).alias("rank"), "bucket", "low", "high"
        )
    )


def approximate(merged: DataFrame, groups: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(groups..., p, rows, low, high): bounds of each quantile from the summary alone."""
    found = brackets(merged, groups, probabilities)
    return found.groupBy(*groups, "p").agg(
        F.max("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def refine(
    df: DataFrame, merged: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float]
) -> DataFrame:
    """(groups..., p, rows, quantile): exact, by linear interpolation, from the rows in the brackets."""
    wanted = brackets(merged, groups, probabilities).drop("low", "high")
    # At most two ranks for each quantile and group: one list per bucket that holds any.
    lists = wanted.groupBy(*groups, "bucket").agg(
        F.collect_list(F.struct("p", "side", "rank", "fraction", "rows")).alias("_ranks")
    )
    inside = lookup_join(_valued(df, groups, value), lists, [*groups, "bucket"], "left_semi", spread_by="x")
    counts = inside.groupBy(*groups, "bucket", "x").agg(F.count("*").alias("k"))
    upto = Window.partitionBy(*groups, "bucket").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = counts.withColumn("_upto", F.sum("k").over(upto)).join(lists, [*groups, "bucket"])
    hits = ordered.select(*groups, "x", "k", "_upto", F.inline("_ranks")).where(
        (F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("k"))
    )
    low, high = (F.max(F.when(F.col("side") == s, F.col("x"))) for s in (0, 1))
    fraction = F.max("fraction")
    between = F.when((fraction == 0) | (low == high), low).otherwise(low + (high - low) * fraction)
    return hits.groupBy(*groups, "p").agg(F.max("rows").alias("rows"), between.alias("quantile"))
