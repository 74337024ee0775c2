"""Exact grouped quantiles, winsorised summaries and densities.

A group may hold a third of all rows, so no group is ever gathered. Rows are first
reduced to distinct values with counts (map-side combined; hot groups spread over
their values). Quantile ranks are then located with coarse, order-preserving buckets of the
value: its logarithm together with its place between the group's extremes, so that
wide and narrow ranges both spread. Cumulative counts run over the buckets of a group
(some thousands at most), and only the values inside the buckets that hold a wanted rank
are ordered. Values are never rounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelens.runtime import lookup_join, materialise

LOW, HIGH = 0.01, 0.99  # fixed values: winsorising quantiles
MEDIAN = 0.5
# Groups of up to so many different values are ordered by one aggregate each, so few groups are broadcast.
_AT_ONCE, _FEW = 200_000, 20_000
_PER_E_FOLD = 256  # buckets per factor e: neighbouring bounds differ by 0.4 percent
_FINEST = 1e6
_PLACES = 4096


def value_counts(
    df: DataFrame, groups: Sequence[str], value: str, digits: int | None = None
) -> DataFrame:
    """(groups..., x, n): distinct values of a group with their counts.

    Rows without a value or without a group are left out.
    """
    x = F.col(value).cast("double")
    if digits is not None:
        x = F.round(x, digits)
    return (
        df.select(*groups, x.alias("x"))
        .dropna(subset=[*groups, "x"])
        .groupBy(*groups, "x")
        .agg(F.count("*").alias("n"))
    )


def _bucket(x: Column, least: Column, most: Column) -> Column:
    """Two parts, both growing with the value: logarithm, and place between the extremes."""
    size = F.floor(F.log1p(F.abs(x) * _FINEST) * _PER_E_FOLD)
    place = F.floor((x / 2 - least / 2) / F.nullif(most / 2 - least / 2, F.lit(0.0)) * _PLACES)
    return F.struct(
        F.coalesce(F.when(x < 0, -size).otherwise(size), F.lit(0)).alias("size"), F.coalesce(place, F.lit(0)).alias("place")
    )


def group_quantiles(
    counts: DataFrame, groups: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """(groups..., n_rows, q0, q1, ...) by linear interpolation between order statistics."""
    groups = list(groups)
    ends = counts.groupBy(*groups).agg(F.min("x").alias("_least"), F.max("x").alias("_most"))
    counts = lookup_join(counts, ends, groups, spread_by="x")
    counts = counts.withColumn("_bucket", _bucket(F.col("x"), F.col("_least"), F.col("_most"))).drop("_least", "_most")
    by_group = Window.partitionBy(*groups)
    running = by_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (
        counts.groupBy(*groups, "_bucket")
        .agg(F.sum("n").alias("here"))
        .withColumn("_before", F.sum("here").over(running) - F.col("here"))
        .withColumn("n_rows", F.sum("here").over(by_group))
    )
    position = F.col("p") * (F.col("n_rows") - 1)
    low = F.floor(position).cast("bigint")
    wanted = (
        buckets.withColumn(
            "_t",
            F.explode(
                F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)])
            ),
        )
        .select(*groups, "_bucket", "_before", "here", "n_rows", "_t.q", "_t.p")
        .withColumn("fraction", position - low)
        .withColumn(
            "_side",
            F.explode(
                F.array(
                    F.struct(F.lit(0).alias("side"), low.alias("rank")),
                    F.struct(
                        F.lit(1).alias("side"), F.least(low + 1, F.col("n_rows") - 1).alias("rank")
                    ),
                )
            ),
        )
        .select("*", "_side.side", "_side.rank")
        .where((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("here")))
        .select(*groups, "_bucket", "n_rows", "q", "side", "fraction", (F.col("rank") - F.col("_before")).alias("rank"))
    )
    # At most two ranks per probability and bucket, so the list is short; it lets the counts
    # be joined once, before their running sum.
    per_bucket = wanted.groupBy(*groups, "_bucket").agg(
        F.max("n_rows").alias("n_rows"),
        F.collect_list(F.struct("q", "side", "fraction", "rank")).alias("_ranks"),
    )
    within = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy("x")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        lookup_join(counts, materialise(per_bucket, "wanted-ranks"), [*groups, "_bucket"], spread_by="x")
        .withColumn("_upto", F.sum("n").over(within))
        .select(*groups, "n_rows", "x", "n", "_upto", F.inline("_ranks"))
        .where((F.col("_upto") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("_upto")))
    )

    def pick(i: int) -> Column:
        def at(side: int, column: str) -> Column:
            return F.max(F.when((F.col("q") == i) & (F.col("side") == side), F.col(column)))

        return at(0, "x") + (at(1, "x") - at(0, "x")) * at(0, "fraction")

    return found.groupBy(*groups).agg(
        F.max("n_rows").alias("n_rows"),
        *[pick(i).alias(f"q{i}") for i in range(len(probabilities))],
    )


def winsorised_counts(
    df: DataFrame, groups: Sequence[str], value: str, low: float = LOW, high: float = HIGH
) -> DataFrame:
    """Value counts with each value clipped to its group's quantiles, plus the bounds.

    The counts are read by several branches, so they are written once: what lies before them
    (text work, usually) runs once whatever the optimiser decides to share. If no group has
    many different values (which one small job tells), an exact percentile aggregate over the
    counts finds the bounds inside the final job; otherwise ranks are located in buckets.
    """
    groups = list(groups)
    counts = materialise(value_counts(df, groups, value), "value-counts")
    sizes = counts.groupBy(*groups).agg(F.count("*").alias("k")).agg(F.max("k").alias("k"), F.count("*").alias("g")).first()
    if (sizes["k"] or 0) <= _AT_ONCE and sizes["g"] <= _FEW:
        exact = F.percentile("x", [low, MEDIAN, high], F.col("n"))
        bounds = counts.groupBy(*groups).agg(F.sum("n").alias("n_rows"), exact.alias("_q")).select(
            *groups, "n_rows", *[F.get("_q", F.lit(i)).alias(c) for i, c in enumerate(("lower", "median", "upper"))]
        )
        return lookup_join(counts, bounds, groups, small=True).withColumn(
            "clipped", F.greatest(F.col("lower"), F.least(F.col("upper"), F.col("x")))
        )
    bounds = group_quantiles(counts, groups, (low, MEDIAN, high)).select(
        *groups, "n_rows", F.col("q0").alias("lower"), F.col("q1").alias("median"), F.col("q2").alias("upper")
    )
    bounds = materialise(bounds, "bounds")  # one row per group, measured and joined
    return lookup_join(counts, bounds, groups, spread_by="x").withColumn(
        "clipped", F.greatest(F.col("lower"), F.least(F.col("upper"), F.col("x")))
    )


def trimmed_distribution(
    df: DataFrame, groups: Sequence[str], value: str, low: float = LOW, high: float = HIGH
) -> DataFrame:
    """Count, mean, median, minimum and maximum per group after clipping to quantiles.

    Clipping keeps order, so the median is that of the raw values and the
    extrema are the quantiles themselves.
    """
    clipped = winsorised_counts(df, groups, value, low, high)
    return clipped.groupBy(*groups).agg(
        F.max("n_rows").alias("n"),
        (F.sum(F.col("clipped") * F.col("n")) / F.sum("n")).alias("mean"),
        F.max("median").alias("median"),
        F.max("lower").alias("min"),
        F.max("upper").alias("max"),
    )


def violin_density(
    df: DataFrame, groups: Sequence[str], value: str, bins: int = 20, low: float = LOW, high: float = HIGH
) -> DataFrame:
    """Per group and bin of the clipped range: count, share and a smoothed density.

    The density is a Gaussian kernel estimate at the bin centre over the binned
    values, with Scott's bandwidth ``sd * n ** (-1/5)``. A group with a single
    value has one bin and no density.
    """
    groups = list(groups)
    clipped = winsorised_counts(df, groups, value, low, high)
    width = (F.col("upper") - F.col("lower")) / bins
    offset = F.when(width > 0, F.floor((F.col("clipped") - F.col("lower")) / width)).otherwise(0)
    binned = (
        clipped.withColumn("bin", F.least(offset, F.lit(bins - 1)).cast("bigint"))
        .groupBy(*groups, "bin")
        .agg(
            F.sum("n").alias("n"),
            F.max("n_rows").alias("n_rows"),
            F.max("lower").alias("lower"),
            F.max("upper").alias("upper"),
            F.sum(F.col("clipped") * F.col("n")).alias("_s1"),
            F.sum(F.col("clipped") * F.col("clipped") * F.col("n")).alias("_s2"),
        )
    )
    whole = Window.partitionBy(*groups)  # at most ``bins`` rows
    size = F.col("n_rows")
    spread = (F.sum("_s2").over(whole) - F.pow(F.sum("_s1").over(whole), F.lit(2)) / size) / F.nullif(size - 1, F.lit(0))
    centre = F.col("lower") + (F.col("bin") + 0.5) * width
    binned = binned.withColumns(
        {
            "centre": centre,
            "bandwidth": F.when(
                (size > 1) & (F.col("upper") > F.col("lower")),
                F.sqrt(F.greatest(spread, F.lit(0.0))) * F.pow(size.cast("double"), F.lit(-0.2)),
            ),
        }
    )
    # Each bin adds its kernel mass to every centre of its own group's fixed grid.
    grid = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("at")
    mass = (
        binned.where(F.col("bandwidth") > 0)
        .select("*", grid)
        .withColumn("_z", (F.col("bin") - F.col("at")) * width / F.col("bandwidth"))
        .groupBy(*groups, F.col("at").cast("bigint").alias("bin"))
        .agg(
            F.sum(
                F.col("n") * F.exp(F.lit(-0.5) * F.col("_z") * F.col("_z")) / (F.col("bandwidth") * size)
            ).alias("_mass")
        )
    )
    return binned.join(mass, [*groups, "bin"], "left").select(
        *groups,
        "bin",
        "centre",
        "n",
        (F.col("n") / size).alias("share"),
        (F.col("_mass") / F.sqrt(F.lit(2.0) * F.pi())).alias("density"),
    )
