"""Uncertainty of means and shares: Poisson bootstrap, all replicates in one pass.

In each replicate a row counts a Poisson(1) number of times. The number comes from a digest of
(seed, row id), sixteen bits for each replicate, so it is the same wherever and however
often the row is read: intervals do not depend on partitioning or on lost executors. Rows become
one array of weights in the stage that reads them and are summed by group with map-side
combination; values enter in whole millionths, so sums are exact.

Rows without group, id or value (null, not-a-number) are left out. Rows with equal ids draw the same
numbers: ids should be unique. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A number is how many of these 65,536ths of the distribution lie at or below the draw.
POISSON_STEPS = (24109, 48218, 60273, 64291, 65296, 65496, 65530)
REPLICATES = 64
_MICRO = 1_000_000


def draws(row_id: Column, replicates: int, seed: int = 33) -> list[Column]:
    """The row's weight in each replicate; a digest serves eight of them."""
    out = []
    for k in range(-(-replicates // 8)):
        digest = F.md5(F.concat(F.lit(f"{seed}:{k}:"), row_id.cast("string")))
        out += [F.conv(F.substring(digest, 1 + 4 * j, 4), 16, 10).cast("int") for j in range(8)]
    return [sum(((u >= step).cast("int") for step in POISSON_STEPS), F.lit(0)) for u in out[:replicates]]


def bootstrap_means(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    id_col: str = "review_id",
    replicates: int = REPLICATES,
    low: float = 0.025,
    high: float = 0.975,
    seed: int = 33,
) -> DataFrame:
    """(groups..., n, mean, low, high): mean of ``value`` and the percentile interval of its replicates.

    Replicates in which a group has no rows are left out of its interval.
    """
    x = F.col(value).cast("double")
    rows = df.select(*groups, F.col(id_col).alias("_id"), x.alias("_x")).dropna()
    rows = rows.select(*groups, F.round(F.col("_x") * _MICRO).cast("bigint").alias("_m"), F.array(*draws(F.col("_id"), replicates, seed)).alias("_w"))
    measures = []
    for r in range(replicates):
        w = F.get("_w", F.lit(r)).cast("bigint")
        measures += [F.sum(w).alias(f"w{r}"), F.sum(w * F.col("_m")).alias(f"s{r}")]
    total = rows.groupBy(*groups).agg(F.count("*").alias("n"), F.sum("_m").alias("_s"), *measures)
    means = F.array(*[F.try_divide(F.col(f"s{r}").cast("double"), F.col(f"w{r}")) / _MICRO for r in range(replicates)])
    ordered = F.array_sort(F.filter(means, lambda m: m.isNotNull()))

    def at(p: float) -> Column:
        place = F.lit(p) * (F.size("_o") - 1)
        below = F.floor(place).cast("int")
        a = F.get("_o", below)
        return a + (F.coalesce(F.get("_o", below + 1), a) - a) * (place - below)

    return total.withColumn("_o", ordered).select(
        *groups, "n", (F.col("_s") / F.col("n") / _MICRO).alias("mean"), at(low).alias("low"), at(high).alias("high")
    )
