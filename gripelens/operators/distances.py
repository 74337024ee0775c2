"""How far apart the distributions of platforms are: Kolmogorov-Smirnov and Wasserstein.

Rows reduce to distinct values with one count per platform; the cumulative distributions of all
platforms then grow side by side over the union of values (``running_totals``). The
largest difference of two of them is the Kolmogorov-Smirnov statistic, the area between
them the first Wasserstein distance. Exact; a group is never gathered.

Rows without a platform or value (nulls, not-a-number) are left out. The result has a row for
each pair of platforms, so there should be hundreds of them at most. Infinite values give no
finite Wasserstein distance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelens.operators.distributions import value_counts
from gripelens.operators.running import running_totals

SCHEMA = "platform_a string, platform_b string, n_a bigint, n_b bigint, ks double, wasserstein double"


def platform_distances(df: DataFrame, value: str, platform_col: str = "platform") -> DataFrame:
    """(platform_a, platform_b, n_a, n_b, ks, wasserstein) for all pairs a < b."""
    counts = value_counts(df, [platform_col], value).where(~F.isnan("x"))
    counts = counts.withColumn("x", F.col("x") + F.lit(0.0))  # one zero
    sizes = {r[platform_col]: r["n"] for r in counts.groupBy(platform_col).agg(F.sum("n").alias("n")).collect()}
    names = sorted(sizes)
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], SCHEMA)
    columns = [f"n{i}" for i in range(len(names))]
    side = counts.groupBy("x").agg(
        *[F.sum(F.when(F.col(platform_col) == n, F.col("n")).otherwise(0)).alias(c) for n, c in zip(names, columns)]
    )
    grown = running_totals(side, "x", columns, next_col="_next")
    shares = F.array(*[(F.col(f"{c}_before") + F.col(c)) / F.lit(sizes[n]) for n, c in zip(names, columns)])
    pairs = F.array(*[F.array(F.lit(a), F.lit(b)) for a in range(len(names)) for b in range(a + 1, len(names))])
    each = grown.select((F.col("_next") - F.col("x")).alias("width"), shares.alias("_f")).select(
        "width", "_f", F.explode(pairs).alias("p")
    )
    gap = F.abs(F.get("_f", F.col("p")[0]) - F.get("_f", F.col("p")[1]))
    found = each.groupBy("p").agg(
        F.max(gap).alias("ks"), F.coalesce(F.sum(gap * F.col("width")), F.lit(0.0)).alias("wasserstein")
    )
    known = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(sizes[n]).cast("bigint").alias("n")) for n in names])
    a, b = (F.get(known, F.col("p")[i]) for i in (0, 1))
    return found.select(
        a["name"].alias("platform_a"), b["name"].alias("platform_b"), a["n"].alias("n_a"), b["n"].alias("n_b"),
        "ks", "wasserstein",
    )
