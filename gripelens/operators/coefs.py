"""Coefficient tables: ranking, naming and the cross-platform matrix.

These tables have (platforms x features) rows; windows and pivots over them are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gripelens.functions.names import display_name, sentence_name, title_name


def sort_by_coef(coefs: DataFrame) -> DataFrame:
    return coefs.orderBy("coef", "feature")


def rank_by_importance(coefs: DataFrame) -> DataFrame:
    return coefs.orderBy(F.abs("coef").desc(), "feature")


def orders_within(coefs: DataFrame, platform_col: str = "platform") -> DataFrame:
    """Adds both orders of a platform's coefficients: ``place`` (ascending) and ``importance`` (by size)."""
    own = Window.partitionBy(platform_col)
    return coefs.withColumns(
        {
            "place": F.row_number().over(own.orderBy("coef", "feature")),
            "importance": F.row_number().over(own.orderBy(F.abs("coef").desc(), "feature")),
        }
    )


def top_coefs(coefs: DataFrame, n: int = 8, platform_col: str = "platform") -> DataFrame:
    """The ``n`` largest coefficients by absolute value per platform, with readable names."""
    order = Window.partitionBy(platform_col).orderBy(F.abs("coef").desc(), "feature")
    return (
        coefs.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select(
            platform_col,
            display_name(F.col(platform_col)).alias("dataset"),
            "rank",
            title_name(F.col("feature")).alias("feature"),
            "coef",
        )
    )


def with_display_names(df: DataFrame, key_col: str, name: str = "display_name") -> DataFrame:
    return df.withColumn(name, display_name(F.col(key_col)))


def key_matrix(
    coefs: DataFrame, platforms: Sequence[str], n: int = 8, fill: float | None = 0.0
) -> DataFrame:
    """Features x platforms for the ``n`` features with the largest absolute
    coefficient anywhere, in ascending order of that value (``rank`` 1 = smallest).

    ``coefs`` has platform, feature, coef. Names that become equal after cleaning share
    a row and the first raw name gives the value. A missing pair becomes ``fill``.
    """
    named = coefs.select("platform", "feature", sentence_name(F.col("feature")).alias("name"), "coef")
    top = (
        named.groupBy("name")
        .agg(F.max(F.abs("coef")).alias("strength"))
        .orderBy(F.col("strength").desc(), "name")
        .limit(n)
    )
    cells = (
        named.join(F.broadcast(top.select("name")), "name", "left_semi")  # n rows
        .groupBy("name", "platform")
        .agg(F.min_by("coef", "feature").alias("coef"))
    )
    wide = cells.groupBy("name").pivot("platform", list(platforms)).agg(F.max("coef"))
    if fill is not None:
        wide = wide.fillna(fill, subset=list(platforms))
    size = F.greatest(F.lit(0.0), *[F.abs(F.col(f"`{p}`")) for p in platforms])  # skips nulls
    rank = F.row_number().over(Window.orderBy("_size", F.col("name").desc()))  # n rows
    return (
        wide.withColumn("_size", size)
        .withColumn("rank", rank)
        .select("rank", F.col("name").alias("feature"), *[F.col(f"`{p}`") for p in platforms])
        .orderBy("rank")
    )
