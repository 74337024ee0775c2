"""Quick checks of a feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelens.operators.cleaning import melt


def data_profile(df: DataFrame, label_col: str = "negative_experience") -> DataFrame:
    """One row: number of rows, of labelled rows and of negative rows."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count(label_col).alias("labelled"),
        F.count(F.when(F.col(label_col) == 1, F.lit(1))).alias("negative"),
    )


def missing_profile(df: DataFrame, top: int = 10) -> DataFrame:
    """Missing values (null, not a number) per column, most first; one pass whatever the number of columns."""
    def missing(name: str, dtype: str) -> Column:
        column = F.col("`" + name.replace("`", "``") + "`")
        return column.isNull() | F.isnan(column) if dtype in ("float", "double") else column.isNull()

    counts = df.agg(*[F.count_if(missing(c, t)).alias(c) for c, t in df.dtypes])
    return (
        melt(counts, [], df.columns, "column_name", "missing")
        .orderBy(F.col("missing").desc(), "column_name")
        .limit(top)
    )


def target_balance(df: DataFrame, label_col: str = "negative_experience") -> DataFrame:
    """Share of each outcome among labelled rows."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # over one row per outcome
    return counts.select(label_col, "n", (F.col("n") / total).alias("share"))
