"""Exact histogram of encoded lengths, and what follows from it for every context limit.

Documents are encoded in the task that reads them and only their lengths leave it: one
counter per distinct length and task. The number of distinct lengths is at most the
longest length, so everything after the histogram is small. Sums over all longer lengths
are taken in two steps, within blocks of lengths and over the blocks' totals, so that no
task sees the whole histogram.

A null or empty text has length 0 and counts as a document; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024


def length_histogram(df: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """(length, docs) for each length that occurs; null lengths count as 0."""
    length = F.coalesce(F.col(length_col), F.lit(0)).cast("bigint")
    return df.select(length.alias("length")).groupBy("length").agg(F.count("*").alias("docs"))


def length_table(histogram: DataFrame) -> DataFrame:
    """Adds to each length L: tokens of its documents, documents and tokens of at least L
    (suffix sums), documents of at most L, the total when each document is cut to L
    tokens, and the tokens which that cut loses."""
    rows = histogram.select(
        "length",
        "docs",
        (F.col("length") * F.col("docs")).alias("tokens"),
        F.floor(F.col("length") / BLOCK).alias("block"),
    )
    totals = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    # One row per block of 1,024 lengths: the longest document's length bounds their number.
    longer = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    after = totals.select(
        "block",
        F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("t_after"),
        F.sum("d").over(every).alias("d_all"),
        F.sum("t").over(every).alias("t_all"),
    )
    inside = (
        Window.partitionBy("block")
        .orderBy(F.col("length").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = rows.join(after, "block").select(
        "length",
        "docs",
        "tokens",
        (F.sum("docs").over(inside) + F.col("d_after")).alias("docs_from"),
        (F.sum("tokens").over(inside) + F.col("t_after")).alias("tokens_from"),
        "d_all",
        "t_all",
    )
    kept = F.col("t_all") - F.col("tokens_from") + F.col("length") * F.col("docs_from")
    return joined.select(
        "length",
        "docs",
        "tokens",
        "docs_from",
        "tokens_from",
        (F.col("d_all") - F.col("docs_from") + F.col("docs")).alias("docs_upto"),
        kept.alias("kept_tokens"),
        (F.col("t_all") - kept).alias("lost_tokens"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, kept_tokens) for any limits, present as a length or not."""
    limit = F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("context_limit")
    rows = histogram.select("length", "docs", limit)
    return rows.groupBy("context_limit").agg(
        F.sum(F.when(F.col("length") > F.col("context_limit"), F.col("docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.least("length", "context_limit") * F.col("docs")).alias("kept_tokens"),
    )


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of documents does not exceed."""
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    total = F.col("docs_from") + F.col("docs_upto") - F.col("docs")
    rows = table.select("length", "docs_upto", total.alias("total"), share)
    return (
        rows.where(F.col("docs_upto") >= F.ceil(F.col("share") * F.col("total")))
        .groupBy("share")
        .agg(F.min("length").alias("length"))
    )
