"""Running totals over a whole table in the order of one column.

The table is range-partitioned and sorted, sums run within a partition, and a table of one row for
each partition carries them on. No window runs over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gripelens.runtime import lookup_join, materialise


def running_totals(
    table: DataFrame, by: str, measures: Sequence[str], descending: bool = False, next_col: str | None = None
) -> DataFrame:
    """Adds ``<measure>_before``: the sum over all rows that come earlier. ``by`` is unique and not
    null. ``next_col`` names the value of ``by`` in the next row, null in the last."""
    key = F.col(by).desc() if descending else F.col(by).asc()
    dealt = table.repartitionByRange(key).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id())
    placed = materialise(dealt, "in-order")
    first = F.max(by) if descending else F.min(by)
    parts = placed.groupBy("_part").agg(first.alias("_first"), *[F.sum(m).alias(f"_sum_{m}") for m in measures])
    every = Window.orderBy("_part")  # one row for each partition
    earlier = every.rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        "_part",
        F.lead("_first").over(every).alias("_after"),
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_from_{m}") for m in measures],
    )
    within = Window.partitionBy("_part").orderBy(key)
    above = within.rowsBetween(Window.unboundedPreceding, -1)
    met = lookup_join(placed, carried, "_part", small=True)
    added = {f"{m}_before": F.coalesce(F.sum(m).over(above), F.lit(0)) + F.col(f"_from_{m}") for m in measures}
    if next_col:
        added[next_col] = F.coalesce(F.lead(by).over(within), F.col("_after"))
    return met.withColumns(added).select(*table.columns, *added)
