"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelens.runtime import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the component's smallest node.

    Each round takes the smallest root among the neighbours, then follows it once more,
    so that paths halve. Rounds are written as tables in the shared folder: a lost
    executor repeats at most one round. Nothing is gathered: the driver sees one number
    per round.
    """
    both = materialise(
        links.select("a", "b").where(F.col("a") != F.col("b")).unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "links",
    )
    roots = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "roots"
    )
    while True:
        near = (
            both.join(roots.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        merged = near.join(roots, "node").select("node", "root", F.least("root", "near").alias("low"))
        up = roots.select(F.col("node").alias("low"), F.col("root").alias("higher"))
        new = materialise(
            merged.join(up, "low").select("node", F.least("low", "higher").alias("root"), (F.col("root") != F.least("low", "higher")).alias("moved")),
            "roots",
        )
        moved = new.where("moved").limit(1).count()
        roots = new.select("node", "root")
        if not moved:
            return roots
