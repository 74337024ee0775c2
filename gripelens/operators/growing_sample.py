"""Samples that follow the inflow: the k lowest hashes of every stratum, kept beside the data.

The sample of a stratum is its ``k`` rows with the lowest seeded digest of the id. Lowest rows
of parts are all that the lowest of the whole can be among, so the kept table is a mergeable
summary: adding new rows needs the kept rows and the new ones only, and after any
additions the sample equals the one drawn from all rows at once.

Each task drops all but the ``k`` lowest rows of a stratum before the shuffle (Spark does this for
limits up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1,000 by default; ``k`` beyond
that is refused, ``sampling`` finds cuts without a window). A row that comes again replaces
itself. Rows without a stratum or id are left out; an empty addition changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gripelens.operators.sampling import hash_key

LARGEST = 1000


def lowest(rows: DataFrame, stratum_col: str, id_col: str, k: int, seed: int = 33) -> DataFrame:
    """The sample of ``rows``, with the columns of ``rows``."""
    if not 0 < k <= LARGEST:
        raise ValueError(f"k must be between 1 and {LARGEST}")
    known = rows.where(F.col(stratum_col).isNotNull() & F.col(id_col).isNotNull())
    key = hash_key(F.col(id_col), seed)
    order = Window.partitionBy(stratum_col).orderBy("_key")
    ranked = known.withColumn("_key", key).withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= k).drop("_key", "_rank")


def add(kept: DataFrame, new: DataFrame, stratum_col: str, id_col: str, k: int, seed: int = 33) -> DataFrame:
    """The sample after ``new`` rows have come."""
    drawn = lowest(new.dropDuplicates([id_col]), stratum_col, id_col, k, seed)
    others = kept.join(drawn.select(id_col), id_col, "left_anti").select(*kept.columns)
    return lowest(others.unionByName(drawn.select(*kept.columns)), stratum_col, id_col, k, seed)
