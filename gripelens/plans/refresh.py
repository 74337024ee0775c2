"""Feature tables kept up to date: only what changed is scored, only touched partitions are replaced.

The stored table holds one row per review with a digest of the columns its features come from. A
refresh reads the incoming texts once for their digests, compares (id, digest) with the stored ones (narrow rows,
one join by id), scores new and changed reviews alone, and overwrites just the partitions in
which a review was added, changed, moved away or removed. Everything else stays as it lies in storage.

A run that is interrupted leaves some partitions new and some old. Nothing else records the state, so the
next refresh compares again and finishes the work; a second refresh with the same rows touches nothing.

Rows: ``id_col`` is unique and not null (null ids are refused). A review that the scoring drops (no text,
neutral) is stored without features, so that it is not scored again. Columns of the incoming rows
may have any name but those beginning with ``_stored``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gripelens.runtime import lookup_join, materialise, path_exists

_PART, _DIGEST, _FEATURES = "_stored_part", "_stored_digest", "_stored_features"
STATES = ("added", "changed", "removed")


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: reviews by state, reviews scored, partitions replaced."""

    added: int
    changed: int
    removed: int
    unchanged: int
    scored: int
    partitions: int


@dataclass(frozen=True)
class FeatureStore:
    """A stored feature table.

    ``partition_col`` should go with the way changes arrive (platform, month); ``buckets`` splits
    each of its values by the id, so that a hot value is not replaced whole for a few reviews.
    ``version`` names the scoring (lexicon, settings): another version scores everything again.
    """

    path: str
    score: Callable[[DataFrame], DataFrame]
    id_col: str = "review_id"
    partition_col: str | None = None
    buckets: int = 1
    version: str = "1"

    def _part(self) -> Column:
        value = F.lit("all")
        if self.partition_col:
            value = F.coalesce(F.concat(F.lit("v"), F.col(self.partition_col).cast("string")), F.lit("null"))
        bucket = F.pmod(F.xxhash64(self.id_col), F.lit(self.buckets)).cast("string")
        return F.concat_ws("-", value, bucket)

    def _digests(self, reviews: DataFrame) -> DataFrame:
        """(id, part, digest) of the incoming rows; null values and texts that look alike differ."""
        content = F.to_json(F.struct(*sorted(reviews.columns)), {"ignoreNullFields": "false"})
        known = F.when(F.col(self.id_col).isNull(), F.raise_error(F.lit(f"{self.id_col} is null"))).otherwise(content)
        return reviews.select(
            self.id_col,
            self._part().alias(_PART),
            F.sha2(F.concat_ws("\n", F.lit(self.version), known), 256).alias(_DIGEST),
        )

    def refresh(self, reviews: DataFrame) -> Refreshed:
        spark, key = reviews.sparkSession, self.id_col
        others = [f for f in self.score(reviews).schema if f.name != key]
        wide = F.struct(*[F.col(f"`{f.name}`") for f in others]).alias(_FEATURES)
        shape = T.StructType(
            [
                reviews.schema[key],
                T.StructField(_DIGEST, T.StringType()),
                T.StructField(_FEATURES, T.StructType(others)),
                T.StructField(_PART, T.StringType()),
            ]
        )
        stored = spark.read.schema(shape).parquet(self.path) if path_exists(spark, self.path) else None
        old = (spark.createDataFrame([], shape) if stored is None else stored).where(F.col(key).isNotNull())
        before = old.select(key, F.col(_PART).alias("_old_part"), F.col(_DIGEST).alias("_old_digest"))
        found = self._digests(reviews).join(before, key, "full")
        same = (F.col(_DIGEST) == F.col("_old_digest")) & (F.col(_PART) == F.col("_old_part"))
        state = (
            F.when(F.col("_old_digest").isNull(), "added")
            .when(F.col(_DIGEST).isNull(), "removed")
            .when(~same, "changed")
        )
        differing = found.withColumn("state", state).where(F.col("state").isNotNull())
        changes = materialise(differing.select(key, "state", _PART, _DIGEST, "_old_part"), "changes")
        n = {r["state"]: r["n"] for r in changes.groupBy("state").agg(F.count("*").alias("n")).collect()}
        kept = old.count() - n.get("changed", 0) - n.get("removed", 0)
        counts = {s: n.get(s, 0) for s in STATES}
        if not n:
            return Refreshed(**counts, unchanged=kept, scored=0, partitions=0)

        new = changes.where("state != 'removed'").select(key, _PART, _DIGEST)
        # Semi-join: texts of unchanged reviews go no further than the scan.
        to_score = lookup_join(reviews, new.select(key), key, "left_semi", spread_by=key)
        scored = self.score(to_score).select(key, wide)
        fresh = materialise(new.join(scored, key, "left").select(key, _DIGEST, _FEATURES, _PART), "fresh")
        parts = changes.select(F.explode(F.array(_PART, "_old_part")).alias(_PART)).where(F.col(_PART).isNotNull())
        touched = materialise(parts.distinct(), "touched")
        stay = old.join(touched, _PART, "left_semi").join(changes.select(key), key, "left_anti")
        # One row without id per touched partition: a partition that lost its last review is
        # replaced as well, since dynamic overwriting leaves partitions without rows alone.
        marks = touched.select(*[F.lit(None).cast(shape[c].dataType).alias(c) for c in shape.names[:3]], _PART)
        rows = stay.select(shape.names).unionByName(fresh).unionByName(marks)
        writer = rows.hint("rebalance", _PART).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(_PART).parquet(self.path)
        return Refreshed(**counts, unchanged=kept, scored=fresh.count(), partitions=touched.count())

    def read(self, spark: SparkSession) -> DataFrame:
        """The features of all stored reviews, as ``score`` returns them; a store that never held
        a review cannot be read."""
        table = spark.read.parquet(self.path)
        return table.where(F.col(_FEATURES).isNotNull()).select(self.id_col, f"{_FEATURES}.*")
