"""Session-level helpers: shared folder, materialised tables, size-checked lookups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    NumericType,
    StringType,
    StructType,
)

# A lookup table is broadcast only when its payload is measured to be below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Copies of each lookup row when the table is too large to broadcast.
LOOKUP_SALTS = 16


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: source timestamps carry no zone and mean UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine, one per application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.gettempdir()}/run-{spark.sparkContext.applicationId}"


# Paths handed out by this process and not released yet.
_made: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    path = f"{shared_folder(spark)}/gripelens/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def made_paths() -> list[str]:
    """Intermediate tables and files that have not been released, oldest first."""
    return list(_made)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete intermediate data: the given paths, or all that is left.

    Results are lazy: release what a result reads only after the result is written.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in made_paths() if paths is None else paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop).delete(target, True)
        if path in _made:
            _made.remove(path)


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and continue from the files.

    Used where several passes follow an expensive plan. The files outlive lost
    executors, and later passes read only the columns they need.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end, instead of whenever the driver
    collects its garbage. For writes of large shuffles; what was written is read from then on."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def value_bytes(value: Column, kind: DataType) -> Column:
    """Size of a value: eight bytes for numbers, lengths of texts, all elements of nested types."""
    if isinstance(kind, (StringType, BinaryType)):
        size = F.coalesce(F.octet_length(value), F.lit(0)) + 16
    elif isinstance(kind, StructType):
        size = sum((value_bytes(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(8))
    elif isinstance(kind, MapType):
        keys, values = ArrayType(kind.keyType), ArrayType(kind.valueType)
        size = value_bytes(F.map_keys(value), keys) + value_bytes(F.map_values(value), values)
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, NumericType):
        size = F.size(value) * 8 + 16
    elif isinstance(kind, ArrayType):
        each = F.transform(value, lambda x: value_bytes(x, kind.elementType).cast("bigint"))
        size = F.aggregate(each, F.lit(16).cast("bigint"), lambda total, x: total + x)
    else:
        return F.lit(8).cast("bigint")
    return F.coalesce(size, F.lit(8)).cast("bigint")


def payload_bytes(df: DataFrame) -> int:
    """Measured size of a lookup table, nested values included."""
    per_row = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0))
    total = df.agg(F.sum(per_row.cast("bigint")).alias("b")).first()["b"]
    return int(total or 0)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return payload_bytes(df) <= max_bytes


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    small: bool | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Equi-join a large table with a lookup table that has unique keys.

    Within the size bound the lookup is broadcast and ``facts`` does not move.
    Beyond it both sides shuffle; natural-language terms are heavily skewed, so
    ``spread_by`` names a column (the review id) whose hash salts hot keys. The salt
    is a function of the row, so a recomputed task reproduces it.
    """
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        return facts.join(F.broadcast(lookup), on, how)
    if spread_by is None:
        return facts.join(lookup, on, how)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(LOOKUP_SALTS)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1)))
    return (
        facts.withColumn("_salt", salt)
        .join(lookup.withColumn("_salt", copies), [*([on] if isinstance(on, str) else on), "_salt"], how)
        .drop("_salt")
    )
