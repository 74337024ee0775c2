"""Review sources and result sinks on Spark's file formats."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw columns per source.
AMAZON_SCHEMA = (
    "rating double, text string, helpful_vote bigint, verified_purchase boolean, timestamp bigint"
)
STEAM_SCHEMA = (
    "user string, playtime double, post_date string, helpfulness double, review string, "
    "recommend string, early_access_review string"
)
YELP_SCHEMA = "label int, text string"
COEF_SCHEMA = "feature string, coef double"


def read_json_reviews(spark: SparkSession, path: str, schema: str = AMAZON_SCHEMA) -> DataFrame:
    """JSON lines; only the fields of ``schema`` are parsed, and no inference pass runs."""
    return spark.read.schema(schema).json(path)


def read_table(
    spark: SparkSession, path: str, merge_schema: bool = False, spread_by: str | None = None
) -> DataFrame:
    """Typed columnar reviews; ``merge_schema`` unites files with different columns.

    ``spread_by`` names the unique key. If the files give fewer splits than there are cores
    (small data, or files with few row groups), rows are spread by that key, so that text work
    uses all cores; a later grouping by the same key then needs no further shuffle. A table with
    enough splits is read as it is.
    """
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread_by and df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores, spread_by)
    return df


def _csv_reader(spark: SparkSession):
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
    )


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every CSV file. Lines are scanned once, and those of
    later blocks are dropped in the scan stage."""
    lines = (
        spark.read.option("pathGlobFilter", "*.csv")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
            F.ltrim(F.col("value"), F.lit("\ufeff")).alias("value"),
        )
        .where(F.col("block") == 0)
    )
    return lines.groupBy("file").agg(F.min_by("value", "position").alias("header"))


def read_csv_folder(
    spark: SparkSession,
    path: str,
    schema: str = STEAM_SCHEMA,
    file_col: str | None = "file",
    same_layout: bool = False,
) -> DataFrame:
    """All ``*.csv`` of a folder, as one scan per column layout.

    Files may lack columns or order them differently: a column of ``schema`` that a file
    does not have is null, one that is not in ``schema`` is left out. Finding the layouts
    takes one scan of the lines; ``same_layout`` skips that and takes ``schema``
    in file order. Texts may span lines, so a file is read by one task: snapshot large
    files to parquet first.
    """
    wanted = spark.createDataFrame([], schema).schema
    extra = [F.col("_metadata.file_path").alias(file_col)] if file_col else []
    if same_layout:
        return _csv_reader(spark).schema(wanted).csv(path).select(*wanted.names, *extra)
    first = _headers(spark, path).persist()  # one short row per file
    try:
        layouts = sorted(r["header"] for r in first.select("header").distinct().collect())
        if not layouts:
            raise FileNotFoundError(f"no CSV files in {path}")
        if len(layouts) == 1:
            files = {layouts[0]: path}
        else:
            files = {h: [r["file"] for r in first.where(F.col("header") == h).collect()] for h in layouts}
    finally:
        first.unpersist()
    parts = []
    for header in layouts:
        names = next(csv.reader([header]))
        as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        columns = [
            (F.col(f"`{f.name}`") if f.name in names else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
        parts.append(_csv_reader(spark).schema(as_text).csv(files[header]).select(*columns, *extra))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def write_snapshot(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "errorifexists"):
    """Collect once, reuse: a parquet copy, optionally one folder per platform."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = 0):
    """CSV export that survives quotes and line breaks in texts; many part files, of at most
    ``rows_per_file`` rows if that is not 0."""
    df.write.mode(mode).option("header", True).option("maxRecordsPerFile", rows_per_file).option("quoteAll", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def write_coefs(coefs: DataFrame, path: str, mode: str = "errorifexists"):
    """Coefficient table as CSV, ascending by coefficient."""
    coefs.orderBy("coef", "feature").write.mode(mode).option("header", True).csv(path)


def read_coefs(spark: SparkSession, paths: Mapping[str, str], missing: str = "skip") -> DataFrame:
    """(platform, feature, coef) from one CSV per platform.

    ``missing``: 'skip' leaves absent files out, 'error' raises on the first one.
    """
    if missing not in ("skip", "error"):
        raise ValueError("missing must be 'skip' or 'error'")
    stacked = None
    for platform, path in paths.items():
        try:
            part = spark.read.schema(COEF_SCHEMA).option("header", True).csv(path)
        except AnalysisException:
            if missing == "error":
                raise FileNotFoundError(path) from None
            continue
        part = part.select(F.lit(platform).alias("platform"), "feature", "coef")
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is None:
        return spark.createDataFrame([], "platform string, feature string, coef double")
    return stacked
