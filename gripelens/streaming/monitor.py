"""Watch incoming reviews: share of negative reviews per time window, and alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gripelens.operators.cleaning import drop_missing
from gripelens.operators.sentiment import Lexicon
from gripelens.plans.features import add_age, text_features
from gripelens.plans.presets import PlatformPreset
from gripelens.runtime import path_exists

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_review_stream(
    spark: SparkSession, path: str, schema, file_pattern: str = "*.parquet", files_per_trigger: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", file_pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def negative_share(
    reviews: DataFrame,
    ts_col: str = "event_ts",
    id_col: str = "review_id",
    platform_col: str = "platform",
    label_col: str = "negative_experience",
    window: str = "1 day",
    slide: str | None = None,
    lateness: str = "1 day",
) -> DataFrame:
    """(platform, window_start, n, negative, share), for a stream or a batch.

    Repeated ids are counted once. A stream remembers ids for ``lateness`` and keeps one row per
    platform and window; a window is emitted after the watermark passed it, and later rows are
    dropped (``late_rows`` counts them). A batch has no such limits.
    """
    if reviews.isStreaming:
        unique = reviews.withWatermark(ts_col, lateness).dropDuplicatesWithinWatermark([id_col])
    else:
        unique = reviews.dropDuplicates([id_col])
    bucket = F.window(ts_col, window, slide) if slide else F.window(ts_col, window)
    return (
        unique.where(F.col(label_col).isNotNull())
        .groupBy(platform_col, bucket.alias("w"))
        .agg(F.count("*").alias("n"), F.sum(F.col(label_col).cast("bigint")).alias("negative"))
        .select(
            platform_col,
            F.col("w.start").alias("window_start"),
            "n",
            "negative",
            (F.col("negative") / F.col("n")).alias("share"),
        )
    )


def alerts(shares: DataFrame, threshold: float, min_reviews: int = 1) -> DataFrame:
    """Windows whose negative share is above the threshold."""
    return shares.where((F.col("share") > threshold) & (F.col("n") >= min_reviews))


def drain_to_table(stream: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Store what is there now and was not stored before; return all that is stored.

    Rows are stored as they come, one folder per batch, which a retried batch replaces. No row
    is too late for this: windows over the stored table are a batch job (``negative_share``
    of the result), so the outcome depends neither on the order of the files nor on how
    many of them make a batch.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={epoch}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    query.awaitTermination()
    spark = stream.sparkSession
    if not path_exists(spark, out_path):  # nothing has come yet
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(out_path)


def watch(
    shares: DataFrame, out_path: str, checkpoint: str, state_partitions: int | None = None, once: bool = False
) -> StreamingQuery:
    """The live job: append each window to ``out_path`` once the watermark has closed it.

    ``state_partitions`` is fixed by the first run of a checkpoint; it defaults to one per core.
    Timers and named states need a store with column families, which Spark's default lacks: a
    session that has not chosen another gets RocksDB for this query.
    """
    conf = shares.sparkSession.conf
    store = conf.get(STATE_STORE)
    batch_partitions = conf.get("spark.sql.shuffle.partitions")
    if state_partitions is None:
        state_partitions = shares.sparkSession.sparkContext.defaultParallelism
    writer = (
        shares.writeStream.outputMode("append").format("parquet")
        .option("path", out_path).option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    try:
        # A query copies the settings when it starts; batch jobs keep their own number.
        conf.set("spark.sql.shuffle.partitions", state_partitions)
        if store.endswith(".HDFSBackedStateStoreProvider"):
            conf.set(STATE_STORE, ROCKSDB)
        return writer.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", batch_partitions)
        conf.set(STATE_STORE, store)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the recent batches of a live job dropped because their window was closed."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )


def score_incoming(
    stream: DataFrame,
    preset: PlatformPreset,
    lexicon: Lexicon,
    pipeline: PipelineModel,
    as_of: dt.datetime,
    out_path: str,
    checkpoint: str,
    keep_ts: str,
) -> DataFrame:
    """Predict the outcome of incoming, still unlabelled reviews and store (id, time, prediction).

    Each micro-batch runs the same text jobs as the batch feature table, so no state is kept.
    A batch writes its own folder and replaces it when it is retried. The stored table can
    be read as a stream again, for ``negative_share``.
    """

    def score(batch: DataFrame, epoch: int) -> None:
        timed = batch.withColumn("event_ts", F.col(keep_ts))
        dated = add_age(drop_missing(timed, preset.text), preset, as_of)
        features = text_features(dated, lexicon, "review_id", preset.text)
        pipeline.transform(features).select(
            "review_id", "event_ts", F.col("prediction").cast("int").alias("negative_experience")
        ).write.mode("overwrite").parquet(f"{out_path}/batch={epoch}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(score)
        .start()
    )
    query.awaitTermination()
    schema = stream.select(
        F.col("review_id"), F.col(keep_ts).alias("event_ts"), F.lit(0).alias("negative_experience")
    ).schema
    spark = stream.sparkSession
    if not path_exists(spark, out_path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(out_path).drop("batch")
