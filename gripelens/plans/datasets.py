"""From a raw source to a stored review sample, per platform.

Raw sources have no key. ``with_review_id`` gives one: the digest of the row's content, then
the row's place in the read, which only tells equal rows apart. Samples are drawn by the
content part, so they do not depend on how the files were split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gripelens.operators.cleaning import drop_blank, drop_missing, keep_language, normalise_strings
from gripelens.operators.language import LanguageModel, detect_language
from gripelens.operators.sampling import find_cuts, sample_by_key, sample_files
from gripelens.runtime import lookup_join, release
from gripelens.sources import tables

AMAZON_ROWS, AMAZON_BUFFER, AMAZON_SEED = 10_000, 100_000, 42  # fixed values
OTHER_ROWS, OTHER_SEED = 25_000, 33  # fixed values
STEAM_STRINGS = ("user", "post_date", "recommend", "early_access_review")  # text columns of the source


def with_review_id(df: DataFrame, name: str = "review_id", beside: tuple[str, ...] = ()) -> DataFrame:
    """Adds a unique text key. Rows are neither moved nor compared; columns of ``beside`` (where
    the row was found) are not content."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns if c not in beside]
    content = F.md5(F.concat_ws("\x1f", *values))
    place = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    return df.withColumn(name, F.concat(content, place))


def sample_key(review_id: Column, seed: int) -> Column:
    """Order of a sample: seeded digest of the content, equal rows by their place."""
    content, place = F.substring(review_id, 1, 32), F.substring(review_id, 33, 16)
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), content)), place)


def with_position(df: DataFrame, name: str = "position", from_files: bool = False) -> DataFrame:
    """Adds the row's place, counted from 0 without gaps.

    ``from_files``: the place in the source, files in the order of their names. Splits are read in
    another order (Spark takes large ones first, and joins small files), so rows are counted
    by split, file and block; the counters are one row for each of these.
    """
    file, block = ("_metadata.file_path", "_metadata.file_block_start") if from_files else (F.lit(""), F.lit(0))
    found = [F.col(file).alias("_file"), F.col(block).alias("_block")] if from_files else [file.alias("_file"), block.alias("_block")]
    mark = F.monotonically_increasing_id()
    marked = df.select(*df.columns, *found, mark.alias("_mark")).withColumn("_split", F.shiftright("_mark", 33))
    part = ["_split", "_file", "_block"]
    sizes = marked.groupBy(*part).agg(F.count("*").alias("_n"), F.min("_mark").alias("_first"))
    before = Window.orderBy("_file", "_block", "_split").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    placed = lookup_join(marked, sizes.select(*part, offset.alias("_offset")), part)
    return placed.withColumn(name, F.col("_offset") + F.col("_mark")).drop(*part, "_mark", "_offset")


def _stored(df: DataFrame, out_path: str) -> DataFrame:
    tables.write_snapshot(df, out_path)
    return tables.read_snapshot(df.sparkSession, out_path)


def create_amazon(
    spark: SparkSession,
    path: str,
    out_path: str,
    n: int = AMAZON_ROWS,
    buffer: int = AMAZON_BUFFER,
    seed: int = AMAZON_SEED,
    schema: str = tables.AMAZON_SCHEMA,
) -> DataFrame:
    """``n`` reviews from the first ``buffer + n`` of a JSON lines source."""
    reviews = with_position(with_review_id(tables.read_json_reviews(spark, path, schema)), from_files=True)
    head = reviews.where(F.col("position") < buffer + n).drop("position")
    return _stored(sample_by_key(head, n, sample_key(F.col("review_id"), seed)), out_path)


def create_yelp(
    spark: SparkSession, path: str, out_path: str, n: int = OTHER_ROWS, seed: int = OTHER_SEED
) -> DataFrame:
    """``n`` reviews drawn from a typed table."""
    reviews = with_review_id(tables.read_table(spark, path))
    return _stored(sample_by_key(reviews, n, sample_key(F.col("review_id"), seed)), out_path)


def create_steam(
    spark: SparkSession,
    path: str,
    raw_path: str,
    out_path: str,
    language: LanguageModel,
    n: int = OTHER_ROWS,
    seed: int = OTHER_SEED,
    game: Callable[[DataFrame], Column] = lambda df: F.element_at(F.split(df["file"], "/"), -1),
    schema: str = tables.STEAM_SCHEMA,
) -> DataFrame:
    """Reviews of a folder of CSV files, one file per game, whole files until ``n`` is met.

    The folder is copied to parquet once (``raw_path``). Eligible are rows with text whose
    predicted language is English. Languages are found file by file in the order of the
    sample, a growing batch of files at a time, until the batch holds enough: the rest of
    the folder is never scored. ``game`` names the cluster of a row, its file by default, for the seeded order.
    """
    raw = with_review_id(tables.read_csv_folder(spark, path, schema), beside=("file",))
    raw = raw.withColumn("game", game(raw))
    stored = _stored(drop_blank(drop_missing(raw, "review"), "review"), raw_path)
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col("game")))

    def eligible(reviews: DataFrame) -> DataFrame:
        found = detect_language(reviews, language, "review_id", "review")
        english = keep_language(found.select("review_id", "lang_detected"), "en", "lang_detected")
        return reviews.join(english.select("review_id"), "review_id", "left_semi")

    sizes = stored.groupBy(order.alias("order")).agg(F.count("*").alias("rows"))
    wanted = 2 * n
    tried: list[str] = []
    while True:
        upto = _reach(sizes, wanted)
        batch = stored if upto is None else stored.where(order <= upto)
        path_of_batch = f"{out_path}-eligible-{wanted}"
        tried.append(path_of_batch)
        fit = _stored(eligible(batch), path_of_batch)
        if upto is None or fit.count() >= n:
            break
        wanted *= 4
    sample = sample_files(fit, n, "review_id", "game", seed, key=sample_key(F.col("review_id"), seed))
    made = _stored(normalise_strings(sample, STEAM_STRINGS).drop("file"), out_path)
    release(spark, tried)
    return made


def _reach(sizes: DataFrame, wanted: int) -> str | None:
    """The file order up to which files hold ``wanted`` rows; None if all together do not."""
    keys = sizes.select(F.lit(0).alias("stratum"), F.col("order").alias("key"), F.col("rows").alias("weight"))
    cut = find_cuts(keys, {0: wanted})[0]
    return cut.key if cut else None
