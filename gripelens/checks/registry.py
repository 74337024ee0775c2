"""One query per operator, each over whole driver tables.

Doubles are rounded to six decimals and times are given as text, so that results can be
compared by value between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelens.checks import views as v
from gripelens.functions import text as tx
from gripelens.functions.dates import age_days, from_epoch_ms, parse_date
from gripelens.functions.labels import label_rating, label_recommend
from gripelens.functions.names import display_name
from gripelens.operators import cleaning, coefs, distributions, encode, language, markers
from gripelens.operators import metrics, profile, sampling, sentiment, trends
from gripelens.plans import datasets, platform_model, reports
from gripelens.plans.features import build_features, text_features
from gripelens.plans.presets import PRESETS
from gripelens.runtime import fresh_path, lookup_join, materialise, use_utc
from gripelens.sources import tables
from gripelens.streaming import monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

COEF_FEATURES = tx.TEXT_FEATURES
SOURCES = tuple(f"src{i}" for i in range(20))
STREAM_THRESHOLD = 0.5
CSV_ROWS = 20_000  # a CSV file with texts over several lines is read by one task


def query(arg):
    """Register a query under its function name, or under the name given."""
    if callable(arg):
        QUERIES[arg.__name__] = arg
        return arg

    def named(fn: Query) -> Query:
        QUERIES[arg] = fn
        return fn

    return named


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f"`{n}`"), 6).alias(n) if t == "double" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def as_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


# ---- shared inputs -------------------------------------------------------------


def amazon_features(spark: SparkSession, sf: str) -> DataFrame:
    meta = v.review_metadata(spark, sf).select("review_id", "helpful_vote", "timestamp")
    texts = v.review_texts(spark, sf, spread=True)
    return build_features(texts, PRESETS["amazon_beauty"], v.lexicon(spark), v.AS_OF, meta)


def steam_features(spark: SparkSession, sf: str) -> DataFrame:
    meta = v.review_metadata(spark, sf).select(
        "review_id", "playtime", "helpfulness", "early_access_review", "post_date"
    )
    texts = v.review_texts(spark, sf, spread=True).withColumnRenamed("text", "review")
    return build_features(texts, PRESETS["steam"], v.lexicon(spark), v.AS_OF, meta)


def yelp_features(spark: SparkSession, sf: str) -> DataFrame:
    return build_features(v.chats(spark, sf), PRESETS["yelp"], v.lexicon(spark), v.AS_OF)


def all_text_features(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    texts = v.review_texts(spark, sf, spread=True).select("review_id", "text", *keep)
    return text_features(texts, v.lexicon(spark))


def labelled_features(spark: SparkSession, sf: str) -> DataFrame:
    """Text features of all documents that have a model outcome."""
    texts = v.review_texts(spark, sf, spread=True).select(
        "review_id", "text", "platform", "verified_purchase", "rating"
    )
    outcomes = v.outcomes(spark, sf)
    return text_features(keep_ids(texts, outcomes), v.lexicon(spark)).join(outcomes, "review_id")


def keep_ids(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the wanted reviews only, before any text work."""
    ids = wanted.select("review_id").distinct()
    return lookup_join(texts, ids, "review_id", "left_semi", spread_by="review_id")


def correlation_coefs(spark: SparkSession, sf: str) -> DataFrame:
    """(platform, feature, coef): correlation of each text feature with the outcome."""
    y = F.col("negative_experience").cast("double")

    def correlation(column: str) -> Column:
        # corr() raises on a constant column under ANSI rules; here it is simply absent.
        x = F.col(column).cast("double")
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    wide = (
        labelled_features(spark, sf)
        .groupBy("platform")
        .agg(*[correlation(c).alias(f"num_scaler__{c}") for c in COEF_FEATURES])
    )
    names = [f"num_scaler__{c}" for c in COEF_FEATURES]
    long = cleaning.melt(wide, ["platform"], names, "feature", "coef")
    return long.where(F.col("coef").isNotNull()).withColumn("coef", F.round("coef", 6))


# ---- sources and sinks -----------------------------------------------------------


@query
def scan_json(spark, sf):
    path = fresh_path(spark, "reviews-json")
    columns = ("review_id", "rating", "text", "verified_purchase")
    v.review_texts(spark, sf).select(*columns).write.json(path)
    schema = "review_id bigint, rating double, text string, verified_purchase boolean"
    return tables.read_json_reviews(spark, path, schema)


@query
def create_amazon(spark, sf):
    """JSON lines in the order of the ids -> a sample of the head."""
    path, columns = fresh_path(spark, "amazon-json"), ("rating", "text", "verified_purchase")
    docs = v.review_texts(spark, sf)  # several files, whose names follow the ids
    docs.repartitionByRange(6, "review_id").sortWithinPartitions("review_id").select(*columns).write.json(path)
    schema = "rating double, text string, verified_purchase boolean"
    out = fresh_path(spark, "amazon")
    made = datasets.create_amazon(spark, path, out, n=60, buffer=100, schema=schema)
    return made.select(*columns, F.substring("review_id", 1, 32).alias("content"))


@query
def create_yelp(spark, sf):
    path, out = fresh_path(spark, "yelp-source"), fresh_path(spark, "yelp")
    v.review_texts(spark, sf).select("rating", "text").write.parquet(path)
    made = datasets.create_yelp(spark, path, out, n=80)
    return made.select("rating", "text", F.substring("review_id", 1, 32).alias("content"))


@query
def create_steam(spark, sf):
    """CSV files, clusters by platform -> English by prediction -> whole clusters until the target."""
    path = fresh_path(spark, "steam-csv")
    docs = v.review_texts(spark, sf)
    rows = docs.select(F.col("text").alias("review"), "recommend", F.col("platform").alias("user"))
    tables.write_csv(rows, path, rows_per_file=CSV_ROWS)
    counts = materialise(language.gram_counts(docs), "gram-counts")
    stored = fresh_path(spark, "language-model")
    language.LanguageModel.from_counts(counts).save(stored)
    model = language.LanguageModel.load(spark, stored)
    made = datasets.create_steam(
        spark, path, fresh_path(spark, "steam-raw"), fresh_path(spark, "steam"), model, n=70,
        game=lambda df: F.col("user"), schema="review string, recommend string, user string",
    )
    return made.select("user", "review", "recommend")


@query
def scan_parquet(spark, sf):
    return v.table(spark, sf, "documents")


@query
def scan_csv_dir(spark, sf):
    """Two column layouts in one folder: documents without a user, chats without a verdict."""
    path = fresh_path(spark, "reviews-csv")
    docs = v.review_texts(spark, sf).select(F.col("text").alias("review"), "recommend", "platform")
    turns = v.chats(spark, sf).select(F.col("role").alias("user"), F.col("text").alias("review"))
    tables.write_csv(docs, path)
    tables.write_csv(turns, path, mode="append")
    return tables.read_csv_folder(spark, path, file_col=None).select(
        "user", "review", "recommend", "post_date"
    )


@query
def union_missing_cols(spark, sf):
    docs = v.review_texts(spark, sf).select(
        F.col("review_id").cast("string").alias("review_id"), "platform", "rating"
    )
    turns = v.chats(spark, sf).select("review_id", "role", "label")
    return cleaning.union_missing([docs, turns])


@query
def snapshot_roundtrip(spark, sf):
    path = fresh_path(spark, "snapshot")
    tables.write_snapshot(v.review_texts(spark, sf), path)
    return tables.read_snapshot(spark, path)


@query
def csv_roundtrip(spark, sf):
    path = fresh_path(spark, "export")
    df = v.review_texts(spark, sf).select("review_id", "rating", "verified_purchase", "text")
    tables.write_csv(df, path)
    return tables.read_csv(
        spark, path, "review_id bigint, rating double, verified_purchase boolean, text string"
    )


@query
def features_roundtrip(spark, sf):
    path = fresh_path(spark, "features")
    tables.write_snapshot(all_text_features(spark, sf, "platform"), path, partition_by="platform")
    return rounded(tables.read_snapshot(spark, path))


@query
def scan_coefs(spark, sf):
    path = fresh_path(spark, "coefs")
    correlation_coefs(spark, sf).repartition("platform").sortWithinPartitions("coef").write.partitionBy(
        "platform"
    ).option("header", True).csv(path)
    paths = {s: f"{path}/platform={s}" for s in (*SOURCES, "absent")}
    return rounded(tables.read_coefs(spark, paths, missing="skip"))


@query
def coef_files(spark, sf):
    """The coefficient sink: one file per platform, read back."""
    found = correlation_coefs(spark, sf)
    stored = materialise(found, "coefs")
    paths = {r["platform"]: fresh_path(spark, "coefs") for r in stored.select("platform").distinct().collect()}
    for platform, path in paths.items():
        tables.write_coefs(stored.where(F.col("platform") == platform).select("feature", "coef"), path)
    return rounded(tables.read_coefs(spark, paths, missing="error"))


@query
def coef_order(spark, sf):
    """Every platform's coefficients in ascending order and by their size."""
    return rounded(coefs.orders_within(correlation_coefs(spark, sf)))


# ---- sampling ----------------------------------------------------------------------


@query
def sample_bounded(spark, sf):
    docs = v.review_texts(spark, sf).select("review_id", "platform", "rating")
    return sampling.sample_bounded(docs, 100, "review_id", buffer=400)


@query
def sample_uniform(spark, sf):
    events = v.table(spark, sf, "events").select("event_id", "event_type", "value")
    return rounded(sampling.sample_uniform(events, 400, "event_id"))


@query
def sample_cluster(spark, sf):
    docs = v.review_texts(spark, sf).select("review_id", "platform", "lang", "rating")
    return sampling.sample_files(cleaning.keep_language(docs), 120, "review_id", "platform")


@query
def stratified_split(spark, sf):
    return sampling.stratified_split(v.outcomes(spark, sf), "negative_experience", "review_id")


# ---- projection, cleaning, labels ------------------------------------------------------


@query
def preset_project(spark, sf):
    reviews = v.review_texts(spark, sf).join(v.review_metadata(spark, sf), "review_id")
    return reviews.select("review_id", *PRESETS["amazon_beauty"].source_columns)


@query
def clean_reviews(spark, sf):
    docs = v.review_texts(spark, sf).select("review_id", "platform", "text")
    kept = cleaning.drop_blank(cleaning.drop_missing(docs, "text"), "text")
    return kept.select("review_id", "platform", tx.strip(F.col("text")).alias("text"))


@query("label_rating")
def label_rating_stars(spark, sf):
    docs = v.review_texts(spark, sf).select("review_id", "rating")
    return cleaning.with_label(docs, label_rating(F.col("rating")))


@query("label_recommend")
def label_recommendation(spark, sf):
    docs = v.review_texts(spark, sf).select("review_id", "recommend")
    return cleaning.with_label(docs, label_recommend(F.col("recommend")))


@query
def label_zero_based(spark, sf):
    docs = v.review_texts(spark, sf)
    return docs.select(
        "review_id",
        "label",
        label_rating(F.col("label")).alias("as_is"),
        label_rating(F.col("label"), offset=1).alias("as_stars"),
    )


@query
def lang_filter(spark, sf):
    docs = v.review_texts(spark, sf).select("review_id", "platform", "lang")
    return cleaning.keep_language(docs, "en")


@query
def normalise_strings(spark, sf):
    labels = v.table(spark, sf, "labels").withColumnRenamed("doc_id", "review_id")
    docs = v.review_texts(spark, sf).select("review_id", "recommend")
    wide = docs.join(labels, "review_id", "left")
    return cleaning.normalise_strings(wide, ["recommend", "quality", "toxic", "user"])


# ---- dates -------------------------------------------------------------------------------


@query
def parse_dates(spark, sf):
    meta = v.review_metadata(spark, sf).select("review_id", "post_date")
    dated = meta.withColumn("parsed", parse_date(F.col("post_date")))
    return dated.where(F.col("parsed").isNotNull()).withColumn("parsed", as_text(F.col("parsed")))


@query
def review_age(spark, sf):
    meta = v.review_metadata(spark, sf)
    return meta.select(
        "review_id", age_days(from_epoch_ms(F.col("timestamp")), v.AS_OF).alias("review_age_days")
    )


# ---- text ----------------------------------------------------------------------------------


@query
def text_shape(spark, sf):
    docs = v.review_texts(spark, sf, spread=True)
    clean = docs.select("review_id", tx.clean_text(F.col("text")).alias("clean"))
    return rounded(tx.with_shape(clean, "clean").drop("clean", "avg_sentence_length"))


@query
def sentence_stats(spark, sf):
    docs = v.review_texts(spark, sf, spread=True)
    clean = docs.select("review_id", tx.clean_text(F.col("text")).alias("clean"))
    return rounded(
        clean.select(
            "review_id",
            tx.sentence_count(F.col("clean")).alias("sentences"),
            tx.avg_sentence_length(F.col("clean")).alias("avg_sentence_length"),
        )
    )


@query
def sentence_stats_bi(spark, sf):
    docs = v.review_texts(spark, sf, spread=True)
    clean = docs.select("review_id", tx.clean_text(F.col("text")).alias("clean"))
    length = tx.avg_sentence_length(F.col("clean"), mode="breakiterator")
    return rounded(clean.select("review_id", length.alias("avg_sentence_length")))


@query
def sentiment_lexicon(spark, sf):
    docs = v.review_texts(spark, sf, spread=True).select("review_id", "text")
    return rounded(sentiment.with_sentiment(docs, v.lexicon(spark)))


@query("text_features")
def text_feature_table(spark, sf):
    return rounded(all_text_features(spark, sf))


@query
def negative_word_share(spark, sf):
    docs = v.review_texts(spark, sf, spread=True)
    return rounded(sentiment.negative_word_share(docs, v.lexicon(spark)))


@query
def lexical_markers(spark, sf):
    docs = v.review_texts(spark, sf, spread=True).select("review_id", "text")
    marked = markers.lexical_markers(docs, "text", v.INTENSIFIERS, v.COMPLAINTS)
    return marked.drop("text")


@query
def lang_profiles(spark, sf):
    counts = language.gram_counts(v.review_texts(spark, sf, spread=True))
    return rounded(language.smoothed_profiles(materialise(counts, "gram-counts")))


@query
def lang_detect(spark, sf):
    docs = v.review_texts(spark, sf, spread=True)
    counts = materialise(language.gram_counts(docs), "gram-counts")
    model = language.LanguageModel.from_counts(counts)
    return rounded(language.detect_language(docs, model))


# ---- feature tables --------------------------------------------------------------------------


@query
def features_amazon(spark, sf):
    return rounded(amazon_features(spark, sf))


@query
def features_steam(spark, sf):
    return rounded(steam_features(spark, sf))


@query
def features_yelp(spark, sf):
    return rounded(yelp_features(spark, sf))


# ---- profiles and distributions ------------------------------------------------------------------


def _profiled(spark, sf):
    docs = v.review_texts(spark, sf).select("review_id", "rating", "recommend")
    wide = docs.join(v.outcomes(spark, sf), "review_id", "left")
    return wide.withColumn("recommend", F.nullif(F.col("recommend"), F.lit("")))


@query
def data_profile(spark, sf):
    return profile.data_profile(_profiled(spark, sf))


@query
def missing_profile(spark, sf):
    return profile.missing_profile(_profiled(spark, sf))


@query
def target_balance(spark, sf):
    return rounded(profile.target_balance(_profiled(spark, sf)))


def _polarity(spark, sf):
    docs = v.review_texts(spark, sf, spread=True).select("review_id", "platform", "text")
    return sentiment.with_sentiment(docs, v.lexicon(spark))


@query
def trimmed_distribution(spark, sf):
    return rounded(
        distributions.trimmed_distribution(_polarity(spark, sf), ["platform"], "sentiment_polarity")
    )


@query
def violin_density(spark, sf):
    return rounded(
        distributions.violin_density(_polarity(spark, sf), ["platform"], "sentiment_polarity")
    )


@query
def sentiment_by_platform(spark, sf):
    return rounded(
        reports.sentiment_by_platform(
            {
                "amazon_beauty": amazon_features(spark, sf),
                "steam": steam_features(spark, sf),
                "yelp": yelp_features(spark, sf),
                "no_features": v.review_metadata(spark, sf),
            }
        )
    )


@query
def sentiment_by_outcome(spark, sf):
    frames = {
        "amazon_beauty": amazon_features(spark, sf),
        "steam": steam_features(spark, sf),
        "yelp": yelp_features(spark, sf),
    }
    return rounded(reports.sentiment_by_outcome(frames))


@query
def feature_distribution(spark, sf):
    docs = v.review_texts(spark, sf, spread=True).select("review_id", "platform", "text")
    outcomes = v.outcomes(spark, sf)
    marked = markers.lexical_markers(keep_ids(docs, outcomes), "text", v.INTENSIFIERS, v.COMPLAINTS)
    features = text_features(marked, v.lexicon(spark)).join(outcomes, "review_id")
    measures = ("review_length_words", "sentiment_subjectivity", "intensifier_count", "capital_ratio")
    return rounded(reports.feature_distribution(features, measures))


# ---- coefficients -------------------------------------------------------------------------------------


@query
def top_coefs(spark, sf):
    return rounded(coefs.top_coefs(correlation_coefs(spark, sf), n=5))


@query
def key_matrix(spark, sf):
    return rounded(coefs.key_matrix(correlation_coefs(spark, sf), SOURCES, n=5))


@query
def display_names(spark, sf):
    key = F.element_at(
        F.array(*[F.lit(k) for k in (*PRESETS, "elsewhere")]), (F.col("review_id") % 7 + 1).cast("int")
    )
    keyed = v.review_texts(spark, sf).select("review_id", key.alias("dataset_key"))
    return keyed.withColumn("display_name", display_name(F.col("dataset_key")))


# ---- model ----------------------------------------------------------------------------------------------


@query
def one_hot(spark, sf):
    events = v.table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.when(F.col("event_type") == "signup", "Early Access Review")
        .otherwise("")
        .alias("early_access_review"),
    )
    encoded = encode.fit_one_hot(
        events, {"early_access_ohe__": "early_access_review", "cat_ohe__": "event_type"}
    )
    return encode.apply_encoding(events, encoded, ["event_id"])


@query
def standardise(spark, sf):
    """Scaling fitted on the training part of a split and applied to all rows."""
    events = v.table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    split = sampling.stratified_split(events, "event_type", "event_id")
    scaler = encode.fit_scaler(split.where(~F.col("is_test")), ["user_id", "value"])
    return rounded(encode.apply_encoding(split, scaler, ["event_id", "is_test"]))


@query
def class_weights(spark, sf):
    return rounded(encode.class_weights(v.outcomes(spark, sf)))


@query
def classification_report(spark, sf):
    """Judges a fixed rule (verdict of the star rule) against the model outcome."""
    docs = v.review_texts(spark, sf).select("review_id", "rating")
    judged = docs.join(v.outcomes(spark, sf), "review_id").withColumn(
        "prediction", F.when(F.col("rating") <= 2, 1.0).otherwise(0.0)
    )
    return rounded(metrics.classification_report(judged, "negative_experience", "prediction"))


def _modelled(spark, sf):
    """Feature table with the labelled outcome, written once: fitting reads it several times."""
    meta = v.review_metadata(spark, sf).select("review_id", "helpful_vote", "event_ts")
    dated = labelled_features(spark, sf).join(meta, "review_id")
    aged = dated.withColumn("review_age_days", age_days(F.col("event_ts"), v.AS_OF))
    return materialise(aged.drop("event_ts"), "labelled-features")


@query
def coef_table(spark, sf):
    model = platform_model.fit_platform(_modelled(spark, sf), PRESETS["amazon_beauty"])
    return rounded(coefs.rank_by_importance(model.coefficients()))


@query
def predictions(spark, sf):
    model = platform_model.fit_platform(_modelled(spark, sf), PRESETS["amazon_beauty"])
    return model.predictions().select(
        "review_id", "negative_experience", F.col("prediction").cast("int").alias("prediction")
    )


@query
def tree_importance(spark, sf):
    features = _modelled(spark, sf)
    parts = {
        kind: platform_model.fit_platform(features, PRESETS["amazon_beauty"], kind=kind).importances()
        for kind in ("tree", "forest")
    }
    return rounded(cleaning.tag_and_stack(parts, "classifier"))


@query
def pooled_coefs(spark, sf):
    model = platform_model.fit_pooled(_modelled(spark, sf), tx.TEXT_FEATURES)
    return rounded(coefs.sort_by_coef(model.coefficients()))


# ---- trends and monitoring -----------------------------------------------------------------------------------


def _dated_polarity(spark, sf):
    features = all_text_features(spark, sf, "platform", "rating")
    return features.join(v.review_metadata(spark, sf).select("review_id", "event_ts"), "review_id")


TREND_MEASURES = ("sentiment_polarity", "exclamation_count", "rating")


@query
def trend_daily(spark, sf):
    daily = trends.daily_trend(_dated_polarity(spark, sf), TREND_MEASURES)
    return rounded(daily.withColumn("day", as_text(F.col("day"))))


@query
def trend_moving(spark, sf):
    daily = trends.daily_trend(_dated_polarity(spark, sf), TREND_MEASURES)
    moving = trends.moving_trend(daily, TREND_MEASURES)
    return rounded(moving.withColumn("day", as_text(F.col("day"))))


def _streamed_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Events as incoming reviews: the star rule gives the outcome, the event type the platform."""
    use_utc(spark)
    # Many files in an order that has nothing to do with time, a few of them per batch.
    events = v.table(spark, sf, "events")
    arrived = fresh_path(spark, "arrived")
    events.repartition(12, F.md5(F.col("event_id").cast("string"))).write.parquet(arrived)
    incoming = monitor.read_review_stream(spark, arrived, events.schema, files_per_trigger=5).select(
        F.col("event_id").alias("review_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("event_type").alias("platform"),
        label_rating((1 + F.col("event_id") % 5).cast("double")).alias("negative_experience"),
    )
    stored = monitor.drain_to_table(incoming, fresh_path(spark, "reviews"), fresh_path(spark, "stream"))
    return monitor.negative_share(stored)


@query
def stream_negative_share(spark, sf):
    shares = _streamed_shares(spark, sf)
    return rounded(shares.withColumn("window_start", as_text(F.col("window_start"))))


@query
def stream_alerts(spark, sf):
    found = monitor.alerts(_streamed_shares(spark, sf), STREAM_THRESHOLD)
    return rounded(found.withColumn("window_start", as_text(F.col("window_start"))))


@query("flagship_profile")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Mean text features per platform and outcome."""
    labelled = labelled_features(spark, sf)
    return rounded(
        labelled.groupBy("platform", "negative_experience").agg(
            F.count("*").alias("reviews"), *[F.avg(c).alias(f"avg_{c}") for c in tx.TEXT_FEATURES]
        )
    )
