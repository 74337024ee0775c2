"""Queries of the operators that work on fitted models, growing summaries and live alerts,
each beside its SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from gripelens.checks import views as v
from gripelens.checks.registry import _modelled, as_text, keep_ids, query, rounded
from gripelens.functions.labels import label_rating
from gripelens.functions.text import TEXT_FEATURES
from gripelens.operators import bootstrap, breaks, distances, growing_sample, phrases, quality, sampling, sentiment, summaries
from gripelens.operators.grouped_fit import INTERCEPT, fit_groups
from gripelens.operators.phrases import PhraseBook
from gripelens.plans import platform_model
from gripelens.plans.features import text_features
from gripelens.plans.presets import PRESETS
from gripelens.plans.refresh import FeatureStore
from gripelens.runtime import fresh_path, materialise
from gripelens.sources import tables
from gripelens.streaming import monitor
from gripelens.streaming.changes import ChangeDetector

# ---- distances and curves -----------------------------------------------------------------


@query
def platform_distances(spark, sf):
    docs = v.review_texts(spark, sf, spread=True).select("review_id", "platform", "text")
    scored = sentiment.with_sentiment(docs, v.lexicon(spark))
    return rounded(distances.platform_distances(scored, "sentiment_polarity"))


def _scored_outcomes(spark, sf):
    """Polarity as a score of the outcome: the lower, the more negative."""
    docs, outcomes = v.review_texts(spark, sf, spread=True).select("review_id", "text"), v.outcomes(spark, sf)
    scored = sentiment.with_sentiment(keep_ids(docs, outcomes), v.lexicon(spark)).join(outcomes, "review_id")
    return scored.withColumn("score", -F.col("sentiment_polarity"))


@query
def roc_curve(spark, sf):
    return rounded(quality.curve(_scored_outcomes(spark, sf), "score"))


@query
def curve_areas(spark, sf):
    return rounded(quality.areas(quality.curve(_scored_outcomes(spark, sf), "score")))


def distance_sql(docs: str, lexicon: str, outcomes: str, mood: str, with_) -> dict[str, str]:
    steps = """steps AS (
  SELECT 0.0 - sentiment_polarity AS score, count(*) FILTER (WHERE negative_experience = 1) AS positives,
         count(*) FILTER (WHERE negative_experience = 0) AS negatives
  FROM mood JOIN outcomes USING (review_id) GROUP BY 1),
points AS (SELECT *, sum(positives) OVER (ORDER BY score DESC)::BIGINT AS true_positives,
           sum(negatives) OVER (ORDER BY score DESC)::BIGINT AS false_positives FROM steps)"""
    return {
        "platform_distances": with_(
            docs, lexicon, mood,
            "scored AS (SELECT platform, sentiment_polarity AS x FROM docs JOIN mood USING (review_id) WHERE platform IS NOT NULL)",
            "sizes AS (SELECT platform, count(*) AS n FROM scored GROUP BY platform)",
            """grid AS (SELECT x, platform, sizes.n, coalesce(k, 0) AS k FROM (SELECT DISTINCT x FROM scored) CROSS JOIN sizes
  LEFT JOIN (SELECT platform, x, count(*) AS k FROM scored GROUP BY ALL) USING (platform, x))""",
            """grown AS (SELECT *, sum(k) OVER (PARTITION BY platform ORDER BY x)::DOUBLE / n AS f,
  lead(x) OVER (PARTITION BY platform ORDER BY x) - x AS width FROM grid)""",
        )
        + """SELECT a.platform AS platform_a, b.platform AS platform_b, max(a.n) AS n_a, max(b.n) AS n_b,
  round(max(abs(a.f - b.f)), 6) AS ks, round(coalesce(sum(abs(a.f - b.f) * a.width), 0.0), 6) AS wasserstein
FROM grown a JOIN grown b ON a.x = b.x AND a.platform < b.platform GROUP BY ALL""",
        "roc_curve": with_(docs, lexicon, outcomes, mood, steps)
        + "SELECT round(score, 6) AS score, positives, negatives, true_positives, false_positives FROM points",
        "curve_areas": with_(docs, lexicon, outcomes, mood, steps)
        + """SELECT sum(positives)::BIGINT AS positives, sum(negatives)::BIGINT AS negatives,
  round(sum(negatives * (2 * true_positives - positives))::DOUBLE / (2.0 * sum(positives) * sum(negatives)), 6)::DOUBLE AS roc_auc,
  round(sum(positives * true_positives::DOUBLE / (true_positives + false_positives)) / sum(positives), 6) AS average_precision
FROM points""",
    }


# ---- growing summaries ----------------------------------------------------------------------

_ASKED = (0.01, 0.5, 0.99)


@query
def growing_quantiles(spark, sf):
    """Summaries stored day by day, merged per platform, and refined to exact quantiles."""
    dated = v.review_metadata(spark, sf).select("review_id", F.to_date("event_ts").alias("day"))
    docs = v.review_texts(spark, sf, spread=True).select("review_id", "platform", "text")
    scored = materialise(sentiment.with_sentiment(docs, v.lexicon(spark)).join(dated, "review_id"), "dated-polarity")
    days = summaries.summarise(scored, ["platform"], "sentiment_polarity")
    stored = materialise(days, "day-summaries", partition_by="day")
    merged = summaries.merge(stored, ["platform"])
    return rounded(summaries.refine(scored, merged, ["platform"], "sentiment_polarity", _ASKED))


def summary_sql(docs: str, meta: str, lexicon: str, mood: str, with_) -> dict[str, str]:
    asked = ", ".join(f"({p}::DOUBLE)" for p in _ASKED)
    picks = " ".join(f"WHEN {p} THEN quantile_cont(sentiment_polarity, {p})" for p in _ASKED)
    return {
        "growing_quantiles": with_(docs, meta, lexicon, mood)
        + f"""SELECT platform, p, count(*) AS rows, round(CASE p {picks} END, 6) AS quantile
FROM docs JOIN mood USING (review_id) JOIN meta USING (review_id), (VALUES {asked}) AS asked(p) GROUP BY platform, p"""
    }


# ---- uncertainty -------------------------------------------------------------------------------


@query
def bootstrap_polarity(spark, sf):
    docs = v.review_texts(spark, sf, spread=True).select("review_id", "platform", "text")
    scored = sentiment.with_sentiment(docs, v.lexicon(spark))
    return rounded(bootstrap.bootstrap_means(scored, ["platform"], "sentiment_polarity"))


def bootstrap_sql(docs: str, lexicon: str, mood: str, with_) -> dict[str, str]:
    digest = "substr(md5('33:' || (r // 8)::VARCHAR || ':' || review_id::VARCHAR), 1 + 4 * (r % 8), 4)"
    steps = " + ".join(f"(u >= {s})::BIGINT" for s in bootstrap.POISSON_STEPS)
    return {
        "bootstrap_polarity": with_(
            docs, lexicon, mood,
            "scored AS (SELECT review_id, platform, round(sentiment_polarity * 1000000)::BIGINT AS m FROM docs JOIN mood USING (review_id))",
            f"drawn AS (SELECT platform, r, m, ('0x' || {digest})::INT AS u FROM scored, range({bootstrap.REPLICATES}) AS t(r))",
            f"means AS (SELECT platform, r, sum(({steps}) * m)::DOUBLE / nullif(sum({steps}), 0) / 1000000 AS mean FROM drawn GROUP BY ALL)",
            "ends AS (SELECT platform, quantile_cont(mean, 0.025) AS low, quantile_cont(mean, 0.975) AS high FROM means GROUP BY platform)",
        )
        + """SELECT platform, count(*) AS n, round(sum(m)::DOUBLE / count(*) / 1000000, 6) AS mean,
  round(max(low), 6) AS low, round(max(high), 6) AS high FROM scored JOIN ends USING (platform) GROUP BY platform"""
    }


# ---- growing samples ----------------------------------------------------------------------------


@query
def growing_sample_by_platform(spark, sf):
    """Documents arrive in four parts; the kept sample is added to after each."""
    docs = v.review_texts(spark, sf).select("review_id", "platform", "rating")
    kept = growing_sample.lowest(docs.where("review_id % 4 = 0"), "platform", "review_id", 7)
    for part in (1, 2, 3):
        stored = materialise(kept, "kept-sample")
        kept = growing_sample.add(stored, docs.where(f"review_id % 4 = {part}"), "platform", "review_id", 7)
    return kept


def sample_sql(docs: str, with_) -> dict[str, str]:
    return {
        "growing_sample_by_platform": with_(docs)
        + """SELECT review_id, platform, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY platform ORDER BY md5('33:' || review_id::VARCHAR)) AS rn FROM docs
  WHERE platform IS NOT NULL) WHERE rn <= 7"""
    }


# ---- phrases --------------------------------------------------------------------------

# Runs of words that occur in the invented texts, besides the single words.
PHRASES = (
    ("of the", "intensifier", 0.3, 0.5),
    ("the of the", "complaint", -0.7, 0.8),
    ("that the", "complaint", -0.2, 0.4),
    ("with that", "intensifier", None, None),
    ("in of", None, 0.9, 1.0),
)


def _book(spark):
    rows = [*PHRASES, *[(t, None, p, s) for t, p, s in v.LEXICON_ROWS]]
    return PhraseBook.build(spark.createDataFrame(rows, "phrase string, kind string, polarity double, subjectivity double"))


@query
def phrase_markers(spark, sf):
    docs = v.review_texts(spark, sf, spread=True)
    return phrases.phrase_counts(docs, _book(spark), ["intensifier", "complaint"])


@query
def phrase_sentiment(spark, sf):
    docs = v.review_texts(spark, sf, spread=True)
    return rounded(phrases.phrase_sentiment(docs, _book(spark), v.lexicon(spark)))


def phrase_sql(docs: str, lexicon: str, tokens, with_) -> dict[str, str]:
    def show(x):
        return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"{x}::DOUBLE"

    rows = [*PHRASES, *[(t, None, p, s) for t, p, s in v.LEXICON_ROWS]]
    listed = ", ".join(f"({', '.join(show(x) for x in r)}, {len(r[0].split())})" for r in rows)
    # A list index below 1 counts from the end here, so the start of a text has to be told apart.
    factor = "(SELECT factor FROM modifiers m WHERE m.kind = '{}' AND m.term = CASE WHEN i{} > 0 THEN t[i{}] END)"
    boost = f"coalesce({factor.format('intensify', '', '')}, 1.0)::DOUBLE"
    flip = f"coalesce({factor.format('negate', '', '')}, {factor.format('negate', ' - 1', ' - 1')}, 1.0)::DOUBLE"
    taken = (
        "{'e': x.e + x.w, 'w': 0::BIGINT, 'n': a.n + 1, 'k1': a.k1 + x.k1, 'k2': a.k2 + x.k2, "
        "'u': a.u + x.u, 'p': a.p + x.p, 's': a.s + x.s}"
    )
    zero = "{'e': 0::BIGINT, 'w': 0::BIGINT, 'n': 0::BIGINT, 'k1': 0::BIGINT, 'k2': 0::BIGINT, 'u': 0::BIGINT, 'p': 0::BIGINT, 's': 0::BIGINT}"
    base = with_(
        docs, lexicon, tokens("docs", "tok"),
        f"book(run, kind, polarity, subjectivity, w) AS (VALUES {listed})",
        "places AS (SELECT review_id, t, unnest(range(len(t))) AS i FROM tok)",
        f"""found AS (
  SELECT review_id, i, w, kind, polarity,
         round(least(1.0, greatest(-1.0, polarity * {boost} * {flip})) * 1000000)::BIGINT AS p,
         round(least(1.0, greatest(0.0, subjectivity * {boost})) * 1000000)::BIGINT AS s
  FROM places JOIN book ON array_to_string(t[i + 1:i + w], ' ') = run AND i + w <= len(t))""",
        """listed AS (
  SELECT review_id, list({'e': i::BIGINT, 'w': w::BIGINT, 'n': 1::BIGINT, 'k1': (kind IS NOT DISTINCT FROM 'intensifier')::BIGINT,
    'k2': (kind IS NOT DISTINCT FROM 'complaint')::BIGINT, 'u': (polarity IS NOT NULL)::BIGINT,
    'p': CASE WHEN polarity IS NULL THEN 0 ELSE p END, 's': CASE WHEN polarity IS NULL THEN 0 ELSE coalesce(s, 0) END} ORDER BY i, w DESC) AS m
  FROM found GROUP BY review_id)""",
        f"""summed AS (
  SELECT review_id, list_reduce(coalesce(m, []), lambda a, x: CASE WHEN x.e >= a.e THEN {taken} ELSE a END, {zero}) AS r
  FROM docs LEFT JOIN listed USING (review_id))""",
    )
    mean = "round(coalesce(r.{}::DOUBLE / nullif(r.u, 0) / 1000000, 0.0), 6)"
    return {
        "phrase_markers": base + "SELECT review_id, r.n AS matches, r.k1 AS intensifier_count, r.k2 AS complaint_count FROM summed",
        "phrase_sentiment": base
        + f"""SELECT review_id, r.n AS matches, r.u AS scored_units, {mean.format('p')} AS sentiment_polarity,
  {mean.format('s')} AS sentiment_subjectivity FROM summed""",
    }


# ---- alerts ---------------------------------------------------------------------------

CHANGE = ChangeDetector(limit=490, bound=4000, idle_days=3)
ARRIVALS = 6
MANY_FILES = 1_000_000  # all files of an arrival make one batch, so none is late within it


@query
def stream_changes(spark, sf):
    """Days above the bound from the stored reviews, and whether the live job differs on any of
    the days that its watermark has closed."""
    events = v.table(spark, sf, "events")
    arrived = fresh_path(spark, "arrived-in-time")
    events.limit(0).write.parquet(arrived)
    incoming = monitor.read_review_stream(spark, arrived, events.schema, files_per_trigger=MANY_FILES).select(
        F.col("event_id").alias("review_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("event_type").alias("platform"),
        label_rating((1 + F.col("event_id") % 5).cast("double")).alias("negative_experience"),
    )
    live = CHANGE.stream(incoming)
    out, checkpoint = fresh_path(spark, "changes"), fresh_path(spark, "changes-stream")
    # Files arrive as time goes on; the live job sees what has come, and goes on from its checkpoint.
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    place = F.least(F.floor((at - low) * ARRIVALS / F.lit(max(high - low, 1))), F.lit(ARRIVALS - 1))
    for k in range(ARRIVALS):
        events.where(place == k).write.mode("append").parquet(arrived)
        monitor.watch(live, out, checkpoint, once=True).awaitTermination()
    stored = monitor.drain_to_table(incoming, fresh_path(spark, "reviews"), fresh_path(spark, "stream"))
    found = spark.read.schema(live.schema).parquet(out).select("platform", "day", F.col("score").alias("live"))
    days = CHANGE.batch(stored).join(found, ["platform", "day"], "left")
    differs = F.coalesce(F.col("live") != F.col("score"), F.lit(False)).alias("live_differs")
    return days.select(
        "platform", as_text(F.col("day")).alias("day"), "n", "negative", "score", "alert", "started", differs
    )


def change_sql(shares: str, with_) -> dict[str, str]:
    return {
        "stream_changes": with_(
            shares,
            "steps AS (SELECT *, 1000 * negative - 490 * n AS step, lag(w) OVER (PARTITION BY platform ORDER BY w) AS before FROM shares)",
            """parts AS (SELECT *, sum((date_diff('day', before, w) > 3)::INT) OVER (PARTITION BY platform ORDER BY w) AS part FROM steps)""",
            "sums AS (SELECT *, sum(step) OVER (PARTITION BY platform, coalesce(part, 0) ORDER BY w) AS total FROM parts)",
            """scores AS (SELECT *, total - least(0, min(total) OVER (PARTITION BY platform, coalesce(part, 0) ORDER BY w)) AS score FROM sums)""",
        )
        + """SELECT platform, strftime(w, '%Y-%m-%d %H:%M:%S') AS day, n, negative, score::BIGINT AS score, score > 4000 AS alert,
  score > 4000 AND NOT coalesce(lag(score > 4000) OVER (PARTITION BY platform, coalesce(part, 0) ORDER BY w), false) AS started,
  false AS live_differs FROM scores"""
    }


# ---- tables kept up to date ---------------------------------------------------------------


def _refreshed(spark, sf):
    """A store filled with an older state of the documents, then brought up to the present one."""
    docs = v.review_texts(spark, sf, spread=True).select("review_id", "platform", "text")
    store = FeatureStore(
        fresh_path(spark, "store"), partial(text_features, lexicon=v.lexicon(spark)), partition_col="platform", buckets=2
    )
    here, blank = F.col("review_id") % 7 != 0, F.col("review_id") % 11 == 0
    older = docs.where(here).withColumn("text", F.when(~blank, F.col("text")))
    gone = docs.where(F.col("review_id") % 13 == 0).withColumn("review_id", -1 - F.col("review_id"))
    store.refresh(older.unionByName(gone))
    return store, store.refresh(docs)


@query
def refreshed_features(spark, sf):
    return rounded(_refreshed(spark, sf)[0].read(spark))


@query
def refresh_counts(spark, sf):
    done = _refreshed(spark, sf)[1]
    names = ("added", "changed", "removed", "unchanged", "scored")
    return spark.createDataFrame([tuple(getattr(done, c) for c in names)], ", ".join(f"{c} bigint" for c in names))


def refresh_sql(docs: str, features: str, with_) -> dict[str, str]:
    return {
        "refreshed_features": features,
        "refresh_counts": with_(
            docs,
            """states AS (SELECT review_id % 7 = 0 AS added, review_id % 7 <> 0 AND review_id % 11 = 0 AND text IS NOT NULL AS changed,
  review_id % 13 = 0 AS removed FROM docs)""",
        )
        + """SELECT count(*) FILTER (WHERE added) AS added, count(*) FILTER (WHERE changed) AS changed, count(*) FILTER (WHERE removed) AS removed,
  count(*) FILTER (WHERE NOT added AND NOT changed) AS unchanged, count(*) FILTER (WHERE added OR changed) AS scored FROM states""",
    }


# ---- breaks in trends -----------------------------------------------------------------

BREAK_STRENGTH, BREAK_DAYS = 0.4, 2


@query
def trend_breaks(spark, sf):
    """Segments of the daily star rating of incoming reviews; the event type is the platform."""
    dated = v.table(spark, sf, "events").select(
        F.col("event_type").alias("platform"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        (1 + F.col("event_id") % 5).cast("double").alias("rating"),
    )
    found = breaks.trend_breaks(dated, "rating", strength=BREAK_STRENGTH, min_days=BREAK_DAYS)
    days = {c: F.col(c).cast("string") for c in ("first_day", "last_day")}
    return rounded(found.withColumns(days))


def break_sql(with_) -> dict[str, str]:
    """All divisions by a table of best costs that grows by one day a step, without dropping starts."""
    m = BREAK_DAYS
    steps = with_(
        """sums AS (SELECT event_type AS platform, ts::DATE AS day, count(*) AS n, sum(1000000 * (1 + event_id % 5))::BIGINT AS total
  FROM events GROUP BY ALL)""",
        """calendar AS (SELECT platform, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM sums GROUP BY platform)""",
        """filled AS (SELECT c.platform, c.day, coalesce(n, 0) AS n, coalesce(total, 0) AS total, coalesce(total / n / 1000000, 0) AS x
  FROM calendar c LEFT JOIN sums s ON c.day = s.day AND c.platform IS NOT DISTINCT FROM s.platform)""",
        """noise AS (SELECT platform, avg(pow(x - x0, 2) / (1 / n + 1 / n0)) AS noise FROM (
    SELECT *, lag(x) OVER near AS x0, lag(n) OVER near AS n0 FROM filled WHERE n > 0 WINDOW near AS (PARTITION BY platform ORDER BY day))
  GROUP BY platform)""",
        """added AS (SELECT *, sum(n) OVER upto AS w, sum(n * x) OVER upto AS l, sum(n * x * x) OVER upto AS q
  FROM filled WINDOW upto AS (PARTITION BY platform ORDER BY day))""",
        f"""series AS (SELECT a.platform, min(day) AS low, count(*)::INT AS days, list(n ORDER BY day) AS ns,
    list(total ORDER BY day) AS totals, [0.0::DOUBLE] || list(w::DOUBLE ORDER BY day) AS w,
    [0.0::DOUBLE] || list(l::DOUBLE ORDER BY day) AS l, [0.0::DOUBLE] || list(q::DOUBLE ORDER BY day) AS q,
    {BREAK_STRENGTH} * coalesce(any_value(noise), 0) * ln(greatest(count(*), 2)) AS penalty, 1e-9 * greatest(max(q), 1) AS tie
  FROM added a JOIN noise z ON a.platform IS NOT DISTINCT FROM z.platform GROUP BY a.platform)""",
        f"""costs AS (
  SELECT platform, {m - 1} AS t, [0.0 - penalty] || list_transform(range({m - 1}), lambda i: 'inf'::DOUBLE) AS best,
         list_transform(range({m}), lambda i: 0::BIGINT) AS before, series AS z FROM series
  UNION ALL
  SELECT platform, t + 1, best || [list_min(cs)], before || [starts[list_position(list_transform(cs, lambda c: c <= list_min(cs) + z.tie), true)]], z
  FROM (SELECT *, list_transform(starts, lambda s: best[s + 1] + z.penalty + z.q[t + 2] - z.q[s + 1]
                                 - pow(z.l[t + 2] - z.l[s + 1], 2) / (z.w[t + 2] - z.w[s + 1])) AS cs
    FROM (SELECT *, list_filter(range(t + 2 - {m}), lambda s: s = 0 OR (z.ns[s + 1] > 0 AND isfinite(best[s + 1]))) AS starts
      FROM costs WHERE t < z.days)))""",
        f"""ends AS (SELECT * FROM costs WHERE t = greatest(z.days, {m - 1}))""",
        f"""segments AS (
  SELECT platform, z.days::BIGINT AS stop, CASE WHEN z.days >= {m} THEN before[z.days + 1] ELSE 0 END AS start, before, z FROM ends
  UNION ALL SELECT platform, start, before[start + 1], before, z FROM segments WHERE start > 0)""",
        """levels AS (SELECT *, list_sum(ns) AS n, list_sum(totals) / list_sum(ns) / 1000000 AS level FROM (
    SELECT *, z.ns[start + 1:stop] AS ns, z.totals[start + 1:stop] AS totals FROM segments))""",
    )
    return {
        "trend_breaks": steps.replace("WITH", "WITH RECURSIVE", 1)
        + """SELECT platform, row_number() OVER own::INT AS segment, (z.low + start::INT)::VARCHAR AS first_day,
  (z.low + stop::INT - 1)::VARCHAR AS last_day, stop - start AS days, n::BIGINT AS n, round(level, 6) AS level,
  round(level - lag(level) OVER own, 6) AS shift FROM levels WINDOW own AS (PARTITION BY platform ORDER BY start)"""
    }


# ---- fitted models ------------------------------------------------------------------


def _gradient(df, *keys):
    """Gradients of an optimum are zero; what is left of the solver's tolerance is rounded off."""
    return df.select(*keys, "feature", "rows", (F.round("gradient", 4) + 0.0).alias("gradient"))


@query
def coef_gradient(spark, sf):
    """The platform fit is the optimum of its objective: no derivative is left."""
    return _gradient(platform_model.fit_platform(_modelled(spark, sf), PRESETS["amazon_beauty"]).gradient())


@query
def pooled_gradient(spark, sf):
    return _gradient(platform_model.fit_pooled(_modelled(spark, sf), TEXT_FEATURES).gradient())


@query
def grouped_gradient(spark, sf):
    """All platforms fitted in one job, each with its own scaling, categories and weights."""
    features = _modelled(spark, sf)
    train = sampling.stratified_split(features, "negative_experience", "review_id").where(~F.col("is_test"))
    preset = PRESETS["amazon_beauty"]
    return _gradient(fit_groups(train, preset.model_numeric, dict(preset.categorical)).gradient(), "platform")


@query
def platform_run(spark, sf):
    """The whole run of a platform: feature table, split, fit, stored coefficients and model."""
    meta = v.review_metadata(spark, sf).select("review_id", "helpful_vote", "timestamp")
    out = fresh_path(spark, "platform-run")
    run = platform_model.run_platform(
        v.review_texts(spark, sf, spread=True), PRESETS["amazon_beauty"], v.lexicon(spark), v.AS_OF, out, meta
    )
    stored = tables.read_coefs(spark, {"amazon_beauty": f"{out}/coefs"}, missing="error")
    return _gradient(run.model.gradient().join(stored.select("feature"), "feature"))


_NUMERIC = ("helpful_vote", "review_age_days", *TEXT_FEATURES)
_FLAG = "verified_ohe__verified_purchase_"


def _numeric_names(names=_NUMERIC) -> str:
    return "SELECT unnest([" + ", ".join(f"'num_scaler__{c}'" for c in names) + "]) AS feature"


def _flags(source: str, by: str = "") -> str:
    """Indicator names of the flag by the drop-if-binary rule, from the rows of ``source``."""
    keys = f"{by}, " if by else ""
    shown = "CASE WHEN verified_purchase THEN 'True' ELSE 'False' END"
    return f"""SELECT DISTINCT {keys}'{_FLAG}' || {shown} AS feature FROM (
    SELECT *, count(DISTINCT verified_purchase) OVER ({f'PARTITION BY {by}' if by else ''}) AS k FROM {source})
  WHERE k = 1 OR verified_purchase"""


def model_sql(parts) -> dict[str, str]:
    docs, meta, outcomes, with_, split = parts
    modelled = "modelled AS (SELECT * FROM docs JOIN outcomes USING (review_id) JOIN (SELECT review_id FROM meta) USING (review_id))"
    size = "size AS (SELECT count(*) - ceil(round(0.2 * count(*), 9))::BIGINT AS rows FROM modelled)"
    zero = "0.0::DOUBLE AS gradient"
    reviews = """modelled AS (SELECT review_id, verified_purchase FROM docs JOIN (SELECT review_id FROM meta) USING (review_id)
  WHERE text IS NOT NULL AND rating <> 3)"""
    listed = f"SELECT feature, rows, {zero} FROM ({_numeric_names()} UNION ALL {_flags('modelled')}), size"
    return {
        "coef_gradient": with_(docs, meta, outcomes, modelled, size) + listed,
        "platform_run": with_(docs, meta, reviews, size) + listed,
        "pooled_gradient": with_(docs, meta, outcomes, modelled, size)
        + f"""SELECT feature, rows, {zero} FROM ({_numeric_names(TEXT_FEATURES)}
  UNION ALL SELECT DISTINCT 'platform_ohe__platform_' || platform FROM modelled), size""",
        "grouped_gradient": with_(
            docs, meta, outcomes, modelled, split("modelled", "negative_experience", "review_id"),
            "train AS (SELECT * FROM split WHERE NOT is_test)",
            """groups AS (SELECT platform, count(*) AS rows FROM train GROUP BY platform
  HAVING min(negative_experience) < max(negative_experience))""",
            "own AS (SELECT * FROM train WHERE platform IN (SELECT platform FROM groups))",
        )
        + f"""SELECT platform, feature, rows, {zero} FROM (
  SELECT platform, feature FROM groups, ({_numeric_names()} UNION ALL SELECT '{INTERCEPT}')
  UNION ALL {_flags('own', 'platform')}) JOIN groups USING (platform)""",
    }
