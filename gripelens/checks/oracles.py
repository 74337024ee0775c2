"""The registered queries in SQL, written independently of the Spark expressions.

Sentences are cut and counted one by one here, quantiles come from the engine's own
quantile function, samples from row numbers over all rows.
"""

from __future__ import annotations

from gripelens.checks import views as v
from gripelens.checks import more
from gripelens.checks.registry import SOURCES, STREAM_THRESHOLD, TREND_MEASURES
from gripelens.functions.names import DISPLAY_NAMES
from gripelens.functions.text import BLANKS, TEXT_FEATURES
from gripelens.plans.presets import PRESETS

_SPACES = " " * len(BLANKS)
_AS_OF_MICROS = int(v.AS_OF.timestamp()) * 1_000_000


def _rows(rows) -> str:
    def show(x):
        return f"'{x}'" if isinstance(x, str) else repr(x)

    return "VALUES " + ", ".join("(" + ", ".join(show(x) for x in r) + ")" for r in rows)


# ---- views ------------------------------------------------------------------------

DOCS = """docs AS (
  SELECT doc_id AS review_id, source AS platform, lang, text,
         (1 + doc_id % 5)::DOUBLE AS rating, (doc_id % 5)::INT AS label,
         CASE doc_id % 3 WHEN 0 THEN 'Recommended' WHEN 1 THEN 'Not Recommended' ELSE '' END AS recommend,
         doc_id % 4 <> 0 AS verified_purchase
  FROM documents)"""
META = """meta AS (
  SELECT event_id AS review_id, ts AS event_ts, epoch_us(ts) // 1000 AS "timestamp",
         floor(value)::BIGINT AS helpful_vote, user_id AS helpfulness, value AS playtime,
         CASE WHEN event_type = 'signup' THEN 'Early Access Review' ELSE '' END AS early_access_review,
         CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 17 = 1 THEN 'soon'
              WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d')
              ELSE strftime(ts, '%b %-d, %Y') END AS post_date
  FROM events)"""
OUTCOMES = """outcomes AS (
  SELECT doc_id AS review_id,
         (CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END)::INT AS negative_experience
  FROM labels)"""
CHATS = """chats AS (
  SELECT conv_id::VARCHAR || '-' || turn::VARCHAR AS review_id, role,
         ((conv_id + turn) % 5)::INT AS label, text
  FROM conversations)"""
LEXICON = (
    f"lexicon(term, polarity, subjectivity) AS ({_rows(v.LEXICON_ROWS)}), "
    f"modifiers(term, kind, factor) AS ({_rows(v.MODIFIER_ROWS)})"
)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _stars(column: str) -> str:
    return f"(CASE WHEN {column} <= 2 THEN 1 WHEN {column} >= 4 THEN 0 END)::INT"


# ---- text ------------------------------------------------------------------------------


def _shape(source: str, name: str = "shape") -> str:
    """Shape features of ``source`` (review_id, text)."""
    return f"""{name}_clean AS (
  SELECT review_id, trim(translate(coalesce(text, ''), '{BLANKS}', '{_SPACES}'), ' ') AS c FROM {source}),
{name}_cut AS (
  SELECT review_id, c, list_filter(regexp_split_to_array(c, '[.!?]+(?: +|$)'), lambda s: s <> '') AS parts
  FROM {name}_clean),
{name} AS (
  SELECT review_id,
         len(regexp_extract_all(c, '[^ ]+'))::BIGINT AS review_length_words,
         length(c)::BIGINT AS review_length_chars,
         len(parts)::BIGINT AS sentences,
         CASE WHEN len(parts) = 0 THEN 0.0 ELSE
           list_sum(list_transform(parts, lambda s: len(regexp_extract_all(s, '[^ ]+'))))::DOUBLE / len(parts)
         END AS avg_sentence_length,
         len(regexp_extract_all(c, '!'))::BIGINT AS exclamation_count,
         length(regexp_replace(c, '[^\\p{{Lu}}]', '', 'g'))::DOUBLE / greatest(length(c), 1) AS capital_ratio
  FROM {name}_cut)"""


def _tokens(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT review_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}'']+') AS t FROM {source})"""


def _sentiment(source: str, name: str = "mood") -> str:
    """Sentiment of every row of ``source``; needs the LEXICON views."""
    return f"""{_tokens(source, name + '_tokens')},
{name}_spread AS (
  SELECT review_id, unnest(list_zip(t, list_prepend(NULL::VARCHAR, t),
         list_prepend(NULL::VARCHAR, list_prepend(NULL::VARCHAR, t)))) AS w
  FROM {name}_tokens),
{name}_hits AS (
  SELECT s.review_id, l.polarity AS raw,
    least(1.0, greatest(-1.0, l.polarity::DOUBLE
      * coalesce((SELECT factor FROM modifiers m WHERE m.kind = 'intensify' AND m.term = s.w[2]), 1.0)::DOUBLE
      * coalesce((SELECT factor FROM modifiers m WHERE m.kind = 'negate' AND m.term = s.w[2]),
                 (SELECT factor FROM modifiers m WHERE m.kind = 'negate' AND m.term = s.w[3]), 1.0)::DOUBLE)) AS p,
    least(1.0, greatest(0.0, l.subjectivity::DOUBLE
      * coalesce((SELECT factor FROM modifiers m WHERE m.kind = 'intensify' AND m.term = s.w[2]), 1.0)::DOUBLE)) AS s
  FROM {name}_spread s JOIN lexicon l ON l.term = s.w[1]),
{name}_sums AS (
  SELECT review_id, count(*) AS scored_words, count(*) FILTER (WHERE raw < 0) AS negative_words,
         sum(round(p * 1000000)::BIGINT)::DOUBLE / count(*) / 1000000 AS p,
         sum(round(s * 1000000)::BIGINT)::DOUBLE / count(*) / 1000000 AS s
  FROM {name}_hits GROUP BY review_id),
{name} AS (
  SELECT t.review_id, len(t.t)::BIGINT AS words,
         coalesce(scored_words, 0) AS scored_words, coalesce(negative_words, 0) AS negative_words,
         coalesce(p, 0.0) AS sentiment_polarity, coalesce(s, 0.0) AS sentiment_subjectivity
  FROM {name}_tokens t LEFT JOIN {name}_sums USING (review_id))"""


def _text(source: str, name: str = "feat") -> str:
    """All seven text features of ``source``."""
    return f"""{_shape(source, name + '_shape')},
{_sentiment(source, name + '_mood')},
{name} AS (
  SELECT review_id, sentiment_polarity, sentiment_subjectivity, review_length_words,
         review_length_chars, avg_sentence_length, exclamation_count, capital_ratio
  FROM {name}_shape JOIN {name}_mood USING (review_id))"""


def _rounded(columns, rounding=("sentiment_polarity", "sentiment_subjectivity", "avg_sentence_length", "capital_ratio")):
    return ", ".join(f"round({c}, 6) AS {c}" if c in rounding else c for c in columns)


_TEXT_OUT = _rounded(TEXT_FEATURES)

# ---- feature tables per platform ------------------------------------------------------------

AMAZON = f"""amazon AS (
  SELECT d.review_id, rating, helpful_vote, verified_purchase, {_stars('rating')} AS negative_experience,
         floor(({_AS_OF_MICROS} - "timestamp" * 1000) / 86400000000)::BIGINT AS review_age_days,
         f.* EXCLUDE (review_id)
  FROM docs d JOIN meta m USING (review_id) JOIN feat f USING (review_id)
  WHERE text IS NOT NULL AND {_stars('rating')} IS NOT NULL)"""
_PARSED = "coalesce(try_strptime(post_date, '%Y-%m-%d'), try_strptime(post_date, '%b %-d, %Y'))"
STEAM = f"""steam AS (
  SELECT d.review_id, recommend, playtime, helpfulness, early_access_review,
         (CASE recommend WHEN 'Recommended' THEN 0 ELSE 1 END)::INT AS negative_experience,
         floor(({_AS_OF_MICROS} - epoch_us({_PARSED})) / 86400000000)::BIGINT AS review_age_days,
         f.* EXCLUDE (review_id)
  FROM docs d JOIN meta m USING (review_id) JOIN feat f USING (review_id)
  WHERE text IS NOT NULL AND recommend IN ('Recommended', 'Not Recommended') AND {_PARSED} IS NOT NULL)"""
YELP = f"""yelp AS (
  SELECT c.review_id, label, {_stars('label')} AS negative_experience, f.* EXCLUDE (review_id)
  FROM chats c JOIN chat_feat f USING (review_id)
  WHERE text IS NOT NULL AND {_stars('label')} IS NOT NULL)"""
_DOC_FEATURES = (DOCS, META, LEXICON, _text("docs"))
_ALL_PLATFORMS = (*_DOC_FEATURES, AMAZON, STEAM, CHATS, _text("chats", "chat_feat"), YELP)


def _features(preset: str, table: str) -> str:
    columns = ["review_id", *PRESETS[preset].feature_columns]
    doubles = [c for c in columns if c in ("rating", "playtime")]
    return f"SELECT {_rounded(columns, ('sentiment_polarity', 'sentiment_subjectivity', 'avg_sentence_length', 'capital_ratio', *doubles))} FROM {table}"


# ---- distributions -------------------------------------------------------------------------------


def _trimmed(source: str, groups: str, value: str) -> str:
    """Clip to the group's 0.01 and 0.99 quantiles, then summarise."""
    return f"""values_ AS (SELECT {groups}, {value}::DOUBLE AS x FROM {source} WHERE {value} IS NOT NULL),
bounds AS (
  SELECT {groups}, count(*) AS n, quantile_cont(x, 0.01) AS lower, quantile_cont(x, 0.99) AS upper,
         quantile_cont(x, 0.5) AS median
  FROM values_ GROUP BY {groups}),
clipped AS (
  SELECT v.*, n, lower, upper, median, greatest(lower, least(upper, x)) AS c
  FROM values_ v JOIN bounds USING ({groups})),
trimmed AS (
  SELECT {groups}, count(*) AS n, round(avg(c), 6) AS mean, round(quantile_cont(c, 0.5), 6) AS median,
         round(min(c), 6) AS "min", round(max(c), 6) AS "max"
  FROM clipped GROUP BY {groups})"""


def _outcome_part(table: str, key: str, group: str) -> str:
    return f"SELECT '{key}' AS dataset, ({group})::VARCHAR AS outcome, sentiment_polarity FROM {table}"


# ---- sampling ---------------------------------------------------------------------------------------


def _ranked(source: str, identity: str, seed: int) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || {identity}::VARCHAR)) AS rn FROM {source}"


def _split(source: str, label: str, identity: str, seed: int = 33) -> str:
    """Largest-remainder training quotas per class; the lowest hashes are the test rows."""
    return f"""sizes AS (SELECT {label} AS cls, count(*) AS n FROM {source} GROUP BY 1),
total AS (SELECT sum(n)::BIGINT AS n, (sum(n) - ceil(round(0.2 * sum(n), 9)))::BIGINT AS train FROM sizes),
shares AS (
  SELECT cls, s.n, (train * s.n) // t.n AS base, (train * s.n) % t.n AS rest,
         train - sum((train * s.n) // t.n) OVER () AS spare,
         row_number() OVER (ORDER BY (train * s.n) % t.n DESC, cls::VARCHAR) AS place
  FROM sizes s, total t),
quotas AS (SELECT cls, n - base - (CASE WHEN place <= spare THEN 1 ELSE 0 END) AS test FROM shares),
split AS (
  SELECT r.* EXCLUDE (rn), rn <= test AS is_test
  FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}:' || {identity}::VARCHAR)) AS rn
        FROM {source}) r JOIN quotas ON {label} = cls)"""


# ---- coefficients -----------------------------------------------------------------------------------

_CORRELATIONS = ",\n         ".join(
    f"corr({c}::DOUBLE, negative_experience::DOUBLE) AS num_scaler__{c}" for c in TEXT_FEATURES
)
COEFS = f"""wide AS (
  SELECT platform, {_CORRELATIONS}
  FROM docs JOIN feat USING (review_id) JOIN outcomes USING (review_id) GROUP BY platform),
long AS (UNPIVOT wide ON {', '.join('num_scaler__' + c for c in TEXT_FEATURES)} INTO NAME feature VALUE coef),
coefs AS (SELECT platform, feature, round(coef, 6) AS coef FROM long WHERE coef IS NOT NULL AND NOT isnan(coef))"""
_WITH_COEFS = (DOCS, LEXICON, OUTCOMES, _text("docs"), COEFS)
_BARE = "replace(replace(feature, 'num_scaler__', ''), '_', ' ')"
_TITLE = (
    f"array_to_string(list_transform(string_split({_BARE}, ' '), "
    "lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"
)
_SENTENCE = f"upper({_BARE}[1:1]) || {_BARE}[2:]"


def _display(key: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{name}'" for k, name in DISPLAY_NAMES.items())
    return f"CASE {key} {cases} ELSE {key} END"


_MATRIX_CELLS = ", ".join(
    f"round(coalesce(max(CASE WHEN platform = '{s}' THEN coef END), 0.0), 6) AS {s}" for s in SOURCES
)
_MATRIX_SIZE = "greatest(" + ", ".join(f"abs({s})" for s in SOURCES) + ")"

# ---- trends --------------------------------------------------------------------------------------------

DAILY = f"""daily AS (
  SELECT platform, date_trunc('day', event_ts) AS d, count(*) AS n,
         {', '.join(f'avg({m}) AS avg_{m}' for m in TREND_MEASURES)}
  FROM docs JOIN feat USING (review_id) JOIN meta USING (review_id) GROUP BY 1, 2)"""
SHARES = f"""shares AS (
  SELECT event_type AS platform, date_trunc('day', ts) AS w, count(*) AS n,
         sum({_stars('1 + event_id % 5')})::BIGINT AS negative
  FROM events WHERE {_stars('1 + event_id % 5')} IS NOT NULL GROUP BY 1, 2)"""
_DAY = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_SHARE_OUT = f"""SELECT platform, {_DAY.format('w')} AS window_start, n, negative,
  round(negative::DOUBLE / n, 6) AS share FROM shares"""

# ---- language --------------------------------------------------------------------------------------------

GRAMS = r"""letters AS (
  SELECT review_id, lang, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', ' ', 'g'), ' ') || ' ' AS s
  FROM docs),
points AS (SELECT review_id, lang, s, regexp_extract_all(s, '.') AS c FROM letters),
zipped AS (SELECT review_id, lang, unnest(list_zip(c, c[2:], c[3:])) AS z FROM points),
doc_grams AS (
  SELECT review_id, lang, z[1] || z[2] || z[3] AS gram, count(*) AS k
  FROM zipped WHERE z[3] IS NOT NULL GROUP BY ALL),
counts AS (SELECT lang, gram, sum(k)::BIGINT AS n FROM doc_grams GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS total FROM counts GROUP BY lang),
vocabulary AS (SELECT count(DISTINCT gram) AS v FROM counts)"""

_EVENT_CATEGORIES = ("click", "error", "purchase", "signup", "view")

def _contents(source: str, *columns: str) -> str:
    values = ", ".join(f"coalesce({c}::VARCHAR, '')" for c in columns)
    return f"keyed AS (SELECT *, md5(concat_ws(chr(31), {values})) AS content FROM {source})"


ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_json": _with(DOCS) + "SELECT review_id, rating, text, verified_purchase FROM docs",
    "scan_parquet": "SELECT * FROM documents",
    "scan_csv_dir": _with(DOCS, CHATS)
    + """SELECT NULL::VARCHAR AS "user", text AS review, nullif(recommend, '') AS recommend, NULL::VARCHAR AS post_date FROM docs
UNION ALL SELECT role, text, NULL, NULL FROM chats""",
    "union_missing_cols": _with(DOCS, CHATS)
    + """SELECT review_id::VARCHAR AS review_id, platform, rating, NULL::VARCHAR AS role, NULL::INT AS label FROM docs
UNION ALL SELECT review_id, NULL, NULL, role, label FROM chats""",
    "snapshot_roundtrip": _with(DOCS) + "SELECT * FROM docs",
    "csv_roundtrip": _with(DOCS) + "SELECT review_id, rating, verified_purchase, text FROM docs",
    "features_roundtrip": _with(DOCS, LEXICON, _text("docs"))
    + f"SELECT review_id, platform, {_TEXT_OUT} FROM docs JOIN feat USING (review_id)",
    "scan_coefs": _with(*_WITH_COEFS) + "SELECT platform, feature, coef FROM coefs",
    "coef_files": _with(*_WITH_COEFS) + "SELECT platform, feature, coef FROM coefs",
    "coef_order": _with(*_WITH_COEFS)
    + """SELECT platform, feature, coef, row_number() OVER (PARTITION BY platform ORDER BY coef, feature)::INT AS place,
  row_number() OVER (PARTITION BY platform ORDER BY abs(coef) DESC, feature)::INT AS importance FROM coefs""",
    # data sets from raw sources
    "create_amazon": _with(
        DOCS,
        """head AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY review_id) - 1 AS position FROM docs) WHERE position < 160)""",
        _contents("head", "rating", "text", "verified_purchase"),
    )
    + f"""SELECT rating, text, verified_purchase, content FROM ({_ranked('keyed', 'content', 42)}) WHERE rn <= 60""",
    "create_yelp": _with(DOCS, _contents("docs", "rating", "text"))
    + f"SELECT rating, text, content FROM ({_ranked('keyed', 'content', 33)}) WHERE rn <= 80",
    # sampling
    "sample_bounded": _with(DOCS, "head AS (SELECT * FROM docs WHERE review_id < 500)")
    + f"SELECT review_id, platform, rating FROM ({_ranked('head', 'review_id', 42)}) WHERE rn <= 100",
    "sample_uniform": f"SELECT event_id, event_type, round(value, 6) AS value FROM ({_ranked('events', 'event_id', 33)}) WHERE rn <= 400",
    "sample_cluster": _with(DOCS)
    + """SELECT review_id, platform, lang, rating FROM (
  SELECT *, row_number() OVER (ORDER BY md5('33:' || platform), md5('33:' || review_id::VARCHAR)) AS rn
  FROM docs WHERE lang = 'en') WHERE rn <= 120""",
    "stratified_split": _with(OUTCOMES, _split("outcomes", "negative_experience", "review_id"))
    + "SELECT review_id, negative_experience, is_test FROM split",
    # projection, cleaning, labels
    "preset_project": _with(DOCS, META)
    + """SELECT review_id, rating, text, helpful_vote, verified_purchase, "timestamp"
FROM docs JOIN meta USING (review_id)""",
    "clean_reviews": _with(DOCS)
    + f"SELECT review_id, platform, trim(text, '{BLANKS}') AS text FROM docs WHERE trim(text, '{BLANKS}') <> ''",
    "label_rating": _with(DOCS)
    + f"SELECT review_id, rating, {_stars('rating')} AS negative_experience FROM docs WHERE rating <> 3",
    "label_recommend": _with(DOCS)
    + """SELECT review_id, recommend, (CASE recommend WHEN 'Recommended' THEN 0 ELSE 1 END)::INT AS negative_experience
FROM docs WHERE recommend <> ''""",
    "label_zero_based": _with(DOCS)
    + f"SELECT review_id, label, {_stars('label')} AS as_is, {_stars('label + 1')} AS as_stars FROM docs",
    "lang_filter": "SELECT doc_id AS review_id, source AS platform, lang FROM documents WHERE lang = 'en'",
    "normalise_strings": _with(DOCS)
    + """SELECT review_id, coalesce(recommend, '') AS recommend, coalesce(quality::VARCHAR, '') AS quality,
  coalesce(toxic::VARCHAR, '') AS toxic FROM docs LEFT JOIN labels ON doc_id = review_id""",
    # dates
    "parse_dates": _with(META)
    + f"SELECT review_id, post_date, {_DAY.format(_PARSED)} AS parsed FROM meta WHERE {_PARSED} IS NOT NULL",
    "review_age": _with(META)
    + f"""SELECT review_id, floor(({_AS_OF_MICROS} - "timestamp" * 1000) / 86400000000)::BIGINT AS review_age_days FROM meta""",
    # text
    "text_shape": _with(DOCS, _shape("docs"))
    + """SELECT review_id, review_length_words, review_length_chars, exclamation_count,
  round(capital_ratio, 6) AS capital_ratio FROM shape""",
    "sentence_stats": _with(DOCS, _shape("docs"))
    + "SELECT review_id, sentences, round(avg_sentence_length, 6) AS avg_sentence_length FROM shape",
    "sentiment_lexicon": _with(DOCS, LEXICON, _sentiment("docs"))
    + f"SELECT review_id, {_rounded(TEXT_FEATURES[:2])} FROM mood",
    "text_features": _with(DOCS, LEXICON, _text("docs")) + f"SELECT review_id, {_TEXT_OUT} FROM feat",
    "negative_word_share": _with(DOCS, LEXICON, _sentiment("docs"))
    + """SELECT review_id, words, scored_words, negative_words,
  round(coalesce(negative_words::DOUBLE / nullif(scored_words, 0), 0), 6) AS negative_share_scored,
  round(coalesce(negative_words::DOUBLE / nullif(words, 0), 0), 6) AS negative_share_words FROM mood""",
    "lexical_markers": _with(DOCS, _tokens("docs", "tok"))
    + """SELECT review_id, len(list_filter(t, lambda w: w IN ('and', 'are')))::BIGINT AS intensifier_count,
  len(list_filter(t, lambda w: w IN ('from', 'was')))::BIGINT AS complaint_count FROM tok""",
    "lang_profiles": _with(DOCS, GRAMS)
    + """SELECT lang, gram, n, round(ln((n + 1)::DOUBLE / (total + v)), 6) AS logp
FROM counts JOIN totals USING (lang), vocabulary""",
    "lang_detect": _with(
        DOCS,
        GRAMS,
        """scores AS (
  SELECT g.review_id, t.lang, sum(k)::BIGINT AS grams,
         sum(k * round(ln((coalesce(c.n, 0) + 1)::DOUBLE / (total + v)) * 1000000)::BIGINT)::BIGINT AS score
  FROM doc_grams g CROSS JOIN totals t CROSS JOIN vocabulary
  LEFT JOIN counts c ON c.lang = t.lang AND c.gram = g.gram GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY score DESC, lang DESC) AS rn FROM scores)""",
    )
    + """SELECT p.review_id,
  CASE WHEN length(replace(s, ' ', '')) < 3 OR b.lang IS NULL THEN 'unknown' ELSE b.lang END AS lang_detected,
  coalesce(grams, 0) AS grams,
  CASE WHEN length(replace(s, ' ', '')) >= 3 THEN round(score::DOUBLE / grams / 1000000, 6) END AS mean_logp
FROM points p LEFT JOIN best b ON b.review_id = p.review_id AND rn = 1""",
    # feature tables
    "features_amazon": _with(*_DOC_FEATURES, AMAZON) + _features("amazon_beauty", "amazon"),
    "features_steam": _with(*_DOC_FEATURES, STEAM) + _features("steam", "steam"),
    "features_yelp": _with(LEXICON, CHATS, _text("chats", "chat_feat"), YELP) + _features("yelp", "yelp"),
    # profiles and distributions
    "data_profile": """SELECT count(*) AS rows, count(l.doc_id) AS labelled,
  count(*) FILTER (WHERE quality = 0 OR toxic = 1) AS negative
FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "missing_profile": _with(DOCS, OUTCOMES)
    + """SELECT unnest(['review_id', 'rating', 'recommend', 'negative_experience']) AS column_name,
  unnest([count(*) - count(review_id), count(*) - count(rating), count(*) - count(nullif(recommend, '')),
          count(*) - count(negative_experience)]) AS missing
FROM docs LEFT JOIN outcomes USING (review_id)""",
    "target_balance": _with(OUTCOMES)
    + """SELECT negative_experience, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share
FROM outcomes JOIN documents ON doc_id = review_id GROUP BY negative_experience""",
    "trimmed_distribution": _with(
        DOCS,
        LEXICON,
        _sentiment("docs"),
        _trimmed("docs JOIN mood USING (review_id)", "platform", "sentiment_polarity"),
    )
    + "SELECT * FROM trimmed",
    "violin_density": _with(
        DOCS,
        LEXICON,
        _sentiment("docs"),
        _trimmed("docs JOIN mood USING (review_id)", "platform", "sentiment_polarity"),
        """bandwidths AS (
  SELECT platform, stddev_samp(c) * pow(count(*), -0.2) AS h FROM clipped GROUP BY platform),
bins AS (
  SELECT platform, least(CASE WHEN upper > lower THEN floor((c - lower) / ((upper - lower) / 20)) ELSE 0 END, 19)::BIGINT AS bin,
         count(*) AS k, max(n) AS n, max(lower) AS lower, max((upper - lower) / 20) AS width
  FROM clipped GROUP BY ALL),
kernel AS (
  SELECT a.platform, a.bin, sum(b.k * exp(-0.5 * pow((b.bin - a.bin) * b.width / h, 2))) / (max(h) * max(b.n) * sqrt(2 * pi())) AS density
  FROM bins a JOIN bins b USING (platform) JOIN bandwidths USING (platform) WHERE h > 0 GROUP BY ALL)""",
    )
    + """SELECT b.platform, b.bin, round(lower + (b.bin + 0.5) * width, 6) AS centre, k AS n,
  round(k::DOUBLE / n, 6) AS share, round(density, 6) AS density
FROM bins b LEFT JOIN kernel USING (platform, bin)""",
    "sentiment_by_platform": _with(
        *_ALL_PLATFORMS,
        """tagged AS (
  SELECT 'Amazon (Beauty)' AS platform, sentiment_polarity FROM amazon WHERE negative_experience = 1
  UNION ALL SELECT 'Steam', sentiment_polarity FROM steam WHERE negative_experience = 1
  UNION ALL SELECT 'Yelp', sentiment_polarity FROM yelp WHERE negative_experience = 1)""",
        _trimmed("tagged", "platform", "sentiment_polarity"),
    )
    + "SELECT * FROM trimmed",
    "sentiment_by_outcome": _with(
        *_ALL_PLATFORMS,
        "tagged AS ("
        + " UNION ALL ".join(
            [
                _outcome_part("amazon", "amazon_beauty", "rating::INT"),
                _outcome_part("steam", "steam", "recommend"),
                _outcome_part("yelp", "yelp", "label + 1"),
            ]
        )
        + ")",
        _trimmed("tagged", "dataset, outcome", "sentiment_polarity"),
    )
    + "SELECT * FROM trimmed",
    "feature_distribution": _with(
        DOCS,
        LEXICON,
        OUTCOMES,
        _text("docs"),
        _tokens("docs", "tok"),
        """measured AS (
  SELECT platform, review_length_words::DOUBLE AS review_length_words, sentiment_subjectivity,
         len(list_filter(t, lambda w: w IN ('and', 'are')))::DOUBLE AS intensifier_count, capital_ratio
  FROM docs JOIN feat USING (review_id) JOIN tok USING (review_id) JOIN outcomes USING (review_id)
  WHERE negative_experience = 1),
measures AS (UNPIVOT measured ON review_length_words, sentiment_subjectivity, intensifier_count, capital_ratio
  INTO NAME feature VALUE value)""",
        _trimmed("measures", "platform, feature", "value"),
    )
    + "SELECT * FROM trimmed",
    # coefficients
    "top_coefs": _with(
        *_WITH_COEFS,
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY abs(coef) DESC, feature) AS r FROM coefs)",
    )
    + f"""SELECT platform, platform AS dataset, r::INT AS rank, {_TITLE} AS feature, coef FROM ranked WHERE r <= 5""",
    "key_matrix": _with(
        *_WITH_COEFS,
        f"named AS (SELECT platform, {_SENTENCE} AS name, coef FROM coefs)",
        "top AS (SELECT name FROM named GROUP BY name ORDER BY max(abs(coef)) DESC, name LIMIT 5)",
        f"cells AS (SELECT name, {_MATRIX_CELLS} FROM named WHERE name IN (SELECT name FROM top) GROUP BY name)",
    )
    + f"""SELECT row_number() OVER (ORDER BY {_MATRIX_SIZE}, name DESC)::INT AS rank, name AS feature,
  {', '.join(SOURCES)} FROM cells""",
    "display_names": f"""WITH keyed AS (
  SELECT doc_id AS review_id, ([{', '.join(repr(k) for k in (*PRESETS, 'elsewhere'))}])[doc_id % 7 + 1] AS dataset_key
  FROM documents)
SELECT review_id, dataset_key, {_display('dataset_key')} AS display_name FROM keyed""",
    # model stages
    "one_hot": "SELECT event_id, (event_type = 'signup')::INT::DOUBLE AS \"early_access_ohe__early_access_review_Early Access Review\", "
    + ", ".join(f"(event_type = '{c}')::INT::DOUBLE AS cat_ohe__event_type_{c}" for c in _EVENT_CATEGORIES)
    + " FROM events",
    "standardise": _with(
        _split("events", "event_type", "event_id"),
        """fitted AS (SELECT avg(user_id) AS mu, stddev_pop(user_id) AS su, avg(value) AS mv, stddev_pop(value) AS sv
  FROM split WHERE NOT is_test)""",
    )
    + """SELECT event_id, is_test, round((user_id - mu) / su, 6) AS num_scaler__user_id,
  round((value - mv) / sv, 6) AS num_scaler__value FROM split, fitted""",
    "class_weights": _with(OUTCOMES)
    + """SELECT negative_experience, count(*) AS n,
  round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6)::DOUBLE AS weight
FROM outcomes GROUP BY negative_experience""",
    "classification_report": _with(
        DOCS,
        OUTCOMES,
        """judged AS (
  SELECT negative_experience AS y, CASE WHEN rating <= 2 THEN 1 ELSE 0 END AS g FROM docs JOIN outcomes USING (review_id)),
per_class AS (
  SELECT c, count(*) FILTER (WHERE y = c) AS support,
         coalesce(count(*) FILTER (WHERE y = c AND g = c)::DOUBLE / nullif(count(*) FILTER (WHERE g = c), 0), 0) AS p,
         coalesce(count(*) FILTER (WHERE y = c AND g = c)::DOUBLE / nullif(count(*) FILTER (WHERE y = c), 0), 0) AS r
  FROM judged, (VALUES (0), (1)) AS classes(c) GROUP BY c),
scored AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM per_class),
overall AS (SELECT avg((y = g)::INT) AS a, count(*) AS n FROM judged)""",
    )
    + """SELECT c::VARCHAR AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM scored
UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n FROM overall
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM scored
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM scored""",
    # trends and monitoring
    "trend_daily": _with(DOCS, META, LEXICON, _text("docs"), DAILY)
    + f"""SELECT platform, {_DAY.format('d')} AS day, n,
  {', '.join(f'round(avg_{m}, 6) AS avg_{m}' for m in TREND_MEASURES)} FROM daily""",
    "trend_moving": _with(DOCS, META, LEXICON, _text("docs"), DAILY)
    + f"""SELECT platform, {_DAY.format('d')} AS day,
  {', '.join(f'round(avg(avg_{m}) OVER recent, 6) AS moving_{m}' for m in TREND_MEASURES)}
FROM daily WINDOW recent AS (PARTITION BY platform ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "stream_negative_share": _with(SHARES) + _SHARE_OUT,
    "stream_alerts": _with(SHARES) + _SHARE_OUT + f" WHERE negative::DOUBLE / n > {STREAM_THRESHOLD}",
    "flagship_profile": _with(DOCS, LEXICON, OUTCOMES, _text("docs"))
    + f"""SELECT platform, negative_experience, count(*) AS reviews,
  {', '.join(f'round(avg({c}), 6) AS avg_{c}' for c in TEXT_FEATURES)}
FROM docs JOIN feat USING (review_id) JOIN outcomes USING (review_id) GROUP BY ALL""",
}
ORACLES["create_steam"] = _with(
    DOCS,
    f"predicted AS ({ORACLES['lang_detect']})",
    "english AS (SELECT * FROM docs JOIN predicted USING (review_id) WHERE lang_detected = 'en' AND trim(text) <> '')",
    _contents("english", "text", "recommend", "platform"),
) + """SELECT platform AS "user", text AS review, recommend FROM (
  SELECT *, row_number() OVER (ORDER BY md5('33:' || platform), md5('33:' || content)) AS rn FROM keyed) WHERE rn <= 70"""
ORACLES |= more.model_sql((DOCS, META, OUTCOMES, _with, _split))
ORACLES |= more.phrase_sql(DOCS, LEXICON, _tokens, _with) | more.change_sql(SHARES, _with)
ORACLES |= more.distance_sql(DOCS, LEXICON, OUTCOMES, _sentiment("docs"), _with)
ORACLES |= more.summary_sql(DOCS, META, LEXICON, _sentiment("docs"), _with)
ORACLES |= more.bootstrap_sql(DOCS, LEXICON, _sentiment("docs"), _with)
ORACLES |= more.sample_sql(DOCS, _with)
ORACLES |= more.break_sql(_with)
ORACLES |= more.refresh_sql(DOCS, ORACLES["features_roundtrip"], _with)
