"""Language identification by character trigrams (naive Bayes over n-gram counts).

Training is one aggregation over labelled text; detection spreads whole texts into
trigrams, meets the profile in a size-checked join and sums per review. Log
probabilities are whole millionths, so sums are exact and repeatable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelens.runtime import fits_broadcast, lookup_join

UNKNOWN = "unknown"
MIN_LETTERS = 3
_MICRO = 1_000_000
_END = 0  # code of the one extra row per text; no trigram has it


def letters_only(text: Column) -> Column:
    """Lower-case letters with single blanks between and around words."""
    spaced = F.regexp_replace(
        F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\P{L}+", " "
    )
    return F.concat(F.lit(" "), F.btrim(spaced), F.lit(" "))


def _runs(df: DataFrame, letters_col: str, keep: list[str]) -> DataFrame:
    """One row (keep..., _g) per code point, ``_g`` holding it and its two successors; the
    successors are null on the last rows of a text."""
    # Splitting on nothing yields code points without a regular expression.
    points = F.split(F.col(letters_col), "", -1)
    later = [F.slice("_c", F.lit(k), F.size("_c")) for k in (2, 3)]
    zipped = F.arrays_zip("_c", later[0].alias("_d"), later[1].alias("_e"))
    return df.select(*keep, points.alias("_c")).select(*keep, F.explode(zipped).alias("_g"))


def explode_trigrams(df: DataFrame, letters_col: str, keep: list[str]) -> DataFrame:
    """One row (keep..., gram) per run of three code points."""
    gram = F.coalesce(F.concat("_g._c", "_g._d", "_g._e"), F.lit(""))
    return (
        _runs(df, letters_col, keep)
        .where(F.col("_g._e").isNotNull())
        .select(*keep, gram.alias("gram"))
    )


def _code(*points: Column) -> Column:
    """Three code points as one number, 21 bits each: joins faster than text."""
    a, b, c = (F.ascii(p).cast("bigint") for p in points)
    return F.shiftleft(a, 42) + F.shiftleft(b, 21) + c


def gram_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over whole texts."""
    letters = df.select(lang_col, letters_only(F.col(text_col)).alias("_letters"))
    return (
        explode_trigrams(letters.dropna(subset=[lang_col]), "_letters", [lang_col])
        .groupBy(F.col(lang_col).alias("lang"), "gram")
        .agg(F.count("*").alias("n"))
    )


def smoothed_profiles(counts: DataFrame) -> DataFrame:
    """(lang, gram, n, logp) with add-one smoothing over the common vocabulary.

    ``counts`` is read several times: pass a materialised table.
    """
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    vocabulary = counts.agg(F.count_distinct("gram")).scalar()
    return (
        counts.join(totals, "lang")
        .withColumn("logp", F.ln((F.col("n") + 1) / (F.col("total") + vocabulary)))
        .select("lang", "gram", "n", "logp")
    )


@dataclass(frozen=True)
class LanguageModel:
    """One row per trigram code, one whole-millionth score column per language."""

    languages: tuple[str, ...]
    scores: DataFrame
    small: bool

    @staticmethod
    def from_counts(counts: DataFrame) -> "LanguageModel":
        """``counts`` is read several times: pass a materialised table."""
        totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        vocabulary = counts.agg(F.count_distinct("gram").alias("v")).first()["v"]
        languages = tuple(sorted(totals))
        wide = counts.groupBy("gram").pivot("lang", list(languages)).agg(F.sum("n"))
        letters = [F.substring("gram", i, 1) for i in (1, 2, 3)]
        scores = wide.select(
            _code(*letters).alias("code"),
            *[
                F.round(
                    F.ln((F.coalesce(F.col(f"`{lang}`"), F.lit(0)) + 1) / F.lit(totals[lang] + vocabulary))
                    * _MICRO
                )
                .cast("bigint")
                .alias(f"score_{i}")
                for i, lang in enumerate(languages)
            ],
        )
        return LanguageModel(languages, scores, fits_broadcast(scores))

    def save(self, path: str) -> None:
        """One parquet table; the languages are part of its column names."""
        named = {f"score_{i}": f"score_{i}_{lang}" for i, lang in enumerate(self.languages)}
        self.scores.withColumnsRenamed(named).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LanguageModel":
        stored = spark.read.parquet(path)
        named = {c: c.split("_", 2) for c in stored.columns if c.startswith("score_")}
        languages = tuple(lang for _, _, lang in sorted(named.values(), key=lambda p: int(p[1])))
        scores = stored.withColumnsRenamed({c: f"score_{i}" for c, (_, i, _) in named.items()})
        scores = scores.select("code", *[f"score_{i}" for i in range(len(languages))])
        return LanguageModel(languages, scores, fits_broadcast(scores))


def detect_language(
    df: DataFrame, model: LanguageModel, id_col: str = "review_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_detected, grams, mean_logp) for every row.

    Texts with fewer than three letters, or without any known trigram, are 'unknown'.
    """
    sums = [f"score_{i}" for i in range(len(model.languages))]
    end = model.scores.sparkSession.range(1).select(
        F.lit(_END).cast("bigint").alias("code"), *[F.lit(None).cast("bigint").alias(c) for c in sums]
    )
    letters = F.col("_letters")
    enough = F.char_length(F.replace(letters, F.lit(" "), F.lit(""))) >= MIN_LETTERS
    narrow = df.select(id_col, letters_only(F.col(text_col)).alias("_letters")).withColumn(
        "_enough", enough
    )
    # The last row of a text has no successors and serves as its end entry.
    complete = F.col("_g._e").isNotNull()
    code = F.when(complete, _code(F.col("_g._c"), F.col("_g._d"), F.col("_g._e"))).otherwise(F.lit(_END))
    spread = (
        _runs(narrow, "_letters", [id_col, "_enough"])
        .where(complete | F.col("_g._d").isNull())
        .select(id_col, "_enough", F.coalesce(code, F.lit(_END)).alias("code"))
    )
    scored = (
        lookup_join(spread, model.scores.unionByName(end), "code", "inner", model.small, id_col)
        .groupBy(id_col)
        .agg(
            F.max("_enough").alias("_enough"),
            F.count("score_0").alias("grams"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    best = F.array_max(
        F.array(
            *[
                F.struct(F.col(f"score_{i}").alias("score"), F.lit(lang).alias("lang"))
                for i, lang in enumerate(model.languages)
            ]
        )
    )
    known = F.col("_enough") & (F.col("grams") > 0)
    return scored.withColumn("_best", best).select(
        id_col,
        F.when(known, F.col("_best.lang")).otherwise(UNKNOWN).alias("lang_detected"),
        "grams",
        F.when(known, F.col("_best.score") / F.col("grams") / _MICRO).alias("mean_logp"),
    )
