"""Terms of several words: longest match from the left, scored and counted per review.

A phrase is a sequence of tokens. At every token of a text the longest phrase that begins there
is a match, unless an earlier match covers the token. Phrases and single words live in one table;
"not good" as an entry thus wins over "good".

Every token goes with the tokens after it (as many as the longest phrase has) and the two before;
the runs of each length that occurs among the phrases meet the table in the stage that reads the
text. The table is broadcast within a measured bound; beyond it short runs are shuffled under
salts, never texts. Only matches are grouped by review, and overlaps are resolved in one
pass over a review's matches in order, so the work is linear in the text.

Rows: reviews without a match, empty and null texts keep one row with zeros. Phrases without a token
are ignored; of a phrase listed several times scores are averaged and the first kind counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripelens.functions.text import tokens
from gripelens.operators.sentiment import Lexicon
from gripelens.runtime import fits_broadcast, lookup_join

_MICRO = 1_000_000
_END = ""  # the run that stands for the review itself; no phrase is empty


@dataclass(frozen=True)
class PhraseBook:
    """(run, words, kind, polarity, subjectivity), the lengths that occur, and whether it is small."""

    table: DataFrame
    lengths: tuple[int, ...]
    small: bool

    @staticmethod
    def build(phrases: DataFrame) -> "PhraseBook":
        """``phrases``: phrase, kind, polarity, subjectivity (the last three may be null)."""
        cut = phrases.withColumn("_t", tokens(F.col("phrase"))).where(F.size("_t") > 0)
        table = cut.groupBy(F.array_join("_t", " ").alias("run"), F.size("_t").alias("words")).agg(
            F.min("kind").alias("kind"), F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity")
        )
        lengths = tuple(sorted(r["words"] for r in table.select("words").distinct().collect()))
        none = [F.lit(None).cast(t).alias(c) for c, t in (("kind", "string"), ("polarity", "double"), ("subjectivity", "double"))]
        end = table.sparkSession.range(1).select(F.lit(_END).alias("run"), F.lit(0).alias("words"), *none)
        return PhraseBook(table.unionByName(end), lengths, fits_broadcast(table))


def _shifted(array: Column, by: int) -> Column:
    """The array moved so that element i is element i + by of the original, or null."""
    if by < 0:
        return F.concat(F.array_repeat(F.lit(None).cast("string"), -by), array)
    return F.slice(array, F.lit(by + 1), F.size(array)) if by else array


def phrase_matches(
    df: DataFrame, book: PhraseBook, id_col: str = "review_id", text_col: str = "text"
) -> DataFrame:
    """(id, start, words, kind, polarity, subjectivity, prev1, prev2) of all phrases in the texts,
    overlapping ones included, and one row with words 0 for each review."""
    reach = max(book.lengths, default=1)
    around = [_shifted(F.col("_t"), k).alias(f"t{k}") for k in range(reach)]
    around += [_shifted(F.col("_t"), -k).alias(f"b{k}") for k in (1, 2)]
    each = df.select(id_col, tokens(F.col(text_col)).alias("_t")).select(
        id_col, F.posexplode_outer(F.arrays_zip(*around)).alias("start", "w")
    )
    runs = []
    for n in book.lengths:
        run = F.col("w.t0")
        for k in range(1, n):
            run = F.concat(run, F.lit(" "), F.col(f"w.t{k}"))
        runs.append(run)
    # The review's own row hangs on its first token, or on its absence.
    own = F.when(F.coalesce(F.col("start"), F.lit(0)) == 0, F.lit(_END))
    spread = each.select(
        id_col, "start", F.col("w.b1").alias("prev1"), F.col("w.b2").alias("prev2"), F.explode(F.array(own, *runs)).alias("run")
    ).where(F.col("run").isNotNull())
    return lookup_join(spread, book.table, "run", "inner", book.small, id_col).drop("run")


def _resolved(matches: DataFrame, id_col: str, counters: dict[str, Column]) -> DataFrame:
    """(id, matches, counters...): sums over the matches that remain, leftmost and longest first."""
    fields = [value.cast("bigint").alias(name) for name, value in counters.items()]
    place = F.struct(F.col("start").alias("at"), (-F.col("words")).alias("less"), *fields)
    listed = matches.groupBy(id_col).agg(F.array_sort(F.collect_list(F.when(F.col("words") > 0, place))).alias("_m"))
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("end"), zero.alias("matches"), *[zero.alias(c) for c in counters])

    def take(done: Column, m: Column) -> Column:
        taken = F.struct(
            (m["at"] - m["less"]).cast("bigint").alias("end"), (done["matches"] + 1).alias("matches"),
            *[(done[c] + F.coalesce(m[c], zero)).alias(c) for c in counters],
        )
        return F.when(m["at"] >= done["end"], taken).otherwise(done)

    total = listed.select(id_col, F.aggregate("_m", start, take).alias("_r"))
    return total.select(id_col, "_r.matches", *[F.col(f"_r.{c}").alias(c) for c in counters])


def phrase_counts(
    df: DataFrame, book: PhraseBook, kinds: Sequence[str], id_col: str = "review_id", text_col: str = "text"
) -> DataFrame:
    """(id, matches, <kind>_count...): matches of each kind per review."""
    counters = {f"{k}_count": F.when(F.col("kind") == k, 1).otherwise(0) for k in kinds}
    return _resolved(phrase_matches(df, book, id_col, text_col), id_col, counters)


def phrase_sentiment(
    df: DataFrame, book: PhraseBook, lexicon: Lexicon, id_col: str = "review_id", text_col: str = "text"
) -> DataFrame:
    """(id, scored_units, sentiment_polarity, sentiment_subjectivity): means over the scored matches.

    Intensifiers and negations of ``lexicon`` act on a match as on a word: the intensifier right
    before it, a negation among the two tokens before it.
    """
    near = lexicon.modifiers.select(F.col("term").alias("prev1"), "boost", F.col("flip").alias("flip1"))
    far = lexicon.modifiers.select(F.col("term").alias("prev2"), F.col("flip").alias("flip2")).where("flip2 IS NOT NULL")
    hits = phrase_matches(df, book, id_col, text_col)
    hits = lookup_join(hits, near, "prev1", "left", lexicon.small_modifiers, id_col)
    hits = lookup_join(hits, far, "prev2", "left", lexicon.small_modifiers, id_col)
    boost = F.coalesce("boost", F.lit(1.0))
    flip = F.coalesce("flip1", "flip2", F.lit(1.0))
    scored = F.col("polarity").isNotNull()
    polarity = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("polarity") * boost * flip))
    subjectivity = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("subjectivity") * boost))
    summed = _resolved(
        hits,
        id_col,
        {
            "scored_units": F.when(scored, 1).otherwise(0),
            "_p": F.when(scored, F.round(polarity * _MICRO)),
            "_s": F.when(scored, F.round(subjectivity * _MICRO)),
        },
    )
    mean = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("scored_units")) / _MICRO, F.lit(0.0))
    return summed.select(
        id_col, "matches", "scored_units", mean("_p").alias("sentiment_polarity"), mean("_s").alias("sentiment_subjectivity")
    )
