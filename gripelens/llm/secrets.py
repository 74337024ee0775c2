"""Secrets in whole texts, with column functions only.

Base finds. Three patterns are matched over the whole text. Matches are set off by a
separator character that no pattern can contain, and the text is split at it: the lengths
of the parts give every match's place in code points. Texts without a match never enter
that step.

Added finds. Two character Markov models, of random strings and of ordinary identifiers,
score every other long run of identifier characters: the mean log-likelihood ratio of its
adjacent characters decides. Random strings are learned from the values of the base finds
(numbers, hexadecimal runs and keys), identifiers from the long words
of the same documents. The sample is some SAMPLE_ROWS documents.

Rows: a null text counts as empty; an empty text has no spans. Spans are
``kind:start:end`` in code points, end exclusive, ordered by start and then by kind as in
KINDS. Other columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in their order, and the patterns of the base finds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
LONG_HEX = f"{HEX[:-1]}{{{HEX_MIN},}}"

RUN = r"[A-Za-z0-9+/_=-]{20,}"
RUN_MIN = 20
# Mean log-likelihood ratio per pair of characters from which a run counts as random.
THRESHOLD = 0.35
SAMPLE_ROWS = 50_000

# Noncharacters: no pattern matches them. A text that holds the first gets the second.
_MARK, _STAND_IN = "￿", "￾"
_CODES = 128
# Elements of an array that are summed one by one.
_BLOCK = 64


def _set_off(text: Column, pattern: str) -> Column:
    """Parts of the text; those at odd positions (from 0) are the matches."""
    return F.split(F.regexp_replace(text, f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside a lambda function an expression from
    outside is computed again for every element, a variable is not."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, levels: int = 2) -> Column:
    """Sums of the values before each value. Arrays grow by copying, so that a plain running sum is
    quadratic: sums run within blocks, and the sums before each block are found in the same way."""

    def plain(numbers: Column) -> Column:
        zero = F.array(F.lit(0))
        return F.aggregate(numbers, zero, lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))

    def within(numbers: Column) -> Column:
        first = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)), F.lit(_BLOCK))
        blocks = F.transform(first, lambda i: plain(F.slice(numbers, i, F.lit(_BLOCK))))
        return _let(blocks, joined)

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda sums: F.element_at(sums, -1))
        before = _running(totals, levels - 1) if levels > 1 else plain(totals)

        def shifted(offsets: Column) -> Column:
            def move(sums: Column, i: Column) -> Column:
                return F.transform(F.slice(sums, F.lit(1), F.size(sums) - 1), lambda x: x + offsets[i])

            return F.flatten(F.transform(blocks, move))

        return _let(before, shifted)

    return _let(values, within)


def _matches(text: Column, pattern: str, keep) -> Column:
    """array<struct<start, end, value>> of the matches for which ``keep(value)`` holds."""

    def placed(parts: Column) -> Column:
        def spans(starts: Column) -> Column:
            return F.transform(
                parts,
                lambda part, i: F.struct(
                    starts[i].alias("start"), (starts[i] + F.length(part)).alias("end"), part.alias("value")
                ),
            )

        return _let(_running(F.transform(parts, F.length)), spans)

    spans = _let(_set_off(text, pattern), placed)
    return F.filter(spans, lambda m, i: (i % 2 == 1) & keep(m["value"]))


def _points_before(points: Column, places: Column, at_place: bool) -> Column:
    """How many points lie before each of the ascending places; those at the place itself count if ``at_place``."""
    marks = F.concat(
        F.transform(points, lambda x: F.struct(x.alias("at"), F.lit(int(not at_place)).alias("turn"), F.lit(-1).alias("k"))),
        F.transform(places, lambda x, k: F.struct(x.alias("at"), F.lit(int(at_place)).alias("turn"), k.alias("k"))),
    )
    counted = F.transform(F.array_sort(marks), lambda m, i: F.when(m["k"] >= 0, i - m["k"]))
    return F.filter(counted, lambda n: n.isNotNull())


def _apart(runs: Column, base: Column) -> Column:
    """Runs that overlap no base find. The finds that begin before a run's end, less those that end
    before its start, are those it overlaps."""

    def side(spans: Column, name: str) -> Column:
        return F.transform(spans, lambda m: m[name])

    begun = _points_before(side(base, "start"), side(runs, "end"), False)
    ended = _points_before(side(base, "end"), side(runs, "start"), True)
    overlaps = F.zip_with(begun, ended, lambda x, y: x - y)
    free = _let(overlaps, lambda n: F.filter(runs, lambda r, i: n[i] == 0))
    return F.when((F.size(runs) == 0) | (F.size(base) == 0), runs).otherwise(free)


def _when_found(text: Column, pattern: str, matches: Column) -> Column:
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), matches).otherwise(none)


def _assigned(value: Column) -> Column:
    return F.regexp_extract(value, ASSIGN, 1)


def base_finds(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_text`` and the arrays ``_assign``, ``_access`` and ``_hex``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn("_text", F.when(text.contains(_MARK), F.replace(text, F.lit(_MARK), F.lit(_STAND_IN))).otherwise(text))
    text = F.col("_text")
    # Runs of at least 16 are runs: greedy matching takes each as a whole. The other two must
    # see short matches as well, since those use up text.
    return df.withColumns(
        {
            "_assign": _when_found(
                text,
                ASSIGN,
                _matches(text, ASSIGN, lambda v: F.length(_assigned(v)) >= ASSIGN_MIN),
            ),
            "_access": _when_found(
                text, ACCESS, _matches(text, ACCESS, lambda v: F.length(v) >= ACCESS_MIN)
            ),
            "_hex": _when_found(text, LONG_HEX, _matches(text, LONG_HEX, lambda v: F.lit(True))),
        }
    )


def _pairs(value: Column) -> Column:
    """Codes of adjacent characters; characters outside ASCII do not occur in runs. Bytes are
    reached at once, characters of a string only from its start."""

    def codes(raw: Column) -> Column:
        def code(i: Column) -> Column:
            return F.ascii(F.substring(raw, i, F.lit(1)).cast("string"))

        places = F.when(F.length(raw) > 1, F.sequence(F.lit(1), F.length(raw) - 1))
        return F.transform(
            F.coalesce(places, F.array().cast("array<int>")), lambda i: code(i) * _CODES + code(i + 1)
        )

    return _let(value.cast("binary"), codes)


def samples(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(value, random): labelled strings from about ``rows`` documents, chosen by a hash of
    their columns; from all, if there are no more."""
    share = min(1.0, rows / max(df.count(), 1))
    chosen = df if share == 1.0 else df.where(F.xxhash64(*df.columns) < F.lit(int((share - 0.5) * 2**64)))
    value = F.concat(
        F.transform("_assign", lambda m: _assigned(m["value"])),
        F.transform("_access", lambda m: m["value"]),
        F.transform("_hex", lambda m: m["value"]),
    )
    words = F.regexp_extract_all(F.col("_text"), F.lit(r"[A-Za-z][A-Za-z_-]{7,}"), F.lit(0))

    def labelled(values: Column, random: int) -> Column:
        return F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(random).alias("random")))

    both = F.concat(labelled(value, 1), labelled(words, 0))
    return base_finds(chosen.select("text")).select(F.explode(both).alias("s")).select("s.*")


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of every pair of ASCII codes, add-one
    smoothed over the characters that follow; 128 x 128 numbers whatever the sample."""
    counts = (
        labelled.select("random", F.explode(_pairs(F.col("value"))).alias("pair"))
        .groupBy("pair")
        .agg(F.sum("random").alias("r"), F.sum(1 - F.col("random")).alias("o"))
        .collect()
    )
    size = _CODES * _CODES
    table = {c: [0.0] * size for c in "ro"}
    for row in counts:
        for c in "ro":
            table[c][row["pair"]] = float(row[c])
    seen = 66  # characters a run can hold
    out = [0.0] * size
    for first in range(_CODES):
        span = range(first * _CODES, (first + 1) * _CODES)
        total = {c: sum(table[c][i] for i in span) + seen for c in "ro"}
        for i in span:
            out[i] = round(
                math.log((table["r"][i] + 1) / total["r"]) - math.log((table["o"][i] + 1) / total["o"]), 4
            )
    return out


def _mean_ratio(value: Column, ratios: list[float]) -> Column:
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    total = F.aggregate(
        _pairs(value), F.lit(0.0), lambda s, p: s + F.element_at(table, p.cast("int") + 1)
    )
    return total / (F.length(value) - 1)


def scan(df: DataFrame, ratios: list[float], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``n_assign``, ``n_access``, ``n_hex``, ``n_random``, ``base_spans`` and ``spans``
    (arrays of ``kind:start:end``). Added finds do not overlap base ones."""
    found = base_finds(df, text_col)
    text = F.col("_text")
    base = F.concat("_assign", "_access", "_hex")
    runs = _when_found(text, RUN, _matches(text, RUN, lambda v: F.length(v) >= RUN_MIN))
    found = found.withColumn("_base", base).withColumn("_runs", runs)
    found = found.withColumn("_free", _apart(F.col("_runs"), F.col("_base")))
    found = found.withColumn("_random", F.filter("_free", lambda r: _mean_ratio(r["value"], ratios) >= threshold))

    def ordered(n: int, kind: str) -> Column:
        return F.transform(
            f"_{kind}",
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(n).alias("n"), m["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    def listed(kinds: tuple[str, ...]) -> Column:
        parts = [ordered(n, kind) for n, kind in enumerate(kinds)]
        return F.transform(
            F.array_sort(F.concat(*parts)), lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])
        )

    return found.withColumns(
        {
            **{f"n_{k}": F.size(f"_{k}").cast("bigint") for k in KINDS},
            "base_spans": listed(KINDS[:3]),
            "spans": listed(KINDS),
        }
    ).drop("_text", "_base", "_runs", "_free", *[f"_{k}" for k in KINDS])
