"""Removal of repeated and nearly repeated lines: an exact set-similarity join.

A line is the set of its lower-case words. A line goes if an earlier line, in the order of
(doc_id, line number), has a Jaccard similarity of at least ``percent`` / 100; whether that
earlier line stays itself does not matter. Lines without words always stay. Everything is
column functions.

1. Lines with the same set form a class; one narrow row per line says so. The words of a
   set are ordered by rarity: one byte per hash bucket (BUCKETS of them, a fixed size) holds
   the logarithm of the bucket's count over all tables, rarest first, ties by hash. Any
   fixed order keeps the join exact; the counts only make prefixes selective.
2. Prefix filter: two sets can only be similar if they share one of their first
   ``n - ceil(t n) + 1`` words. Classes meet on those words; length, positional and
   bitmap filters (parity of the hashed words; its distance is a lower bound of the sets'
   difference) act inside the join. Sets too small to be similar without being equal
   stay out of it.
3. Hot words: where CROWD or more classes share a prefix word, every class first meets
   only the word's earliest line. Who matches is settled and leaves the probing side, so
   that a family of thousands of variants costs one row each. The rest meets all.
4. Candidates are verified on the words of the lines themselves.

Rows: a null text counts as empty and stays null. Rows with the same ``doc_id`` are one document
as to order: line k of each is judged alike. A row without ``doc_id`` has no place in the order: it keeps its
lines and counts for no other. Other columns pass
through; input columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripelens.runtime import lookup_join, made_paths, materialise, release

BUCKETS = 1 << 18
CROWD = 128
# Blanks inside a line besides the space.
BLANKS = "\t\r\f\v"
_CLASS = ["c1", "c2"]


def _plain(text: Column) -> Column:
    """Lower case, with spaces for all blanks but line breaks (most texts hold no others)."""
    odd = F.lit(False)
    for blank in BLANKS:
        odd = odd | text.contains(blank)
    lowered = F.lower(text)
    return F.when(odd, F.translate(lowered, BLANKS, " " * len(BLANKS))).otherwise(lowered)


def line_words(line: Column) -> Column:
    """Distinct lower-case words of a line."""
    return F.array_remove(F.array_distinct(F.split(_plain(line), " ")), "")


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1))


def word_counts(docs: DataFrame) -> Column:
    """A constant: one byte per hash bucket, four times the binary logarithm of its count."""
    word = F.explode(F.split(F.replace(_plain(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("w")
    counts = docs.select(word).groupBy(_bucket(F.xxhash64("w")).cast("int").alias("b")).agg(F.count("*").alias("n"))
    level = F.least(1 + 4 * F.log2("n"), F.lit(127.0)).cast("int")
    table = np.zeros(BUCKETS, np.uint8)
    found = counts.select("b", level.alias("level")).toArrow()  # at most BUCKETS rows, as numbers
    table[found["b"].to_numpy()] = found["level"].to_numpy()
    return F.lit(bytearray(table.tobytes()))


def _by_rarity(line: Column, counts: Column) -> Column:
    """The distinct words as numbers, rarest first: the count's byte, then 56 bits of the hash."""
    hashes = F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)))

    def key(h: Column) -> Column:
        byte = F.ascii(F.substring(counts, (_bucket(h) + 1).cast("int"), F.lit(1)).cast("string"))
        return F.shiftleft(byte.cast("bigint"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    return F.sort_array(F.transform(F.array_remove(hashes, F.xxhash64(F.lit(""))), key))


def _ceil_share(n: Column, percent: int, of: int = 100) -> Column:
    return F.floor((n * percent + (of - 1)) / of).cast("int")


@dataclass(frozen=True)
class LineDedup:
    percent: int = 90

    def _smallest(self) -> int:
        """Size from which a set can be similar to a larger one."""
        return -(-self.percent // (100 - self.percent)) if self.percent < 100 else 1 << 30

    def lines(self, docs: DataFrame) -> DataFrame:
        """(doc_id, line, n, c1, c2, prefix, bits) of every line that has words."""
        counts = word_counts(docs)
        n = F.col("n")
        parity = F.aggregate(
            "keys",
            F.lit(0).cast("bigint"),
            lambda s, k: s.bitwiseXOR(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), k.bitwiseAND(F.lit(63)).cast("int"))
            ),
        )
        wide = F.when(n >= self._smallest(), n - _ceil_share(n, self.percent) + 1).otherwise(0)
        return (
            docs.select("doc_id", F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("line", "value"))
            .where(F.ltrim("value") != "")
            .select("doc_id", "line", _by_rarity(F.col("value"), counts).alias("keys"))
            .select(
                "doc_id",
                "line",
                F.size("keys").alias("n"),
                F.xxhash64("keys").alias("c1"),
                F.xxhash64(F.lit(17), "keys").alias("c2"),
                "keys",
            )
            .select(
                "doc_id",
                "line",
                "n",
                "c1",
                "c2",
                F.slice("keys", F.lit(1), wide).alias("prefix"),
                F.when(wide > 0, parity).otherwise(F.lit(0)).alias("bits"),
            )
        )

    def _prefixes(self, classes: DataFrame, *more: str) -> DataFrame:
        """One row per class and prefix word; ``place`` holds size and position in one number."""
        rows = classes.where(F.size("prefix") > 0).select(
            *more, *_CLASS, "n", "bits", F.posexplode("prefix").alias("pos", "key")
        )
        return rows.select(
            *more, *_CLASS, "key", "bits", (F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("pos")).alias("place")
        )

    def _may_match(self, a: str, b: str) -> Column:
        """Length, positional and bitmap filter for two prefix rows with the same word."""
        n, m = (F.shiftright(f"{side}.place", 32) for side in (a, b))
        needed = _ceil_share(n + m, self.percent, 100 + self.percent)
        rest = F.least(*(size - F.col(f"{side}.place").bitwiseAND(F.lit(0xFFFFFFFF)) for size, side in ((n, a), (m, b))))
        apart = F.bit_count(F.col(f"{a}.bits").bitwiseXOR(F.col(f"{b}.bits")))
        return (
            (F.least(n, m) * 100 >= F.greatest(n, m) * self.percent)
            & (rest >= needed)
            & (apart <= n + m - 2 * needed)
            & ((F.col(f"{a}.c1") != F.col(f"{b}.c1")) | (F.col(f"{a}.c2") != F.col(f"{b}.c2")))
        )

    def _verified(self, pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
        """Classes (c1, c2) with a similar earlier class (d1, d2) among the candidate pairs."""
        before = set(made_paths())
        one = pairs.select(*_CLASS, "d1", "d2").distinct()
        place = F.struct("doc_id", "line")
        here = classes.select(*_CLASS, place.alias("at"))
        there = classes.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), place.alias("before"))
        ordered = materialise(
            one.join(here, _CLASS).join(there, ["d1", "d2"]).where(F.col("before") < F.col("at")), "line-pairs"
        )
        wanted = (
            ordered.select("at").unionByName(ordered.select(F.col("before").alias("at"))).distinct()
            .groupBy("at.doc_id").agg(F.sort_array(F.collect_list("at.line")).alias("wanted"))
        )
        texts = lookup_join(docs.select("doc_id", "text"), materialise(wanted, "line-places"), "doc_id")
        parts = F.split("text", "\n")
        sets = materialise(
            texts.select("doc_id", F.explode("wanted").alias("line"), parts.alias("parts"))
            .select(F.struct("doc_id", "line").alias("at"), F.get("parts", F.col("line")).alias("value"))
            .where(F.col("value").isNotNull())
            .select("at", line_words(F.col("value")).alias("words")),
            "line-sets",
        )
        first = ordered.join(sets.select("at", F.col("words").alias("x")), "at")
        second = first.join(sets.select(F.col("at").alias("before"), F.col("words").alias("y")), "before")
        shared = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - shared
        similar = second.where(shared * 100 >= union * self.percent).select(*_CLASS).distinct()
        spent = [p for p in made_paths() if p not in before]
        found = materialise(similar, "line-similar")
        release(docs.sparkSession, spent)
        return found

    def similar(self, classes: DataFrame, docs: DataFrame) -> DataFrame:
        """Classes (c1, c2) that have a similar earlier class."""
        prefixes = self._prefixes(classes)
        crowds = materialise(
            prefixes.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") >= CROWD).select("key"),
            "line-crowds",
        )
        within = lookup_join(
            self._prefixes(classes, "doc_id", "line"), crowds, "key", spread_by="c1"
        )
        leaders = materialise(
            within.groupBy("key").agg(F.min(F.struct("doc_id", "line", "c1", "c2", "bits", "place")).alias("l")).select("key", "l.*"),
            "line-leaders",
        )
        side = lookup_join(
            within.select("key", F.struct("c1", "c2", "bits", "place").alias("p")),
            leaders.select("key", F.struct("c1", "c2", "bits", "place").alias("q")),
            "key",
            spread_by="p",
        )
        both = [F.col("p.c1").alias("c1"), F.col("p.c2").alias("c2"), F.col("q.c1").alias("d1"), F.col("q.c2").alias("d2")]
        settled = self._verified(side.where(self._may_match("p", "q")).select(*both), classes, docs)
        open_ = prefixes.join(settled, _CLASS, "left_anti")
        met = open_.alias("p").join(
            prefixes.alias("q"), (F.col("p.key") == F.col("q.key")) & self._may_match("p", "q")
        )
        rest = self._verified(met.select(*both), classes, docs)
        return settled.unionByName(rest)

    def removed_lines(self, docs: DataFrame) -> DataFrame:
        """(doc_id, removed): line numbers (from 0) that go, one row per document that loses any."""
        lines = materialise(self.lines(docs), "lines")
        place = F.struct("doc_id", "line")
        classes = materialise(
            lines.groupBy(*_CLASS)
            .agg(
                F.min(place).alias("at"), F.max("n").alias("n"), F.count("*").alias("members"),
                F.first("prefix").alias("prefix"), F.first("bits").alias("bits"),
            )
            .select(*_CLASS, "at.doc_id", "at.line", "n", "members", "prefix", "bits"),
            "line-classes",
        )
        near = self.similar(classes, docs).withColumn("near", F.lit(True))
        flagged = classes.select(*_CLASS, place.alias("first"), "members").join(near, _CLASS, "left")
        table = flagged.where((F.col("members") > 1) | F.col("near")).select(
            F.struct(*_CLASS).alias("class"), "first", F.coalesce("near", F.lit(False)).alias("near")
        )
        marked = lookup_join(
            lines.select("doc_id", "line", F.struct(*_CLASS).alias("class")),
            materialise(table, "line-repeats"),
            "class",
            spread_by="doc_id",
        )
        gone = F.col("near") | ~place.eqNullSafe(F.col("first"))
        return marked.where(gone).groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed"))

    def run(
        self, docs: DataFrame, text_col: str = "text", lines_col: str = "n_lines", removed_col: str = "n_removed"
    ) -> DataFrame:
        """Every row of ``docs`` with its text less the repeated lines, and both numbers of lines."""
        source = docs.select("doc_id", F.col(text_col).cast("string").alias("text")).where(
            F.col("doc_id").isNotNull()
        )
        removed = materialise(
            self.removed_lines(source).select(F.col("doc_id").alias("_removed_from"), F.col("removed").alias("_removed")),
            "removed-lines",
        )
        keep = docs.drop(lines_col, removed_col)
        out = lookup_join(keep.withColumn("_removed_from", F.col("doc_id")), removed, "_removed_from", "left")
        parts = F.split(text_col, "\n")
        breaks = F.octet_length(text_col) - F.octet_length(F.replace(F.col(text_col), F.lit("\n"), F.lit("")))
        # By a set of numbers, so that the work is linear in the lines of a text. The parts are the
        # field of an outer function's argument, or they would be cut anew for each line.
        kept = F.array_except(F.sequence(F.lit(0), breaks), "_removed")
        both = F.array(F.struct(parts.alias("parts"), kept.alias("kept")))
        joined = F.transform(both, lambda b: F.array_join(F.transform(b["kept"], lambda i: F.get(b["parts"], i)), "\n"))
        left = F.get(joined, F.lit(0))
        text = F.when(F.col("_removed").isNull(), F.col(text_col)).otherwise(left)
        return out.select(
            *[text.alias(c) if c == text_col else F.col(c) for c in keep.columns],
            F.coalesce(breaks + 1, F.lit(0)).alias(lines_col),
            F.coalesce(F.size("_removed"), F.lit(0)).alias(removed_col),
        )
