"""Toxicity by two Kneser-Ney bigram models, one of toxic and one of ordinary text.

Counts. From the labelled rows every word gets its continuation count per class: the
number of different words it follows there. That is Kneser-Ney's lower-order statistic,
and it is what makes a thousand copies of one document count once; for pairs, equal texts are counted once.

Smoothing. Class c discounts each count by ``discount * (share of c)``, so that a word as
frequent in one class as in the other keeps equal probabilities. What all classes take
off a word goes back to that word in both, by its pooled count: a rare expression is
judged by shared counts alone and speaks for neither side.

    P_c(w) = (max(n_c(w) - d_c, 0) / N_c + R(w) / N) / Z_c,   R(w) = sum_c min(n_c(w), d_c)

Words whose counts are all below the discount cancel in the comparison and need no entry.

Higher order. After a word v the count of each pair (v, w), one for every occurrence in a different
text, is discounted alike, and what is taken off goes to the words by the lower order:

    P_c(w | v) = (max(n_c(v, w) - d_c, 0) + B_c(v) P_c(w)) / n_c(v),   B_c(v) = sum_w min(n_c(v, w), d_c)

A class that never saw v backs off whole: P_c(w | v) = P_c(w). The discount of pairs is below one, so every
pair of the counted texts is above it. The log-ratio of an unseen pair is that of B_c(v) / n_c(v), a number
of the word before, plus that of w; seen pairs have an entry for what their own ratio adds to (or takes off)
these two, where that is DEPARTURE or more.
A text's evidence is thus a sum over its words, its words as contexts, and its pairs.

Ordinary words differ between the classes as far as these differ in languages and topics;
over a whole text such small ratios add up to more than a few marked expressions. So of a log-ratio
only what exceeds MARGIN (a factor of e either way) counts in full, the rest with the weight LEAK.
Discounts are the same for any corpus. A table of up to TABLE_WORDS entries is sent to the
executors; of a larger one only that many words and contexts, the most frequent, are, and the rest stays a
Spark table that the keys of the texts meet in ROUNDS rounds, as arrays.

Score. The log-likelihoods differ by ``sum log(P_toxic / P_ordinary)``; divided by the
number of words (and, for short texts, by its root) this enters a logistic curve that is
fitted on labelled rows which took no part in the counts, at most CALIBRATION_ROWS of them. So does the sum of
the lower order alone: most pairs are seen once, in the larger class, and summed up they drown the
marked words, so the curve weighs the two orders.

Rows: null or empty texts have no words and get the curve's value at zero evidence. A
null label is no label; of several labels of a document the highest counts. Without
labelled rows of both classes every score is 0. Other columns pass through; columns
named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelens.runtime import lookup_join, made_paths, materialise, release, shuffles_freed

DISCOUNT, PAIR_DISCOUNT = 20, 0.75
MARGIN, LEAK = 1.0, 0.001
DEPARTURE = 0.01
TABLE_WORDS = 1_048_576
CHUNK_WORDS = 500_000  # words that a task scores at a time
ROUNDS = 4  # shares of the keys that meet a large table one after the other; bounds the disk
PART_ENTRIES = 2_000_000  # entries of a large table that a task holds at a time
HELD_SUMS = 4_000_000  # sums that a task holds before it passes them on
CALIBRATION_ROWS = 20_000
_COUNTED = ("word", "before", "toxic", "ordinary", "n_toxic", "n_ordinary", "back_toxic", "back_ordinary")
WORD_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Hashes of the lower-case words of a text."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK)
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def _fold(doc_id: Column, parts: int) -> Column:
    """Part of a labelled row, independent of the last digits of its checksum."""
    return F.pmod(F.floor(F.crc32(doc_id.cast("string").cast("binary")) / 3), F.lit(parts))


def context_key(word: Column) -> Column:
    """Key of a word as the one before; ``_keys`` computes the same."""
    return F.xxhash64(word)


def pair_key(before: Column, word: Column) -> Column:
    return F.xxhash64(before, word)


def _before(words: Column) -> Column:
    """The word before each word; the beginning of a text counts as a word."""
    start = F.array(F.lit(0).cast("bigint"))
    return F.when(F.size(words) > 0, F.concat(start, F.slice(words, F.lit(1), F.size(words) - 1))).otherwise(words)


def _off(toxic: int, ordinary: int, discount: float) -> list[float]:
    """What is taken off the pair counts of the two classes, which hold so many words."""
    return [discount * n / max(toxic + ordinary, 1) for n in (toxic, ordinary)]


def continuation_counts(rows: DataFrame, pair_discount: float | None = None) -> DataFrame:
    """(word, before, toxic, ordinary, n_toxic, n_ordinary, back_toxic, back_ordinary), by class.

    Where ``before`` is null, the counts are the different words before ``word`` and the others
    are of ``word`` as a context: its pairs, and what the discount takes off them. Else the counts
    are those of a pair that is above the discount.

    ``rows`` has ``words`` and ``toxic``. Pairs are counted over all tasks before they are
    counted per word, so a frequent word is spread over its neighbours.
    """
    sizes = [F.sum(F.when(F.col("toxic") == c, F.size("words")).otherwise(0)).alias(x) for c, x in ((1, "t"), (0, "o"))]
    total = rows.agg(*sizes).first()
    off = _off(total["t"] or 0, total["o"] or 0, pair_discount or PAIR_DISCOUNT)
    pairs = F.explode(F.arrays_zip(F.col("words").alias("word"), _before(F.col("words")).alias("before")))
    counted = (
        rows.select(pairs.alias("p"), "toxic")
        .groupBy("p.word", "p.before")
        .agg(*[F.count(F.when(F.col("toxic") == c, 1)).alias(name) for c, name in ((1, "t"), (0, "o"))])
    )
    with shuffles_freed(rows.sparkSession):
        counted = materialise(counted, "toxicity-pairs")
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    seen = [F.when(F.col(c) > 0, 1).otherwise(0).cast("bigint") for c in "to"]
    back = [F.least(F.col(c).cast("double"), F.lit(d)) for c, d in zip("to", off)]
    empty = F.lit(0.0)

    def entry(*values: Column) -> Column:
        return F.struct(*[v.alias(c) for v, c in zip(values, _COUNTED)])

    entries = F.array(
        entry(F.col("word"), none, *seen, zero, zero, empty, empty),
        entry(F.col("before"), none, zero, zero, F.col("t"), F.col("o"), *back),
    )
    each = counted.select(F.explode(entries).alias("e")).select("e.*")
    single = each.groupBy("word").agg(none.alias("before"), *[F.sum(c).alias(c) for c in _COUNTED[2:]])
    with shuffles_freed(rows.sparkSession):
        single = materialise(single, "toxicity-words")
    above = counted.where((F.col("t") > off[0]) | (F.col("o") > off[1]))
    pair = entry(F.col("word"), F.col("before"), F.col("t"), F.col("o"), zero, zero, empty, empty)
    return single.unionByName(above.select(pair.alias("e")).select("e.*"))


def _shrunk(ratio: Column, margin: float) -> Column:
    beyond = F.greatest(F.abs(ratio) - F.lit(margin), F.lit(0.0)) * F.signum(ratio)
    within = F.least(F.abs(ratio), F.lit(margin)) * F.signum(ratio)
    return beyond + F.lit(LEAK if margin else 1.0) * within


def _totals(counts: DataFrame, discount: float) -> tuple[list[float], list[float]] | None:
    """Counts of all words of ``counts`` and the discounts, by class; None if a class has no words."""
    total = counts.agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")).first()
    n = [float(total["t"] or 0), float(total["o"] or 0)]
    return (n, [discount * x / sum(n) for x in n]) if all(n) else None


def _probabilities(counts: DataFrame, discount: float) -> tuple[list[Column], Column] | None:
    """(P of the toxic and of the ordinary class, above the discount?) of the words of ``counts``."""
    totals = _totals(counts, discount)
    if totals is None:
        return None
    n, d = totals
    classes = list(zip((F.col("toxic"), F.col("ordinary")), n, d))
    back = sum(F.least(c.cast("double"), F.lit(off)) for c, _, off in classes) / F.lit(sum(n))
    found = [F.greatest(c - F.lit(off), F.lit(0.0)) / F.lit(x) + back for c, x, off in classes]
    return found, (F.col("toxic") > F.lit(d[0])) | (F.col("ordinary") > F.lit(d[1]))


def _words_only(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("before").isNull()).drop("before") if "before" in counts.columns else counts


def _uses() -> Column:
    return (F.col("n_toxic") + F.col("n_ordinary")).alias("uses")


def ratio_table(
    counts: DataFrame, discount: float = DISCOUNT, margin: float = MARGIN, uses: bool = False
) -> DataFrame | None:
    """(word, ratio): log P_toxic / P_ordinary, shrunk by ``margin``, of the words above the
    discount; None if a class has no words. ``uses`` adds how often a word stands before another."""
    counts = _words_only(counts)
    found = _probabilities(counts, discount)
    if found is None:
        return None
    (toxic, ordinary), above = found
    ratio = _shrunk(F.log(toxic) - F.log(ordinary), margin).alias("ratio")
    return counts.where(above).select("word", ratio, *([_uses()] if uses else []))


def higher_order(
    counts: DataFrame,
    discount: float = DISCOUNT,
    margin: float = MARGIN,
    pair_discount: float | None = None,
    uses: bool = False,
) -> DataFrame | None:
    """(word, ratio) of ``continuation_counts`` for contexts and pairs, under their keys. ``uses`` adds how often
    a context is one, null for pairs."""
    words = _words_only(counts)
    n = words.agg(F.sum("n_toxic").alias("t"), F.sum("n_ordinary").alias("o")).first()
    off = _off(n["t"] or 0, n["o"] or 0, pair_discount or PAIR_DISCOUNT)
    totals = _totals(words, discount)
    if totals is None:
        return None
    names = ("toxic", "ordinary")
    kept = [F.when(F.col(f"n_{c}") > 0, F.col(f"back_{c}") / F.col(f"n_{c}")).otherwise(1.0) for c in names]
    context = _shrunk(F.log(kept[0]) - F.log(kept[1]), margin)
    backed = F.lit(False)
    for c in names:
        backed = backed | (F.col(f"n_{c}") > F.col(f"back_{c}") + 1e-9)
    number = [_uses()] if uses else []
    contexts = words.where(backed).select(context_key(F.col("word")).alias("word"), context.alias("ratio"), *number)
    pairs = counts.where(F.col("before").isNotNull()).select("word", "before", F.col("toxic").alias("t"), F.col("ordinary").alias("o"))
    met = lookup_join(pairs, words.select("word", *names), "word", spread_by="before")
    met = lookup_join(met, words.select(F.col("word").alias("before"), *_COUNTED[4:]), "before", spread_by="word")
    own = met.mapInArrow(_pair_ratios(*totals, off, margin), "word bigint, ratio double")
    if uses:
        own = own.withColumn("uses", F.lit(None).cast("bigint"))
    return contexts.unionByName(own)


def _pair_ratios(n: list[float], d: list[float], off: list[float], margin: float):
    """Pairs with the counts of their words to what the ratio of each adds to the lower order's, by key."""

    def shrunk(ratio: np.ndarray) -> np.ndarray:
        within = np.clip(ratio, -margin, margin)
        return ratio - within + (LEAK if margin else 1.0) * within

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            words = [of["toxic"].astype(float), of["ordinary"].astype(float)]
            pairs, seen, back = [of["t"], of["o"]], [of["n_toxic"], of["n_ordinary"]], [of["back_toxic"], of["back_ordinary"]]
            shared = sum(np.minimum(w, x) for w, x in zip(words, d)) / sum(n)
            p = [np.maximum(w - x, 0) / total + shared for w, x, total in zip(words, d, n)]
            above = (words[0] > d[0]) | (words[1] > d[1])
            kept = [np.where(m > 0, b / np.maximum(m, 1), 1.0) for b, m in zip(back, seen)]
            lower = np.where(above, shrunk(np.log(p[0]) - np.log(p[1])), 0.0) + shrunk(np.log(kept[0]) - np.log(kept[1]))
            after = [np.maximum(k - x, 0) / np.maximum(m, 1) + r * q for k, x, m, r, q in zip(pairs, off, seen, kept, p)]
            more = shrunk(np.log(after[0]) - np.log(after[1])) - lower
            own = np.abs(more) >= DEPARTURE
            before = _xxhash(of["before"][own].view(np.uint64), np.uint64(42))
            keys = _xxhash(of["word"][own].view(np.uint64), before).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(more[own])], names=["word", "ratio"])

    return rows


def joined_evidence(
    df: DataFrame,
    words_col: str,
    table: DataFrame,
    head: tuple[np.ndarray, np.ndarray] | None = None,
    whole_head: bool = False,
    rounds: int | None = None,
) -> DataFrame:
    """Adds ``_evidence`` as ``evidence`` would; ``table`` is met by the keys of words, contexts and pairs.

    ``head`` holds words and contexts that are not in ``table``, all there are if it is whole.
    Tasks sort the keys of their texts into parts of the table, as arrays, and one task per part adds up what
    each text finds there. Rows with equal words have equal evidence, so texts are known by two hashes of
    their words. Counts of copies add up alike for all words, and the mean over the words cancels them.
    """
    spark, parts = df.sparkSession, ["_k1", "_k2"]
    rounds = rounds or ROUNDS
    width = max(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // rounds), -(-table.count() // (rounds * PART_ENTRIES)))
    keyed = df.withColumn("_k1", F.xxhash64(words_col)).withColumn("_k2", F.xxhash64(F.lit(17), words_col))
    texts = keyed.select(*parts, F.col(words_col).alias("words"))
    first = len(made_paths())
    sums = []
    with shuffles_freed(spark):
        for turn in range(rounds):
            asked = texts.mapInArrow(_asking(head, whole_head, rounds, turn, width), _MET)
            known = table.where(F.pmod("word", F.lit(rounds)) == turn).mapInArrow(_known(rounds, width), _MET)
            met = known.unionByName(asked).repartition(width, "part").sortWithinPartitions("part", "kind")
            found = met.mapInArrow(_answered, _FOUND).groupBy("chunk").applyInArrow(_summed, _SUMS)
            sums.append(materialise(found, "toxicity-sums"))
        each = sums[0]
        for more in sums[1:]:
            each = each.unionByName(more)
        mean = [(F.sum(c) * rounds / F.sum("n")).alias(f"_{c}") for c in ("total", "lower")]
        means = materialise(each.groupBy(*parts).agg(*mean), "toxicity-evidence")
    release(spark, made_paths()[first : first + rounds])
    whole = [f.name for f in df.schema.fields if f.name != words_col and "map<" not in f.dataType.simpleString()]
    salted = keyed.withColumn("_row", F.xxhash64(*[F.col(f"`{c}`") for c in whole]))
    n = F.size(words_col).cast("bigint")
    total, lower = (F.coalesce(F.col(c) * n, F.lit(0.0)) for c in ("_total", "_lower"))
    return (
        lookup_join(salted, means, parts, "left", spread_by="_row")
        .withColumn("_evidence", F.struct(total.alias("total"), lower.alias("lower"), n.alias("n")))
        .select(*[F.col(f"`{c}`") for c in df.columns], "_evidence")
    )


# Rows of a part of the table, in this order: entries; pairs and contexts of a chunk of texts; its words; the
# texts of a chunk. ``owners`` says whose keys they are (steps from text to text), or holds values.
_ENTRY, _ASKED, _WORDS, _TEXTS = range(4)
_MET = "part int, kind int, chunk bigint, size int, keys binary, owners binary"
_FOUND = "chunk bigint, size int, keys binary, owners binary"
_SUMS = "_k1 bigint, _k2 bigint, total double, lower double, n bigint"


def _rows(rows: list[tuple], columns: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in columns.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[f for f, _ in fields]
    )


def _dealt(keys: np.ndarray, rounds: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its keys)."""
    part = (keys // rounds % width).astype(np.uint16 if width < 65536 else np.int64)
    order = np.argsort(part, kind="stable")
    ends = np.flatnonzero(np.diff(part[order])) + 1
    for places in np.split(order, ends) if len(order) else []:
        yield int(part[places[0]]), places


def _known(rounds: int, width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ratios = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("word", "ratio"))
            dealt = _dealt(keys, rounds, width)
            yield _rows([(p, _ENTRY, 0, len(at), keys[at].tobytes(), ratios[at].tobytes()) for p, at in dealt], _MET)

    return rows


def _asking(head: tuple[np.ndarray, np.ndarray] | None, whole_head: bool, rounds: int, turn: int, width: int):
    """Texts to the keys that this turn looks up, less those that ``head`` holds, which are added up here."""

    def ask(flat: np.ndarray, lengths: np.ndarray, texts: np.ndarray, chunk: int) -> list[tuple]:
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        sums, rows, open_keys = np.zeros((2, len(lengths))), [], {_ASKED: [], _WORDS: []}
        starts = np.cumsum(lengths) - lengths
        for i, keys in enumerate(_keys(flat, starts)):
            mine = keys % rounds == turn
            if i < 2 and head is not None and len(head[0]):
                values, held = _looked_up(keys[mine], *head)
                sums[: 2 - i] += np.bincount(owner[mine], values, len(lengths))
                mine[mine] = ~held
            if i == 2 or not whole_head:
                open_keys[_WORDS if i == 0 else _ASKED].append((keys[mine], owner[mine]))
        for kind, found in open_keys.items():
            if found:
                keys, whose = (np.concatenate(x) for x in zip(*found))
                for part, at in _dealt(keys, rounds, width):
                    steps = np.diff(whose[at], prepend=np.int32(0))
                    rows.append((part, kind, chunk, len(lengths), keys[at].tobytes(), steps.tobytes()))
        own = np.concatenate([sums.ravel(), lengths.astype(float)])
        return [*rows, (chunk % width, _TEXTS, chunk, len(lengths), texts.tobytes(), own.tobytes())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            lists = batch.column("words")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False)
            full = np.diff(offsets) > 0
            texts = np.stack([batch.column(c).to_numpy(zero_copy_only=False)[full] for c in ("_k1", "_k2")])
            offsets = np.append(offsets[:-1][full], offsets[-1])
            for at, stop in _chunks(offsets):
                piece = flat[offsets[at] : offsets[stop]]
                yield _rows(ask(piece, np.diff(offsets[at : stop + 1]), texts[:, at:stop], chunk), _MET)
                chunk += 1

    return rows


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of parts, each in the order of kinds: sums of every chunk, of all words and of the lower order."""
    part, entries, table, sums, held = None, [], None, {}, 0

    def passed() -> pa.RecordBatch:
        return _rows([(c, x.shape[1], None, x.tobytes()) for c, x in sums.items()], _FOUND)

    for batch in batches:
        for i in range(batch.num_rows):
            at, kind, chunk, size = (batch.column(k)[i].as_py() for k in range(4))
            keys, owners = (batch.column(k)[i].as_buffer() for k in (4, 5))
            if at != part:
                part, entries, table = at, [], None
            if kind == _ENTRY:
                entries.append((np.frombuffer(keys, np.int64), np.frombuffer(owners, float)))
                continue
            if kind == _TEXTS:
                yield _rows([(chunk, size, keys.to_pybytes(), owners.to_pybytes())], _FOUND)
                continue
            if table is None and entries:
                hashes, ratios = (np.concatenate(x) for x in zip(*entries))
                order = np.argsort(hashes)
                table, entries = (hashes[order], ratios[order]), []
            if table is None:
                continue
            values, _ = _looked_up(np.frombuffer(keys, np.int64), *table)
            found = np.bincount(np.cumsum(np.frombuffer(owners, np.int32)), values, size)
            if chunk not in sums:
                sums[chunk] = np.zeros((2, size))
                held += size
            sums[chunk][: 2 if kind == _WORDS else 1] += found
            if held > HELD_SUMS:
                yield passed()
                sums, held = {}, 0
    if sums:
        yield passed()


def _summed(found: pa.Table) -> pa.Table:
    """Sums of a chunk, from all parts, to its texts."""
    total, texts = 0.0, None
    for keys, values in zip(found.column("keys").to_pylist(), found.column("owners").to_pylist()):
        if keys is not None:
            texts = np.frombuffer(keys, np.int64).reshape(2, -1)
            *own, n = np.frombuffer(values, float).reshape(3, -1)
            total = total + np.stack(own)
        else:
            total = total + np.frombuffer(values, float).reshape(2, -1)
    columns = [*texts, *total, n.astype(np.int64)]
    return pa.table([pa.array(c) for c in columns], names=[c.split()[0] for c in _SUMS.split(", ")])


def _looked_up(keys: np.ndarray, hashes: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ratio or 0, found?) of each key, from entries in the order of their hashes."""
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    held = hashes[at] == keys
    return np.where(held, ratios[at], 0.0), held


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Texts from and to, some CHUNK_WORDS words at a time."""
    at = 0
    while at < len(offsets) - 1:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_WORDS, side="right")) - 1)
        yield at, stop
        at = stop


def _xxhash(value: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    """Spark's xxhash64 of 64-bit numbers."""
    turn = lambda x, k: x << np.uint64(k) | x >> np.uint64(64 - k)
    h = seed + np.uint64(0x27D4EB2F165667C5 + 8)
    h = h ^ turn(value * np.uint64(0xC2B2AE3D27D4EB4F), 31) * np.uint64(0x9E3779B185EBCA87)
    h = turn(h, 27) * np.uint64(0x9E3779B185EBCA87) + np.uint64(0x85EBCA77C2B2AE63)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
    return h ^ h >> np.uint64(32)


def _keys(words: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Words, keys of the word before each and of the pairs; ``starts``: the first word of each text."""
    before = np.zeros(len(words), np.int64)
    before[1:] = words[:-1]
    before[starts] = 0
    context = _xxhash(before.view(np.uint64), np.uint64(42))
    return [words, context.view(np.int64), _xxhash(words.view(np.uint64), context).view(np.int64)]


def evidence(hashes: np.ndarray, ratios: np.ndarray):
    """Column function: (sum of log ratios, that of the lower order, number of words) of an array of word hashes."""

    def sums_of(flat: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        if not len(hashes) or not len(flat):
            return [np.zeros(len(offsets) - 1)] * 2
        starts = offsets[:-1][np.diff(offsets) > 0]
        words, *higher = (_looked_up(keys, hashes, ratios)[0] for keys in _keys(flat, starts))
        out = []
        for found in (words + sum(higher), words):
            sums = np.zeros(len(flat) + 1)
            np.cumsum(found, out=sums[1:])
            out.append(sums[offsets[1:]] - sums[offsets[:-1]])
        return out

    @F.arrow_udf("struct<total double, lower double, n bigint>")
    def score(batch: pa.Array) -> pa.Array:
        offsets = batch.offsets.to_numpy().astype(np.int64)
        flat = batch.values.to_numpy(zero_copy_only=False)
        sums = np.zeros((2, len(batch)))
        for at, stop in _chunks(offsets):
            part = offsets[at : stop + 1]
            sums[:, at:stop] = sums_of(flat[part[0] : part[-1]], part - part[0])
        columns = [*sums, np.diff(offsets)]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["total", "lower", "n"])

    return score


def _inputs(total, lower, n):
    """What the logistic curve sees, of both orders; all of it normalised by length."""
    n = np.maximum(n, 1.0)
    each = [x for s in (total, lower) for x in (s / n, s / np.sqrt(n))]
    return np.stack([*each, 1 / np.sqrt(n), np.ones_like(n)], 1)


def _fit_curve(rows: pd.DataFrame) -> list[float]:
    """Logistic regression by Newton's steps, with a small ridge."""
    x, y = _inputs(*(rows[c].to_numpy(float) for c in ("total", "lower", "n"))), rows["toxic"].to_numpy(float)
    scale = np.maximum(x.std(0), 1e-9)
    scale[-1] = 1.0
    x, b = x / scale, np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(len(b)), x.T @ (y - p) - 1e-3 * b
        )
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in b / scale]


@dataclass(frozen=True)
class ToxicityModel:
    """Table of words, contexts and pairs, and curve; ``curve`` is empty if there was nothing to learn
    from. Of more than TABLE_WORDS entries the arrays hold words and contexts only, ``table`` (word, ratio) the
    rest; ``whole_head``: the arrays hold all words and contexts."""

    hashes: np.ndarray
    ratios: np.ndarray
    curve: tuple[float, ...]
    table: DataFrame | None = None
    whole_head: bool = False

    def with_evidence(self, df: DataFrame, words_col: str, rounds: int | None = None) -> DataFrame:
        if self.table is not None:
            return joined_evidence(df, words_col, self.table, (self.hashes, self.ratios), self.whole_head, rounds)
        return df.withColumn("_evidence", evidence(self.hashes, self.ratios)(words_col))

    def score(
        self, df: DataFrame, text_col: str = "text", score_col: str = "score", ratio_col: str = "log_ratio"
    ) -> DataFrame:
        """Adds ``score`` (0 to 1) and ``log_ratio`` (per word, toxic minus ordinary)."""
        found = self.with_evidence(df.withColumn("_words", words(F.col(text_col))), "_words").drop("_words")
        total, lower, n = F.col("_evidence.total"), F.col("_evidence.lower"), F.greatest(F.col("_evidence.n"), F.lit(1))
        if self.curve:
            a, b, c, d, e, f = self.curve
            z = a * total / n + b * total / F.sqrt(n) + c * lower / n + d * lower / F.sqrt(n) + e / F.sqrt(n) + f
            value = 1 / (1 + F.exp(-z))
        else:
            value = F.lit(0.0)
        return found.withColumn(score_col, value).withColumn(ratio_col, total / n).drop("_evidence")


def _arrays(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    found = table.select("word", "ratio").toArrow()
    hashes, ratios = found["word"].to_numpy(), found["ratio"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], ratios[order]


def _least_uses(table: DataFrame) -> int:
    """The words and contexts with as many uses or more are TABLE_WORDS at most."""
    counts = table.where(F.col("uses").isNotNull()).groupBy("uses").count().toArrow().to_pandas().sort_values("uses", ascending=False)
    fit = counts["uses"][(counts["count"].cumsum() <= TABLE_WORDS).to_numpy()]
    return int(fit.min()) if len(fit) else np.iinfo(np.int64).max


def train(docs: DataFrame, labels: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> ToxicityModel:
    """``docs``: doc_id, text. ``labels``: doc_id, toxic (0/1), only rows one may learn from.

    Labels are broadcast within a measured bound; beyond it both sides shuffle by document.
    Equal texts of one class are counted once. A quarter of the labelled rows, or the share that gives some ``calibration_rows`` if that is
    less, is kept out of the counts to fit the curve.
    """
    marks = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    found = lookup_join(docs.select("doc_id", F.col("text").cast("string").alias("text")), marks, "doc_id")
    rows = found.select("doc_id", "toxic", words(F.col("text")).alias("words"))
    part = _fold(F.col("doc_id"), max(4, found.count() // max(calibration_rows, 1)))
    texts = found.where(part != 0).groupBy(F.xxhash64("text"), "toxic").agg(F.min("doc_id").alias("doc_id"))
    once = materialise(texts.select("doc_id").distinct(), "toxicity-texts")
    counted = lookup_join(rows, once, "doc_id", "left_semi")
    made = len(made_paths())
    counts = continuation_counts(counted)
    made = made_paths()[made:]
    table = ratio_table(counts, uses=True)
    size = 0
    if table is not None:
        with shuffles_freed(docs.sparkSession):
            table = materialise(table.unionByName(higher_order(counts, uses=True)), "toxicity-ratios")
        size = table.count()
    release(docs.sparkSession, made)
    if not size:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), ())
    if size > TABLE_WORDS:
        least = _least_uses(table)
        sent = F.coalesce(F.col("uses") >= least, F.lit(False))
        rest = table.where(~sent)
        whole = rest.where(F.col("uses").isNotNull()).isEmpty()
        model = ToxicityModel(*_arrays(table.where(sent)), (), rest.select("word", "ratio"), whole)
    else:
        model = ToxicityModel(*_arrays(table), ())
    fitted = (
        model.with_evidence(rows.where(part == 0).select("doc_id", "toxic", "words"), "words", rounds=1)
        .select("toxic", "_evidence.total", "_evidence.lower", "_evidence.n", F.xxhash64("doc_id").alias("k"))
        .orderBy("k", "total", "lower", "n", "toxic")
        .limit(calibration_rows)
        .toPandas()
    )
    if fitted["toxic"].nunique() < 2:
        return model
    return replace(model, curve=tuple(_fit_curve(fitted)))


def read_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents, and the labels of rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return docs, labels.where(~held_out(F.col("doc_id")))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1
