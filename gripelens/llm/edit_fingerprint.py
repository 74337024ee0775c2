"""Fingerprints by a randomised edit embedding: edit distance becomes Hamming distance.

Embedding. A walk reads a text from its first code point. Step j emits the code point it stands on
and moves on if a random bit, shared by all texts and looked up by (j, code point), says so. Two
walks that meet at equal remainders emit the same from there on; after an edit they drift until
chance brings them together again, so few edits change few emitted symbols. Walks start anew
every SEGMENT code points (a remainder below half a segment joins the segment before), which keeps
steps few and lets a task walk all segments of many texts in step with each other. WALKS walks
with bits of their own go over each segment, as a single one may drift for long.

Fingerprint. Each walk has its bins, SAMPLES in all; every step belongs to one bin and has a rank in
it. A bin takes one of the segments that reach it, by a random rank divided by the segment's
length, and there its first-ranked step that the walk reached; which steps these are depends
on lengths alone, so texts are sampled alike. Four bits of a hash of (place, symbol) are kept, one
hexadecimal digit for each bin. Bins without a step, in short texts, copy the digit of
another bin in a fixed order. A text without code points has the empty fingerprint.

Likeness of two fingerprints is the share of equal digits, less what chance gives (1 of 16): an
estimate of the share of the embedding that is equal. Equal texts have equal fingerprints.

Search (``near_first``), exact. Fingerprints of likeness 0.8 differ in 24 digits at most, so in one of 13
bands they differ in at most one: classes of equal fingerprints meet on every band less one
of its digits, and what meets is verified on all digits. Of those near a document the one with
the smallest id is wanted, so a class first meets the first class of each key; only where that leaves
a smaller one possible does it meet others. Copies are one class before.

Rows: null texts count as empty. Very long texts are walked whole, segments side by side. Repeated
rows give equal results; columns named like the output are replaced, others pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gripelens.llm.byte_bpe import slices
from gripelens.llm.shingles import mix
from gripelens.runtime import lookup_join, materialise, shuffles_freed

SEGMENT = 4096
STEPS = 4 * SEGMENT  # a walk of 1.5 segments ends long before: one step in two moves on
SAMPLES, WALKS = 128, 4
BINS = SAMPLES // WALKS
ROUNDS = 4  # in which the keys of the search are dealt, so that a shuffle holds some of them only
BLOCK = 512  # classes of a key that a task compares with the others
THIN = (256, 16, 1)  # one in so many of a key's classes is looked at first
CHUNK = 4_000_000  # code points that a task walks at a time
_U = np.uint64
_LAST = _U(0xFFFFFFFFFFFFFFFF)
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)
_WORDS = [f"w{k}" for k in range(SAMPLES // 16)]


@lru_cache(maxsize=1)
def _shared() -> tuple[np.ndarray, np.ndarray]:
    """(class of every code point, 1 to 255; the bit of every step by walk and class). Class 0 ends a
    segment."""
    points = np.arange(0x110000, dtype=_U)
    classes = (mix(points + _U(0x51ED270B)) % _U(255)).astype(np.uint8) + np.uint8(1)
    bits = (mix(np.arange(STEPS * WALKS * 256, dtype=_U) + _U(0xC2B2AE3D27D4EB4F)) >> _U(63)).astype(np.uint8)
    bits = bits.reshape(STEPS, WALKS * 256)
    bits[:, ::256] = 0
    return classes, bits


@lru_cache(maxsize=1)
def _samples() -> tuple[np.ndarray, np.ndarray]:
    """(steps by bin and then in order, first of each bin): those that rank before all earlier ones
    of their bin. The last of them that a walk reached is the bin's first-ranked step. The bins of
    a walk share its steps between them."""
    kept, firsts = [], []
    for walk in range(WALKS):
        h = mix(np.arange(STEPS, dtype=_U) * _U(0x9FB21C651E98DF25) + _U(7 + walk))
        for b in range(BINS):
            own = np.flatnonzero(h % _U(BINS) == b)
            best = np.minimum.accumulate(h[own] >> _U(8))
            firsts.append(sum(map(len, kept)))
            kept.append(own[np.concatenate([[True], best[1:] < best[:-1]])])
    return np.concatenate(kept), np.array(firsts)


@lru_cache(maxsize=1)
def _donors() -> np.ndarray:
    """For each bin the other bins in the order in which it asks them for a digit."""
    key = mix(np.arange(SAMPLES * SAMPLES, dtype=_U) + _U(99)).reshape(SAMPLES, SAMPLES)
    return np.argsort(key, axis=1)


def _segments(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number within the text, length) of every segment."""
    counts = np.maximum((lengths + SEGMENT // 2) // SEGMENT, (lengths > 0).astype(np.int64))
    text = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    size = np.where(number == counts[text] - 1, lengths[text] - number * SEGMENT, SEGMENT)
    return text, number, size


def _walked(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(sampled step, segment): what the walks over the segments (end to end in ``symbols``) emit
    there, 0 beyond the segment's end."""
    _, bits = _shared()
    steps, firsts = _samples()
    walk_of = (np.searchsorted(firsts, np.arange(len(steps)), side="right") - 1) // BINS
    wanted: dict[int, list[tuple[int, int]]] = {}
    for row, (j, walk) in enumerate(zip(steps.tolist(), walk_of.tolist())):
        wanted.setdefault(j, []).append((row, walk))
    ends = np.cumsum(sizes) + np.arange(len(sizes))
    tape = np.zeros(len(symbols) + len(sizes), np.uint8)
    inside = np.ones(len(tape), bool)
    inside[ends] = False
    tape[inside] = symbols
    out = np.zeros((len(steps), len(sizes)), np.uint8)
    segment, at = np.tile(np.arange(len(sizes)), WALKS), np.tile(ends - sizes, WALKS)
    table = np.repeat(np.arange(WALKS) * 256, len(sizes))
    parts = np.arange(WALKS + 1) * len(sizes)
    for j in range(STEPS):
        now = tape.take(at)
        for row, walk in wanted.get(j, ()):
            a, b = parts[walk], parts[walk + 1]
            out[row, segment[a:b]] = now[a:b]
        at += bits[j].take(table + now)
        if j % 64 == 63:
            going = now != 0
            if not going.all():
                segment, at, table = segment[going], at[going], table[going]
                parts = np.searchsorted(table, np.arange(WALKS + 1) * 256)
                if not len(at):
                    break
    return out


def _digits(out: np.ndarray, text: np.ndarray, number: np.ndarray, size: np.ndarray, texts: int) -> np.ndarray:
    """(text, bin) digits from the sampled symbols of the texts' segments; every text has some."""
    steps, firsts = _samples()
    reached = np.where(out != 0, np.arange(len(steps), dtype=np.int32)[:, None], -1)
    best = np.maximum.reduceat(reached, firsts, axis=0)  # bin, segment
    symbol = np.take_along_axis(out, np.maximum(best, 0), axis=0).astype(_U)
    bins = np.arange(SAMPLES, dtype=_U)[:, None]
    place = steps[np.maximum(best, 0)].astype(_U) + (number.astype(_U) << _U(32))[None, :]
    digit = mix(mix(mix(place) + bins) + symbol) >> _U(60)
    chance = (mix((number.astype(_U) << _U(16))[None, :] + bins + _U(1)) >> _U(11)).astype(float) + 0.5
    rank = -np.log(chance / 2.0**53) / size[None, :]  # positive, so its bits order as it does
    code = np.where(best >= 0, (rank.view(_U) & ~_U(15)) | digit, _LAST)
    first = np.searchsorted(text, np.arange(texts))
    least = np.minimum.reduceat(code, first, axis=1).T
    digits, empty = (least & _U(15)).astype(np.uint8), least == _LAST
    short = np.flatnonzero(empty.any(1))
    held, missing = empty[short], empty[short].copy()
    given = digits[short].copy()
    for donor in _donors().T:
        if not missing.any():
            break
        use = missing & ~held[:, donor]
        given[use] = digits[short][:, donor][use]
        missing &= ~use
    digits[short] = given
    return digits


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprints of texts, walked together."""
    lengths = np.array([len(t) for t in texts], np.int64)
    full = np.flatnonzero(lengths)
    out = [""] * len(texts)
    if len(full):
        classes, _ = _shared()
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        text, number, size = _segments(lengths[full])
        digits = _digits(_walked(classes.take(points), size), text, number, size, len(full))
        for i, row in zip(full.tolist(), _DIGITS[digits]):
            out[i] = row.tobytes().decode()
    return out


def fingerprint(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of every text."""
    keep = [f for f in df.schema.fields if f.name != out_col]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, CHUNK):
            made = pa.array(fingerprints([t or "" for t in batch.column(text_col).to_pylist()]), pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], made], [*names, out_col])

    return df.mapInArrow(run, T.StructType([*keep, T.StructField(out_col, T.StringType(), False)]))


@F.arrow_udf(T.DoubleType())
def likeness(a: pa.Array, b: pa.Array) -> pa.Array:
    """Likeness (0 to 1) of two fingerprints; 1 if both are empty, 0 if one is."""
    out = np.zeros(len(a))
    pairs = [(i, x, y) for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist()))]
    whole = [p for p in pairs if p[1] and p[2]]
    if whole:
        x, y = (np.frombuffer("".join(p[k] for p in whole).encode(), np.uint8).reshape(-1, SAMPLES) for k in (1, 2))
        out[[p[0] for p in whole]] = np.maximum((x == y).mean(1) * 16 / 15 - 1 / 15, 0)
    out[[i for i, x, y in pairs if not x and not y]] = 1.0
    return pa.array(out)


def edited(text: Column, other: Column) -> Column:
    """The text, its last third replaced by as many first code points of the other text (or all)."""
    k = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - k), F.substring(other, F.lit(1), k))


_TEXTS = ("text", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint")
_BESIDE = "kind string, part int, doc_id bigint, n_chars bigint, " + ", ".join(f"{c} string" for c in _TEXTS)
_NAMES = ["kind", "part", "doc_id", "n_chars", *_TEXTS]


def beside_next(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint).

    The next document is the one after by descending doc_id (null last; rows with equal ids by
    a hash of the text); after the last comes the first. One range sort moves the texts; a task
    walks its rows in order and needs the next row only. The last row of a task finds the
    first of the next one in a join of one row for each task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    keys = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last: tuple | None = None

        def batch_of(kind: str, made: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*[(kind, part, *m) for m in made]))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), *[pa.string()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)

        for batch in slices(batches, "text", CHUNK // 2):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            before = [last[1]] if last else []
            ordered = before + texts
            changed = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(ordered, ordered[1:])]
            prints = fingerprints(texts + changed)
            own, theirs = ([last[2]] if last else []) + prints[: len(texts)], prints[len(texts) :]
            if not last:
                yield batch_of("first", [(ids[0], len(texts[0]), texts[0], None, own[0], None, None)])
            ids = ([last[0]] if last else []) + ids
            done = [
                (i, len(t), None, c, f, e, n)
                for i, t, c, f, e, n in zip(ids, ordered, changed, own, theirs, own[1:])
            ]
            if done:
                yield batch_of("row", done)
            last = (ids[-1], ordered[-1], own[-1])
        if last:
            yield batch_of("last", [(last[0], len(last[1]), last[1], None, last[2], None, None)])

    made = dealt.mapInArrow(run, _BESIDE).withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    with shuffles_freed(made.sparkSession):
        made = materialise(made, "beside-next")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
    inner = made.where("kind = 'row'").select(*columns)
    firsts = made.where("kind = 'first'").select(
        F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    # one row for each task that had rows
    order = [r["after"] for r in firsts.select("after").orderBy("after").collect()]
    steps = made.sparkSession.createDataFrame(list(zip(order, order[1:] + order[:1])), "part int, after int")
    edge = (
        made.where("kind = 'last'")
        .select("part", "doc_id", "n_chars", "text", "fingerprint")
        .join(steps, "part")
        .join(firsts, "after")
        .withColumn("edited", edited(F.col("text"), F.col("next_text")))
    )
    edge = fingerprint(edge.drop("text", "next_text"), "edited", "edited_fingerprint")
    return inner.unionByName(edge.withColumn("edited_sha256", F.sha2("edited", 256)).select(*columns))


def _apart(at_least: float) -> int:
    """Digits in which fingerprints of this likeness or more may differ."""
    return int(np.floor(SAMPLES * 15 / 16 * (1 - at_least) + 1e-9))


def _keys(apart: int) -> list[Column]:
    """For every digit a hash of its band without it, and of its place."""
    edges = [round(k * SAMPLES / (apart // 2 + 1)) for k in range(apart // 2 + 2)]
    keys = []
    for a, b in zip(edges, edges[1:]):
        for j in range(a, b):
            rest = [F.substring("fingerprint", a + 1, j - a), F.substring("fingerprint", j + 2, b - j - 1)]
            keys.append(F.xxhash64(F.lit(j), *rest))
    return keys


def _met(named: DataFrame, keys: list[Column]) -> DataFrame:
    """(key, fp, doc_id, first, size): the classes (fp, doc_id) of every key that several share, the
    first of them and their number."""
    shared = named.select("fp", "doc_id", F.explode(F.array(*keys)).alias("key"))
    groups = shared.groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("most"), F.count("*").alias("size")
    )
    with shuffles_freed(named.sparkSession):
        groups = materialise(groups.where("first < most").drop("most"), "print-groups")
        return materialise(lookup_join(shared, groups, "key", spread_by="fp"), "print-met")


def _words(fingerprint: str) -> list[Column]:
    """The digits as numbers, sixteen in each."""
    return [F.conv(F.substring(fingerprint, 16 * k + 1, 16), 16, -10).cast("bigint").alias(w) for k, w in enumerate(_WORDS)]


def _alike(a: str, b: str, apart: int) -> Column:
    """Whether the digits of two sides of a join differ in ``apart`` places at most; half of them are
    compared first."""
    counts = []
    for w in _WORDS:
        x = F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        counts.append(F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111))))
    half = len(counts) // 2
    return (reduce(Column.__add__, counts[:half]) <= apart) & (reduce(Column.__add__, counts) <= apart)


def near_first(prints: DataFrame, at_least: float = 0.8) -> DataFrame:
    """(fingerprint, doc_id, n_docs, near_id) for each different fingerprint of (doc_id, fingerprint).

    ``doc_id`` is the smallest of the ``n_docs`` documents with this fingerprint, ``near_id`` the
    smallest of these and of all documents whose fingerprints have the likeness ``at_least`` (above 0) to it.
    Most keys hold one class; the others are looked up without moving the rest. Keys are of their digit
    alone, so they are dealt in ROUNDS, whose shuffles are gone before the next. Where the first
    class of a key is not near, those after it that could still be the smallest are compared as well,
    BLOCK of them in a task: of large keys a share first (THIN), so that in a crowd of documents near one
    another little is left below the smallest found. Digits are compared inside the join, which makes
    rows of near classes only.
    """
    own = prints.where((F.col("fingerprint") != "") & F.col("doc_id").isNotNull())
    classes = materialise(own.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_docs")), "print-classes")
    named = classes.select(F.xxhash64("fingerprint").alias("fp"), "fingerprint", "doc_id")
    apart = _apart(at_least)
    keys = _keys(apart)
    met = reduce(DataFrame.unionByName, [_met(named, keys[k::ROUNDS]) for k in range(min(ROUNDS, len(keys)))])
    early = _verified(met.where("first < doc_id").select("fp", F.col("first").alias("other")), named, apart)
    best = materialise(early, "print-early")
    digits = named.select("fp", *_words("fingerprint"))
    known = met.join(best, "fp", "left").where(F.col("first") < F.coalesce("near", "doc_id"))
    unsure = materialise(known.join(digits, "fp").drop("near"), "print-open")
    there = met.join(unsure.select("key").distinct(), "key", "left_semi").where("first < doc_id").join(digits, "fp")
    there = materialise(there.withColumn("lot", F.pmod(F.xxhash64("doc_id"), 1 << 30).cast("int")), "print-there")
    for thin in THIN:
        late = materialise(_later(unsure.where(F.col("size") >= thin), there, best, thin, apart), "print-late")
        both = best.unionByName(late).groupBy("fp").agg(F.min("near").alias("near"))
        best = materialise(both, "print-best")
    return classes.withColumn("fp", F.xxhash64("fingerprint")).join(best, "fp", "left").select(
        "fingerprint", "doc_id", "n_docs", F.least("doc_id", F.coalesce("near", "doc_id")).alias("near_id")
    )


def _later(unsure: DataFrame, there: DataFrame, best: DataFrame, thin: int, apart: int) -> DataFrame:
    """(fp, near): the smallest near class that the classes ``unsure`` meet among one in ``thin`` of the
    classes ``there``, if it comes before the best one known."""
    blocks = F.ceil(F.col("size") / (BLOCK * thin)).cast("int")
    asked = unsure.join(best, "fp", "left").withColumn("upto", F.coalesce("near", "doc_id")).where("first < upto")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    lot = F.col("lot")
    met = there.where((lot % thin == 0) & (F.col("size") >= thin))
    met = met.withColumn("block", F.floor(lot / thin) % blocks)
    a, b = asked.alias("a"), met.alias("b")
    earlier = (F.col("b.doc_id") < F.col("a.upto")) & _alike("a", "b", apart)
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.block") == F.col("b.block")) & earlier)
    return pairs.groupBy(F.col("a.fp").alias("fp")).agg(F.min("b.doc_id").alias("near"))


def _verified(pairs: DataFrame, named: DataFrame, apart: int) -> DataFrame:
    """(fp, near): the smallest ``other`` of the pairs (fp, other) whose fingerprints are alike."""
    pairs = materialise(pairs.distinct(), "print-pairs")
    mine = named.select("fp", *_words("fingerprint")).join(pairs.select("fp").distinct(), "fp", "left_semi")
    theirs = named.select(F.col("doc_id").alias("other"), *_words("fingerprint"))
    theirs = theirs.join(pairs.select("other").distinct(), "other", "left_semi")
    whole = lookup_join(pairs, mine, "fp", spread_by="other").alias("a")
    alike = whole.join(theirs.alias("b"), (F.col("a.other") == F.col("b.other")) & _alike("a", "b", apart))
    return alike.groupBy("fp").agg(F.min("a.other").alias("near"))
