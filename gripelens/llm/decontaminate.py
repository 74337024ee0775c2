"""Benchmark passages in documents, also reworded, by latent semantic retrieval.

1. Words of the benchmark form the vocabulary; documents become sequences of its numbers
   (-1 for other words), written once. Words outside it cannot contribute to a match.
2. Passages are windows of two half-windows of HALF words. Term weights are the count in
   the passage times the cubed inverse document frequency over all passages of the corpus.
3. Randomised SVD, distributed: with A the passage-term matrix and a random test matrix W,
   one pass sums Y = A'(A W); the leading eigenvectors of A'A follow from Y and W'Y on
   the driver (a Nystrom approximation of vocabulary x rank numbers).
4. Passages and benchmark items are compared by their cosine in that space. An item counts
   as a candidate from a share of the cosine that containing it whole would give.
5. Rare words decide the cosine, the more so the larger the corpus. So an item also counts as
   a candidate wherever enough of its words are around that step 6 could confirm it
   (see ``Bounds``): nothing that would be confirmed is missed.
6. A candidate is confirmed on the words themselves: the longest common subsequence of
   item and passage (with its surroundings) must hold LCS_SHARE of the item. For rewordings
   PARAPHRASE_SHARE will do if the answer, the item's last sentence, is there as well: all
   of its words, in order. Items of fewer than SHORT words are ordinary phrases unless they
   are there word for word: all of their words in one piece.

The benchmark is taken in blocks of ITEMS, each a pass over the word numbers, so that
vocabulary and matrices are bounded whatever its size; items of equal text are searched for
once. Passages cover whole texts, and very long ones are compared STRETCH half-windows at a time.

Rows: null or empty texts match nothing, nor do items without words. Repeated items and
documents each get their rows. An empty benchmark gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelens.llm.byte_bpe import slices
from gripelens.runtime import materialise

HALF = 32
RANK, SPARE = 128, 16
ITEMS = 512
SHORT = 8
STRETCH = 4_096
AROUND_WORDS = 1_000_000  # words around candidates that a task counts at a time
CHUNK_WORDS = 200_000  # words whose numbers a task turns into passages at a time
# Words of more than one in COMMON passages do not tell passages apart and weigh nothing (in a
# corpus of fewer than COMMON^2 passages: of more than the root of their number).
COMMON, KEPT = 50, 8
COSINE_SHARE = 0.6
LCS_SHARE, PARAPHRASE_SHARE = 0.75, 0.5
_FOUND = "doc_id bigint, item string, lcs int, item_words int, start int, stop int, answered boolean"
# ASCII marks and controls separate words; other bytes belong to them.
_BLANKED = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def text_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BLANKED).split()


def word_places(item: list[int]) -> dict[int, int]:
    """The places of every word of the item, as bits."""
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    return places


def lcs(places: dict[int, int], other: list[int]) -> int:
    """Length of the longest common subsequence of an item, given by its ``word_places``, and
    ``other``: a machine word of the item at a time."""
    full = 0
    for bits in places.values():
        full |= bits
    row = full
    for w in other:
        hit = places.get(w, 0)
        if hit:
            both = row & hit
            row = (row + both | row - both) & full
    return full.bit_count() - row.bit_count()


def in_one_piece(item: np.ndarray, other: np.ndarray) -> bool:
    """Does ``other`` hold the words of ``item`` next to each other?"""
    at = np.flatnonzero(other[: max(len(other) - len(item) + 1, 0)] == item[0])
    for k in range(1, len(item)):
        at = at[other[at + k] == item[k]]
    return bool(len(at))


@dataclass(frozen=True)
class Items:
    """A block of the benchmark in vocabulary numbers; ``ids`` are digests of the texts."""

    ids: list[str]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[str, str]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        ids, words, answers = [], [], []
        for item, text in rows:
            found = text_words(text)
            if not found:
                continue
            ids.append(item)
            words.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in found], np.int32))
            last = [text_words(s) for s in re.split(r"[.!?\n]+", text)]
            last = [s for s in last if s]
            answers.append(np.array([vocabulary[w] for w in last[-1]] if len(last) > 1 else [], np.int32))
        return cls(ids, words, answers, vocabulary)


def numbered(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, ids): every word of every text as its number in the vocabulary, or -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in slices(batches, "text"):
            flat: list[int] = []
            ends = [0]
            for text in batch.column("text").to_pylist():
                flat.extend(map(get, text_words(text), repeat(-1)))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


class _Halves:
    """Known words of a batch, grouped by half-window."""

    def __init__(self, lists: pa.Array, useful: np.ndarray | None = None):
        offsets = lists.offsets.to_numpy().astype(np.int64)
        self.flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        self.starts = offsets[:-1] - offsets[0]
        self.sizes = np.diff(offsets)
        self.per_doc = np.maximum(-(-self.sizes // HALF), 1)
        self.count = int(self.per_doc.sum())
        self.first = np.cumsum(self.per_doc) - self.per_doc  # first half-window of each document
        known = np.flatnonzero(self.flat >= 0)
        doc = np.searchsorted(self.starts + self.sizes, known, side="right")
        self.known = self.flat[known], self.first[doc] + (known - self.starts[doc]) // HALF
        self.words, self.half = self.known if useful is None else self.some(useful)
        last = np.zeros(self.count, bool)
        last[self.first + self.per_doc - 1] = True
        self.last = last

    def some(self, useful: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, half-windows) of the useful ones among the known words."""
        keep = np.flatnonzero(useful.take(self.known[0]))
        return self.known[0].take(keep), self.known[1].take(keep)

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Sum of ``rows[word]`` over each half-window."""
        out = np.zeros((self.count, rows.shape[1]), np.float32)
        if len(self.words):
            # The k-th words of all half-windows are added together: no half-window twice at once.
            begins = np.flatnonzero(np.diff(self.half, prepend=-1))
            sizes = np.diff(np.append(begins, len(self.half)))
            for k in range(int(sizes.max())):
                at = begins[sizes > k] + k
                out[self.half[at]] += rows.take(self.words[at], axis=0)
        return out

    def windows(self, halves: np.ndarray) -> np.ndarray:
        """Each half-window with its successor in the same document."""
        out = halves.copy()
        out[:-1][~self.last[:-1]] += halves[1:][~self.last[:-1]]
        return out


def _parts(ids: DataFrame, measure, size: int, useful: np.ndarray | None = None) -> DataFrame:
    """(part, sums): arrays of float64 summed per task, cut into parts of ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches, "ids", CHUNK_WORDS):
            found = measure(_Halves(batch.column("ids"), useful))
            total = found if total is None else np.add(total, found, out=total)
        if total is not None:
            cut = [total[i : i + size].tobytes() for i in range(0, len(total), size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())], ["part", "sums"]
            )

    return ids.mapInArrow(run, "part int, sums binary")


def _total(parts: DataFrame) -> np.ndarray:
    """The arrays of all tasks added up, part by part in two levels, and brought to the driver."""

    def add(found: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b) for b in found["sums"]], axis=0)
        return pd.DataFrame({"part": [found["part"].iloc[0]], "sums": [total.tobytes()]})

    some = parts.groupBy("part", F.pmod(F.xxhash64("sums"), F.lit(16))).applyInPandas(add, "part int, sums binary")
    rows = some.groupBy("part").applyInPandas(add, "part int, sums binary").collect()
    ordered = [np.frombuffer(r["sums"]) for r in sorted(rows, key=lambda r: r["part"])]
    return np.concatenate(ordered) if ordered else np.zeros(0)


def frequencies(ids: DataFrame, words: int) -> np.ndarray:
    """Half-windows of the corpus that hold each word; their number stands last."""

    def measure(h: _Halves) -> np.ndarray:
        pairs = np.unique(h.half.astype(np.int64) * words + h.words)
        return np.append(np.bincount(pairs % words, minlength=words), h.count).astype(np.float64)

    return _total(_parts(ids, measure, 1 << 16))


def word_weights(holding: np.ndarray, passages: float, items: list[np.ndarray]) -> np.ndarray:
    """Cubed inverse document frequency; nothing for common words, except that every item
    keeps its KEPT rarest, however often it was copied into the corpus."""
    idf = np.maximum(np.log((passages + 1) / (holding + 1)), 0)
    common = min(np.log(COMMON), np.log(passages + 1) / 2)
    weights = np.where(idf >= common, idf, 0) ** 3
    for words in items:
        own = np.unique(words)
        rarest = own[np.argsort(-idf[own], kind="stable")[:KEPT]]
        weights[rarest] = np.maximum(weights[rarest], max(common, 0.1) ** 3)
    return weights


def latent_space(ids: DataFrame, weights: np.ndarray, own: np.ndarray, seed: int = 7) -> np.ndarray:
    """(words x rank) leading right singular vectors of the passage-term matrix.

    ``own``: the items' rows, which belong to the matrix as well.
    """
    words = len(weights)
    rank = min(RANK + SPARE, words)
    test = np.random.default_rng(seed).standard_normal((words, rank))
    test = np.linalg.qr(test)[0]
    weighted = (test * weights[:, None]).astype(np.float32)

    def measure(h: _Halves) -> np.ndarray:
        y = np.zeros((rank, words))
        if len(h.words):
            for k, column in enumerate(np.ascontiguousarray(h.sums(weighted).T)):
                y[k] = np.bincount(h.words, weights=column.take(h.half), minlength=words)
        y *= weights
        return y.T.ravel()

    y = _total(_parts(ids, measure, 1 << 17, weights > 0))
    y = (y.reshape(words, rank) if len(y) else np.zeros((words, rank))) + own.T @ (own @ test)
    core = test.T @ y
    value, vector = np.linalg.eigh((core + core.T) / 2)
    keep = value > max(value.max(), 1e-12) * 1e-9
    root = y @ (vector[:, keep] / np.sqrt(value[keep]))  # A'A is about root root'
    left, scale, _ = np.linalg.svd(root, full_matrices=False)
    rank = min(RANK, int((scale > scale[:1].sum() * 1e-6).sum()))
    return left[:, :rank]


class Bounds:
    """Where the words around a passage suffice for a match.

    If ``need`` of an item's n words are matched, at least m - (n - need) of any m of them are
    there. Of all m, the rarest words first, the one is taken that fewest passages meet by
    chance. A match by the answer also needs the answer's rarest word. Half-windows are added
    up, so a word may count more than once; it never counts too little.
    """

    def __init__(self, items: Items, seen: np.ndarray):
        self.items, words = len(items.ids), len(seen) - 1
        self.reach = np.array([-(-len(w) // HALF) for w in items.words])
        # Items of equal reach stand side by side in the tables.
        self.order = np.argsort(self.reach, kind="stable")
        place = np.argsort(self.order).tolist()
        tables: list[list[tuple[int, int, int]]] = [[], [], []]
        self.least = np.ones((3, self.items), np.int32)
        for k, found in enumerate(items.words):
            n = len(found)
            own, times = np.unique(found, return_counts=True)
            order = np.argsort(seen[own], kind="stable")
            own, times = own[order], times[order]
            m = np.cumsum(times)
            chance = np.cumsum(times * (seen[own] / max(seen[-1], 1)))
            if n < SHORT:
                self.least[1, k] = np.iinfo(np.int32).max  # no paraphrases of short items
            for table, share in enumerate((1.0,) if n < SHORT else (LCS_SHARE, PARAPHRASE_SHARE)):
                least = m - (n - int(np.ceil(n * share - 1e-9)))
                upto = int(np.argmin(np.where(least > 0, (chance + 1e-9) / np.maximum(least, 1), np.inf)))
                self.least[table, k] = least[upto]
                tables[table] += [(w, place[k], t) for w, t in zip(own[: upto + 1].tolist(), times.tolist())]
            answer = items.answers[k]
            if len(answer):
                tables[2].append((int(answer[np.argmin(seen[answer])]), place[k], 1))
        self.used = np.zeros(words, bool)
        self.tables = []
        for table in tables:
            rows = np.array(sorted(table), np.int64).reshape(-1, 3)
            self.used[rows[:, 0]] = True
            starts = np.searchsorted(rows[:, 0], np.arange(words + 1))
            self.tables.append((starts[:-1], np.diff(starts), rows[:, 1], rows[:, 2]))

    def held(self, lists: pa.Array | _Halves) -> Iterator[np.ndarray]:
        """(half-windows x items), STRETCH half-windows at a time: may the item match around the passage
        that begins there? Each stretch sees as many half-windows beyond its ends as items reach."""
        h = lists if isinstance(lists, _Halves) else _Halves(lists)
        words, halves = h.some(self.used)
        pairs = np.unique(halves.astype(np.int64) * len(self.used) + words)
        half, word = pairs // len(self.used), pairs % len(self.used)
        low = np.repeat(h.first, h.per_doc)
        high = np.repeat(h.first + h.per_doc, h.per_doc)
        margin = int(self.reach.max()) + 2
        for start in range(0, h.count, STRETCH):
            stop = min(start + STRETCH, h.count)
            begin, end = max(start - margin, 0), min(stop + margin, h.count)
            mine = slice(*np.searchsorted(half, [begin, end]))
            bounds = (a[start:stop] - begin for a in (np.maximum(low, begin), np.minimum(high, end)))
            yield self._stretch(half[mine] - begin, word[mine], end - begin, np.arange(start, stop) - begin, *bounds)

    def _stretch(self, half, word, count: int, at, low, high) -> np.ndarray:
        """The part of ``held`` for the half-windows ``at`` of ``count``, whose documents lie from low to high."""
        enough = []
        for table, (starts, sizes, item, times) in enumerate(self.tables):
            n = sizes[word]
            posting = np.repeat(starts[word] - np.cumsum(n) + n, n) + np.arange(n.sum())
            cell = np.repeat(half, n) * self.items + item[posting]
            total = np.zeros((count + 1, self.items), np.int32)
            np.add.at(total.ravel(), cell + self.items, times[posting].astype(np.int32))
            np.cumsum(total, axis=0, out=total)
            ok = np.zeros((len(at), self.items), bool)
            first = 0
            for reach, several in zip(*[x.tolist() for x in np.unique(self.reach, return_counts=True)]):
                mine = slice(first, first + several)
                part = total[:, mine]
                around = part.take(np.minimum(at + 2 + reach, high), axis=0)
                around -= part.take(np.maximum(at - reach, low), axis=0)
                np.greater_equal(around, self.least[table, self.order[mine]], out=ok[:, mine])
                first += several
            enough.append(ok)
        held = np.empty_like(enough[0])
        held[:, self.order] = enough[0] | enough[1] & enough[2]
        return held


class Around:
    """Which candidates have enough of the item's words around them, many at a time: a common
    subsequence is no longer than the words that item and surroundings share."""

    def __init__(self, words: list[np.ndarray], answers: list[np.ndarray], vocabulary: int):
        self.lengths = np.array([len(w) for w in words])
        self.times = np.zeros((len(words), vocabulary), np.int32)
        self.answer = np.zeros((len(words), vocabulary), bool)
        for k, (found, answer) in enumerate(zip(words, answers)):
            np.add.at(self.times[k], found, 1)
            self.answer[k, answer] = True
        self.in_answer = self.answer.sum(1)
        # Words of each item, to leave out all others; the last place is for unknown words.
        self.member = np.pad(self.times > 0, ((0, 0), (0, 1)))

    def enough(self, h: _Halves, window: np.ndarray, item: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(candidate, document, first and last word around it, answer there?) of those with enough."""
        doc = np.searchsorted(h.first, window, side="right") - 1
        extra, begin = self.lengths[item], (window - h.first[doc]) * HALF
        a, b = np.maximum(begin - extra, 0), np.minimum(begin + 2 * HALF + extra, h.sizes[doc])
        ends, start = np.cumsum(b - a), 0
        while start < len(window):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + AROUND_WORDS, side="right")))
            part = slice(start, stop)
            answered, keep = self._counted(h, item[part], (h.starts[doc] + a)[part], (b - a)[part])
            at = np.flatnonzero(keep) + start
            yield at, doc[at], a[at], b[at], answered[keep]
            start = stop

    def _counted(self, h: _Halves, item: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, words = len(item), self.times.shape[1]
        of = np.repeat(np.arange(n), size)
        word = h.flat.take(np.repeat(first - np.cumsum(size) + size, size) + np.arange(len(of)))
        mine = np.flatnonzero(self.member.ravel().take(item[of] * (words + 1) + np.where(word < 0, words, word)))
        of, word = of[mine], word[mine]
        own = np.bincount(of, minlength=n)
        of, word = np.divmod(np.unique(of * words + word), words)
        shared = np.minimum(own, np.bincount(of, self.times[item[of], word], n))  # at least the common subsequence
        there = np.bincount(of, self.answer[item[of], word], n)
        answered = (self.in_answer[item] > 0) & (there == self.in_answer[item])
        share = np.where(self.lengths[item] < SHORT, 1.0, np.where(answered, PARAPHRASE_SHARE, LCS_SHARE))
        return answered, shared >= self.lengths[item] * share


def search(ids: DataFrame, items: Items, weights: np.ndarray, basis: np.ndarray, seen: np.ndarray) -> DataFrame:
    """Confirmed matches: one row per document and item, the best of its passages."""
    rows = (basis * weights[:, None]).astype(np.float32)
    counts = np.zeros((len(items.ids), len(weights)), np.float32)
    for k, words in enumerate(items.words):
        np.add.at(counts[k], words, 1)
    targets = counts @ rows
    targets /= np.maximum(np.linalg.norm(targets, axis=1, keepdims=True), 1e-9)
    lengths = np.array([len(w) for w in items.words])
    least = (COSINE_SHARE * np.sqrt(np.minimum(lengths / (2 * HALF), 1.0))).astype(np.float32)
    bounds = Bounds(items, seen)
    item_ids, item_words, answers = items.ids, items.words, items.answers
    item_places = [word_places(w.tolist()) for w in item_words]
    answer_places = [word_places(w.tolist()) for w in answers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = Around(item_words, answers, len(weights))
        for batch in slices(batches, "ids", CHUNK_WORDS):
            h = _Halves(batch.column("ids"), weights > 0)
            z = h.windows(h.sums(rows))
            z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
            hits = []
            for part, held in enumerate(bounds.held(h)):
                cosine = z[part * STRETCH : part * STRETCH + len(held)] @ targets.T
                window, item = np.nonzero((cosine >= least) | held)
                hits.append((window + part * STRETCH, item, cosine[window, item]))
            window, item, near = map(np.concatenate, zip(*hits))
            best: dict[tuple[int, int], tuple] = {}
            for at, *where in around.enough(h, window, item):
                candidates = zip(item[at].tolist(), near[at].tolist(), *[x.tolist() for x in where])
                for k, cosine, d, a, b, answerable in candidates:
                    base, extra = int(h.starts[d]), len(item_words[k])
                    there = h.flat[base + a : base + b]
                    if extra < SHORT and not in_one_piece(item_words[k], there):
                        continue
                    own = there[around.member[k].take(there)].tolist()
                    length = lcs(item_places[k], own)
                    share = length / extra
                    answered = answerable and lcs(answer_places[k], own) == len(answers[k])
                    if share >= LCS_SHARE or share >= PARAPHRASE_SHARE and answered:
                        found = (length, cosine, extra, a, b, answered)
                        best[d, k] = max(best.get((d, k), found), found)
            names = batch.column("doc_id").to_pylist()
            out = [(names[d], item_ids[k], found[0], *found[2:]) for (d, k), found in sorted(best.items())]
            columns = list(zip(*out)) if out else [[] for _ in range(7)]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in _FOUND.split(", ")]
            )

    return ids.mapInArrow(run, _FOUND)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, lcs, item_words, start, stop, answered) for every document that holds a
    benchmark item; ``start`` and ``stop`` are word positions around the passage."""
    digest = F.md5(F.col("text").cast("binary")).alias("item")
    named = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), "text", digest
    )
    items = named.groupBy("item").agg(F.min("text").alias("text"))
    blocks = max(1, -(-items.count() // ITEMS))
    found = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        rows = sorted((r["item"], r["text"]) for r in mine.collect())
        taken = Items.of(rows)
        if not taken.ids:
            continue
        ids = materialise(numbered(docs, taken.vocabulary), "numbered")
        seen = frequencies(ids, len(taken.vocabulary))
        seen = seen if len(seen) else np.zeros(len(taken.vocabulary) + 1)
        weights = word_weights(seen[:-1], seen[-1], taken.words)
        own = np.zeros((len(taken.ids), len(weights)))
        for k, words in enumerate(taken.words):
            np.add.at(own[k], words, 1)
        basis = latent_space(ids, weights, own * weights)
        here = search(ids, taken, weights, basis, seen)
        found = here if found is None else found.unionByName(here)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _FOUND)
    rest = [c for c in found.columns if c not in ("doc_id", "item")]
    return found.join(named.select("item", "item_id"), "item").select("doc_id", "item_id", *rest)
