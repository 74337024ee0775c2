"""Byte-level BPE encoding and decoding of whole texts.

Texts of an Arrow batch are laid end to end; ``pretokens`` finds all slices at once, and
each slice is looked up among the merged pieces that a worker keeps between batches: those of
fewer than 8 bytes are numbers and looked up all together, the others one by one.
Only a slice that is new to the worker is merged pair by pair. Nothing is shuffled: a
text becomes ids in the task that reads it.

Rows: a null text counts as empty; an empty text has no ids. Other columns pass through;
an input column that bears the name of an output is replaced. Long texts are cut into
no pieces: a text is a slice of the batch whatever its length, and a single slice of n
bytes merges in n log n steps.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gripelens.llm.pretokens import boundaries

# Characters laid end to end at a time, and merged pieces a worker remembers; as many older ones
# stay until they are asked for again.
CHUNK_CHARS = 500_000
CACHED_PIECES = 250_000
_LONG_PIECE = 256
_NEVER = 1 << 62


def read_ranks(path: str) -> bytes:
    """The vocabulary file as it is (about 1 MB): it travels with the job."""
    return Path(path).read_bytes()


class OpenTable:
    """Numbers (0 or more) by 64-bit keys (0 or more), in arrays, a quarter full at most; a key stands
    in its slot or after it, the first slot following the last."""

    def __init__(self, most: int):
        self.count, bits = 0, max(4 * most, 16).bit_length()
        self.most, self.shift = (1 << bits) // 4, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift).view(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds different keys that are not there yet."""
        self.count += len(keys)
        slot = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys.take(slot) == -1)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, slot = keys[rest], values[rest], slot[rest] + 1 & len(self.keys) - 1

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is not there."""
        at = self._slots(keys)
        there = self.keys.take(at)
        found = np.where(there == keys, self.values.take(at), -1)
        other = np.flatnonzero((there != keys) & (there != -1))
        at = at[other]
        while len(other):
            at = at + 1 & len(self.keys) - 1
            there = self.keys.take(at)
            same = there == keys[other]
            found[other[same]] = self.values[at[same]]
            on = ~same & (there != -1)
            other, at = other[on], at[on]
        return found

    def roomy(self, more: int) -> OpenTable:
        """This table, or a larger one if so many more keys do not fit."""
        if self.count + more <= self.most:
            return self
        out, held = OpenTable(2 * (self.count + more)), np.flatnonzero(self.keys != -1)
        out.put(self.keys[held], self.values[held])
        return out


class Codec:
    """Ids of texts and bytes of ids, for one vocabulary."""

    def __init__(self, rank_file: bytes):
        pairs = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        size = max(self.ranks.values()) + 1
        words = [b""] * size
        for word, rank in self.ranks.items():
            words[rank] = word
        self.word_bytes = np.frombuffer(b"".join(words), np.uint8)
        self.word_sizes = np.array([len(w) for w in words], np.int64)
        self.word_starts = np.cumsum(self.word_sizes) - self.word_sizes
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {
            (self.ranks[w[:i]] << 32 | self.ranks[w[i:]]): r
            for w, r in self.ranks.items()
            for i in range(1, len(w))
            if w[:i] in self.ranks and w[i:] in self.ranks
        }
        keys = np.array([*pairs, np.iinfo(np.int64).max], np.int64)
        self.pairs = OpenTable(len(keys))
        self.pairs.put(keys, np.array([*pairs.values(), _NEVER], np.int64))
        self._forget_short()
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece: repeatedly join the adjacent pair of lowest rank, the
        leftmost among equals. Pieces of usual length are merged side by side, round by round."""
        out: list[bytes] = [b""] * len(pieces)
        short = []
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = _pack([whole])
            elif len(piece) > _LONG_PIECE:
                out[k] = _pack(self._merge_long(piece))
            else:
                short.append(k)
        if short:
            for k, ids in zip(short, self._merge_short([pieces[k] for k in short])):
                out[k] = ids
        return out

    def _cost(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the joined pair; _NEVER where the vocabulary lacks it."""
        keys = left.astype(np.int64) << 32 | right
        cost = self.pairs.get(keys)
        return np.where(cost < 0, _NEVER, cost)

    def _merge_short(self, pieces: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_ids.take(np.frombuffer(b"".join(pieces), np.uint8))
        owner = np.repeat(np.arange(len(pieces)), sizes)
        last = np.append(owner[1:] != owner[:-1], True)
        cost = np.full(len(ids), _NEVER, np.int64)
        inner = np.flatnonzero(~last)
        cost[inner] = self._cost(ids[inner], ids[inner + 1])
        out: list[bytes] = [b""] * len(pieces)
        while len(ids):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(cost, first)
            sizes = np.diff(np.append(first, len(ids)))
            ended = best == _NEVER
            if ended.any():
                for k, a, n in zip(owner[first[ended]].tolist(), first[ended].tolist(), sizes[ended].tolist()):
                    out[k] = ids[a : a + n].tobytes()
                alive = np.repeat(~ended, sizes)
                ids, owner, cost = ids[alive], owner[alive], cost[alive]
                best, sizes = best[~ended], sizes[~ended]
                if not len(ids):
                    break
            at = np.flatnonzero(cost == np.repeat(best, sizes))
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]
            ids[at] = best
            rest = np.ones(len(ids), bool)
            rest[at + 1] = False
            ids, owner, cost = ids[rest], owner[rest], cost[rest]
            at -= np.arange(len(at))  # one symbol before each was dropped in every earlier piece
            right = at[at + 1 < len(ids)]
            same = owner[right] == owner[right + 1]
            cost[at] = _NEVER
            right = right[same]
            cost[right] = self._cost(ids[right], ids[right + 1])
            left = at[at > 0] - 1
            left = left[owner[left] == owner[left + 1]]
            cost[left] = self._cost(ids[left], ids[left + 1])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap over linked slices."""
        get, n = self.ranks.get, len(piece)
        end, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n:
                cost = get(piece[i : end[end[i]]])
                if cost is not None:
                    heapq.heappush(heap, (cost, i, end[end[i]]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if middle < 0 or middle >= n or end[middle] != stop:
                continue  # one of the two has changed meanwhile
            end[i], end[middle] = stop, -1
            if stop < n:
                left[stop] = i
            offer(left[i])
            offer(i)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids per text)."""
        ids, counts, i = [], [], 0
        while i < len(texts):
            size, j = 0, i
            while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK_CHARS):
                size += len(texts[j])
                j += 1
            a, b = self._encode_chunk(texts[i:j])
            ids.append(a)
            counts.append(b)
            i = j
        if not ids:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate(ids), np.concatenate(counts)

    def _encode_chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        laid = "\n".join(texts)
        points = np.frombuffer(laid.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 1) - 1  # separators stand after each text but the last
        starts = boundaries(points, ends[:-1])
        sizes = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        offsets = np.zeros(len(points) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        raw = laid.encode()
        at = offsets[starts]
        separators = np.searchsorted(starts, ends[:-1])
        sizes = np.diff(at, append=len(raw))
        first, counts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        wanted = np.ones(len(at), bool)
        wanted[separators] = False
        short, long = np.flatnonzero(wanted & (sizes < 8)), np.flatnonzero(wanted & (sizes >= 8))
        first[short], counts[short] = self._short(raw, at[short], sizes[short])
        others = self._long([raw[a:b] for a, b in zip(at[long].tolist(), (at + sizes)[long].tolist())])
        counts[long] = np.fromiter(map(len, others), np.int64, len(others)) // 4
        first[long] = self.used + np.cumsum(counts[long]) - counts[long]
        pool = np.concatenate([self.pool[: self.used], np.frombuffer(b"".join(others), np.int32)])
        sums = np.zeros(len(at) + 1, np.int64)
        np.cumsum(counts, out=sums[1:])
        ids = pool.take(np.repeat(first - sums[:-1], counts) + np.arange(sums[-1]))
        begin = np.concatenate([[0], separators + 1]).astype(np.int64)
        end = np.concatenate([separators, [len(at)]]).astype(np.int64)
        return ids, sums[end] - sums[begin]

    def _long(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pieces, from the cache where they are known."""
        if len(self.cache) > CACHED_PIECES:
            self.cache, self.older = {}, self.cache
        found = list(map(self.cache.get, pieces))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            asked = {pieces[k] for k in missing}
            known = asked & self.older.keys()
            self.cache.update((piece, self.older[piece]) for piece in known)
            new = list(asked - known)
            self.cache.update(zip(new, self.merge(new)))
            for k in missing:
                found[k] = self.cache[pieces[k]]
        return found

    def _forget_short(self) -> None:
        self.short = OpenTable(CACHED_PIECES)
        self.pool, self.used = np.zeros(4096, np.int32), 0

    def _short(self, raw: bytes, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the pool, number) of the ids of pieces of fewer than 8 bytes, whose key is
        their bytes and size. The table is begun anew when it is full."""
        padded = raw + bytes(8)
        words = np.ndarray(len(raw) + 1, "<i8", padded, strides=(1,))
        keys = words[at] & ((1 << 8 * sizes) - 1) | sizes << 56
        if self.short.count > CACHED_PIECES:
            self._forget_short()
        found = self.short.get(keys)
        new = np.unique(keys[found < 0])
        if len(new):
            made = self.merge([k[: k[7]] for k in map(bytes, new.astype("<i8").view(np.uint8).reshape(-1, 8))])
            counts = np.fromiter(map(len, made), np.int64, len(made)) // 4
            ids = np.frombuffer(b"".join(made), np.int32)
            if self.used + len(ids) > len(self.pool):
                self.pool = np.append(self.pool, np.zeros(len(self.pool) + len(ids), np.int32))
            self.pool[self.used : self.used + len(ids)] = ids
            self.short = self.short.roomy(len(new))
            self.short.put(new, self.used + np.cumsum(counts) - counts << 3 | counts)
            self.used += len(ids)
            found = self.short.get(keys)
        return found >> 3, found & 7

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids end to end, offset at which each id's bytes begin)."""
        sizes = self.word_sizes.take(ids)
        offsets = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        source = np.repeat(self.word_starts.take(ids) - offsets[:-1], sizes)
        source += np.arange(offsets[-1])
        return self.word_bytes.take(source), offsets


def _pack(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


_CODECS: dict[int, Codec] = {}


def codec_of(rank_file: bytes) -> Codec:
    """The worker's codec for this vocabulary; built once per worker."""
    key = hash(rank_file)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(rank_file)
    return _CODECS[key]


@dataclass(frozen=True)
class ByteBpe:
    """Encoder and decoder as table operators."""

    rank_file: bytes

    @classmethod
    def load(cls, path: str) -> ByteBpe:
        return cls(read_ranks(path))

    def encode(
        self, df: DataFrame, text_col: str = "text", ids_col: str | None = "ids", count_col: str = "n_tokens",
        decoded_col: str | None = None,
    ) -> DataFrame:
        """Adds the ids (array of int), their number, and, if named, what they decode to.

        ``ids_col`` None leaves the ids out; decoding in the same pass saves carrying
        them to a second operator.
        """
        added = [T.StructField(count_col, T.LongType(), False)]
        if ids_col:
            added.append(T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False))
        if decoded_col:
            added.append(T.StructField(decoded_col, T.BinaryType(), False))
        new = {f.name for f in added}
        keep = [f for f in df.schema.fields if f.name not in new]
        names, rank_file = [f.name for f in keep], self.rank_file

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = codec_of(rank_file)
            for batch in slices(batches, text_col):
                ids, counts = codec.encode([t or "" for t in batch.column(text_col).to_pylist()])
                columns = [batch.column(n) for n in names] + [pa.array(counts)]
                if ids_col:
                    columns.append(pa.ListArray.from_arrays(_offsets(counts), pa.array(ids)))
                if decoded_col:
                    columns.append(_decoded(codec, ids, counts))
                yield pa.RecordBatch.from_arrays(columns, [*names, *[f.name for f in added]])

        return df.mapInArrow(run, T.StructType([*keep, *added]))

    def decode(self, df: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
        """Adds the bytes that the ids stand for; null ids give empty bytes."""
        keep = [f for f in df.schema.fields if f.name != bytes_col]
        schema = T.StructType([*keep, T.StructField(bytes_col, T.BinaryType(), False)])
        names, rank_file = [f.name for f in keep], self.rank_file

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = codec_of(rank_file)
            for batch in slices(batches, ids_col):
                found = batch.column(ids_col)
                counts = np.array([len(x) if x.is_valid else 0 for x in found], np.int64)
                ids = found.flatten().to_numpy(zero_copy_only=False)
                columns = [batch.column(n) for n in names] + [_decoded(codec, ids, counts)]
                yield pa.RecordBatch.from_arrays(columns, [*names, bytes_col])

        return df.mapInArrow(run, schema)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_CHARS
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, so few at a time that ``column`` stays near ``most`` values."""
    for batch in batches:
        values = batch.column(column)
        sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _decoded(codec: Codec, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per text, cut from the decoded bytes at the texts' offsets."""
    raw, offsets = codec.decode(ids)
    ends = np.concatenate([[0], np.cumsum(counts)])
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(offsets[ends].astype(np.int32)), pa.py_buffer(raw)]
    )


def _offsets(counts: np.ndarray) -> pa.Array:
    out = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=out[1:])
    return pa.array(out)
