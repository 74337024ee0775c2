"""Token sequences in training order, as shards of fixed stride.

Each task packs the documents it reads into sequences of ``length`` ids, an end mark after
every document, and writes them once with their place in the task. Counts per task make
those places global indices 0..N-1. A keyed Feistel network permutes them: it works on the
smallest even number of bits that covers N, and indices that fall outside are sent through
again until they fall inside (cycle-walking). The result is a bijection on 0..N-1 that
any reader can compute in both directions from the key alone.

Sequence with slot s is number ``s % per_shard`` of shard ``s // per_shard``; ids are
little-endian, two bytes each (four for larger vocabularies), so its bytes begin at
``(s % per_shard) * length * width``. Shards are dealt to tasks by range. A training run
reads them one after the other and resumes at any slot.

Rows: null and empty texts have no ids and leave no mark. The last sequence of a task is
filled up with end marks; ``filled`` counts the ids before them. No documents, no shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gripelens.llm.byte_bpe import ByteBpe, codec_of, slices
from gripelens.runtime import fresh_path, lookup_join

_U = np.uint64
_SHARDS = "shard bigint, first_slot bigint, sequences int, filled bigint, data binary"


def _round(half: np.ndarray, key: int, step: int, mask: int) -> np.ndarray:
    salt = (key * 0x9E3779B97F4A7C15 + step * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF
    x = (half + _U(salt)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return (x ^ (x >> _U(32))) & _U(mask)


@dataclass(frozen=True)
class Permutation:
    """Keyed bijection on 0..size-1."""

    size: int
    key: int
    rounds: int = 6

    def _half_bits(self) -> int:
        return max(1, -(-max(self.size - 1, 1).bit_length() // 2))

    def _pass(self, x: np.ndarray, steps) -> np.ndarray:
        bits = self._half_bits()
        mask = (1 << bits) - 1
        left, right = x >> _U(bits), x & _U(mask)
        for step in steps:
            left, right = right, left ^ _round(right, self.key, step, mask)
        return right << _U(bits) | left  # halves swapped, so that the reverse order inverts

    def _walk(self, x: np.ndarray, steps) -> np.ndarray:
        out = self._pass(np.asarray(x).astype(_U), steps)
        while True:
            outside = np.flatnonzero(out >= _U(self.size))
            if not len(outside):
                return out.astype(np.int64)
            out[outside] = self._pass(out[outside], steps)

    def slots(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, range(self.rounds))

    def indices(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, range(self.rounds - 1, -1, -1))

    def column(self, index: Column) -> Column:
        permutation = self

        @F.arrow_udf("bigint")
        def slots(batch: pa.Array) -> pa.Array:
            return pa.array(permutation.slots(batch.to_numpy(zero_copy_only=False)))

        return slots(index)


@dataclass(frozen=True)
class TrainingOrder:
    bpe: ByteBpe
    end_id: int
    length: int = 2048
    per_shard: int = 512
    key: int = 20_240_229

    @property
    def kind(self) -> np.dtype:
        return np.dtype("<u2" if self.end_id < 1 << 16 else "<u4")

    def pack(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """(part, place, filled, data): sequences of each task, written as a table."""
        length, end, kind, rank_file = self.length, self.end_id, self.kind, self.bpe.rank_file

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec, part = codec_of(rank_file), TaskContext.get().partitionId()
            rest, place = np.zeros(0, kind), 0

            def rows(ids: np.ndarray, filled: list[int]) -> pa.RecordBatch:
                nonlocal place
                n = len(filled)
                places = pa.array(range(place, place + n), pa.int64())
                place += n
                data = pa.array([row.tobytes() for row in ids.reshape(n, length)], pa.binary())
                return pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), places, pa.array(filled, pa.int32()), data],
                    ["part", "place", "filled", "data"],
                )

            for batch in slices(batches, text_col):
                ids, counts = codec.encode([t or "" for t in batch.column(text_col).to_pylist()])
                ends = np.cumsum(counts)[counts > 0]
                laid = np.concatenate([rest, np.insert(ids, ends, end).astype(kind)])
                whole = len(laid) // length
                if whole:
                    yield rows(laid[: whole * length], [length] * whole)
                rest = laid[whole * length :]
            if len(rest):
                yield rows(np.append(rest, np.full(length - len(rest), end, kind)), [len(rest)])

        packed = docs.select(text_col).mapInArrow(run, "part int, place bigint, filled int, data binary")
        path = fresh_path(docs.sparkSession, "sequences")
        packed.write.option("compression", "zstd").parquet(path)
        return docs.sparkSession.read.schema(packed.schema).parquet(path)

    def shards(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """(shard, first_slot, sequences, filled, data), one row per shard."""
        packed = self.pack(docs, text_col)
        # One row per task.
        counts = packed.groupBy("part").agg(F.count("*").alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), "n")
        total = int(offsets.agg(F.max(F.col("offset") + F.col("n"))).first()[0] or 0)
        order = Permutation(max(total, 1), self.key)
        placed = lookup_join(packed, offsets.select("part", "offset"), "part")
        slot = order.column(F.col("offset") + F.col("place"))
        dealt = placed.select(slot.alias("slot"), "filled", "data").withColumn(
            "shard", F.floor(F.col("slot") / self.per_shard)
        )
        ranges = max(1, -(-total // (16 * self.per_shard)))
        ordered = dealt.repartitionByRange(ranges, "shard").sortWithinPartitions("slot")
        per_shard = self.per_shard

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            open_: list[tuple[int, int, bytes]] = []

            def close() -> pa.RecordBatch:
                shard = open_[0][0] // per_shard
                row = (shard, open_[0][0], len(open_), sum(f for _, f, _ in open_), b"".join(d for *_, d in open_))
                open_.clear()
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                return pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, kinds)], [c.split()[0] for c in _SHARDS.split(", ")]
                )

            for batch in batches:
                for slot, filled, data in zip(*[batch.column(c).to_pylist() for c in ("slot", "filled", "data")]):
                    if open_ and open_[0][0] // per_shard != slot // per_shard:
                        yield close()
                    open_.append((slot, filled, data))
            if open_:
                yield close()

        return ordered.mapInArrow(run, _SHARDS)

    def sequence(self, data: bytes, slot: int) -> np.ndarray:
        """Ids of a slot from the bytes of its shard."""
        stride = self.length * self.kind.itemsize
        at = slot % self.per_shard * stride
        return np.frombuffer(data[at : at + stride], self.kind)


def write_shards(shards: DataFrame, path: str) -> None:
    """Stores the shards by shard number, uncompressed, in the order of the slots."""
    shards.write.option("compression", "none").parquet(path)


def read_from(spark: SparkSession, path: str, slot: int, per_shard: int) -> DataFrame:
    """The shards from the one that holds ``slot``, in order: where a stopped run goes on."""
    return spark.read.parquet(path).where(F.col("shard") >= slot // per_shard).orderBy("shard")
