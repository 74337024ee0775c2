"""MinHash near-duplicates with an LSH forest.

1. One pass over the texts gives each document its set size, a fingerprint of its shingle
   set and TREES * DEPTH minimum hashes. Documents with the same set form a class; only
   classes go on, so copies cost one row each.
2. Forest. Each tree orders the classes by its DEPTH minimum hashes. In that order the
   neighbours of a class are those with the longest common prefix: where classes are
   sparse one common hash makes neighbours, where they are dense only long prefixes do.
   A class meets its NEIGHBOURS successors, if at least the first hash agrees. The order
   is cut into ranges (ties broken by fingerprint, so that a third of all rows under one
   prefix still spreads); the rows next to a cut are compared in a second, small step.
3. Regions with more classes than a window covers get an exact remedy for star-shaped
   groups: each member also meets the region's oldest class. And after each round,
   components shrink to their best-linked class and crowded regions are ordered anew,
   until a round finds no new link.
4. Coverage. The forest only makes components early and cheaply; what it leaves apart goes
   through a prefix-filter join on the full sets (see ``prefix_join``), which compares all
   classes that share one of their rarest shingles and are not yet in one component.
5. Candidates whose size ratio or estimated similarity (minimum hashes, seven standard
   deviations below the threshold) rules them out are dropped; all others are confirmed on
   the full sets.

Rows: a null text counts as empty; a document without words is linked with nothing. Rows
with the same ``doc_id`` are judged by their texts one by one. A null ``doc_id`` sorts as
the largest; such a row is a member of its class like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelens.llm.byte_bpe import slices
from gripelens.llm.components import components
from gripelens.llm.shingles import shingle_sets, shingles, signatures
from gripelens.runtime import lookup_join, materialise

TREES, DEPTH = 6, 8
NEIGHBOURS = 3
_COUNT = TREES * DEPTH
# The prefix join: hash buckets whose counts order the shingles, bytes of a row's sketch, classes
# that share a shingle from which they are dealt out in blocks, and classes per block.
BUCKETS = 1 << 18
SKETCH = 24
CROWD, BLOCK = 1024, 512
_NODE = "fp binary, id bigint, n bigint, sig binary"
_ROW = "tree int, key binary, fp binary, id bigint, n bigint, sketch binary"


@dataclass(frozen=True)
class NearDedup:
    """``width`` words per shingle; linked if ``100 * intersection >= percent * union``."""

    width: int = 5
    percent: int = 80

    def describe(self, docs: DataFrame) -> DataFrame:
        """(id, n, fp, sig) of every row of ``docs`` (doc_id, text)."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                found = signatures([t or "" for t in batch.column("text").to_pylist()], width, _COUNT)
                packed = found.minima.astype(">u4")
                sigs = [row.tobytes() if p else None for row, p in zip(packed, found.prints)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(found.sizes), pa.array(found.prints, pa.binary()), pa.array(sigs, pa.binary())],
                    ["id", "n", "fp", "sig"],
                )

        rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
        return rows.mapInArrow(run, "id bigint, n bigint, fp binary, sig binary")

    def classes(self, described: DataFrame) -> DataFrame:
        """One row per distinct non-empty set: (fp, id of the oldest member, n, sig, members)."""
        return (
            described.where(F.col("fp").isNotNull())
            .groupBy("fp")
            .agg(F.min("id").alias("id"), F.max("n").alias("n"), F.first("sig").alias("sig"), F.count("*").alias("members"))
        )

    def _enough(self, count: int = _COUNT) -> int:
        """Agreeing minimum hashes of ``count`` below which a pair cannot reach the threshold."""
        p = self.percent / 100
        return int(max(1, np.floor(count * p - 7 * np.sqrt(count * p * (1 - p)))))

    def _sizes_fit(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def forest(self, nodes: DataFrame) -> DataFrame:
        """One row per tree and class, with the tree's key and a one-byte sketch per hash."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(n, _COUNT, 4)
                sketch = pa.array([row.tobytes() for row in sigs[:, :, 3]], pa.binary())
                for tree in range(TREES):
                    keys = np.ascontiguousarray(sigs[:, tree * DEPTH : (tree + 1) * DEPTH]).reshape(n, -1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, tree, np.int32)),
                            pa.array([k.tobytes() for k in keys], pa.binary()),
                            batch.column("fp"), batch.column("id"), batch.column("n"), sketch,
                        ],
                        ["tree", "key", "fp", "id", "n", "sketch"],
                    )

        return nodes.select("fp", "id", "n", "sig").mapInArrow(run, _ROW)

    def neighbours(self, rows: DataFrame) -> DataFrame:
        """Candidate pairs (a, b) of neighbours in every tree's order."""
        enough, percent = self._enough(), self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tail: pa.Table | None = None
            opening = True
            for batch in batches:
                if not batch.num_rows:
                    continue
                table = pa.Table.from_batches([batch])
                if opening:  # the first rows may have neighbours before the cut
                    yield from _marked(table.slice(0, NEIGHBOURS))
                    opening = False
                if tail is not None:
                    table = pa.concat_tables([tail, table])
                fresh = tail.num_rows if tail is not None else 0
                yield _close_pairs(table, fresh, enough, percent)
                tail = table.slice(max(0, table.num_rows - NEIGHBOURS))
            if tail is not None:
                yield from _marked(tail)

        ordered = rows.repartitionByRange("tree", "key", "fp").sortWithinPartitions("tree", "key", "fp")
        found = materialise(
            ordered.mapInArrow(run, "a binary, b binary, tree int, key binary, n bigint"), "neighbours"
        )
        inside = found.where(F.col("b").isNotNull()).select("a", "b")
        # Per cut and tree a handful of rows, whatever the data.
        order = Window.partitionBy("tree").orderBy("key", "a")
        cuts = found.where(F.col("b").isNull()).select("tree", "key", "a", "n").distinct()
        across = [
            cuts.select(
                "a",
                F.lead("a", k).over(order).alias("b"),
                F.substring("key", 1, 4).alias("first"),
                F.substring(F.lead("key", k).over(order), 1, 4).alias("other"),
                "n",
                F.lead("n", k).over(order).alias("m"),
            )
            for k in range(1, NEIGHBOURS + 1)
        ]
        for pairs in across:
            fits = (F.col("first") == F.col("other")) & self._sizes_fit(F.col("n"), F.col("m"))
            inside = inside.unionByName(pairs.where(fits).select("a", "b"))
        return inside

    def crowded(self, rows: DataFrame) -> DataFrame:
        """(a, b, near): classes of regions that windows do not cover, with the region's oldest."""
        first = F.substring("key", 1, 4)
        region = F.struct(F.col("tree"), first.alias("first"))
        regions = (
            rows.groupBy(region.alias("region"))
            .agg(F.count("*").alias("size"), F.min(F.struct("id", "fp", "n", "sketch")).alias("oldest"))
            .where(F.col("size") > NEIGHBOURS + 1)
            .select("region", "oldest")
        )
        met = lookup_join(
            rows.select(region.alias("region"), "fp", "n", "sketch"), regions, "region", spread_by="fp"
        )
        agree = _agreement()(F.col("sketch"), F.col("oldest.sketch"))
        near = (F.col("fp") != F.col("oldest.fp")) & self._sizes_fit(F.col("n"), F.col("oldest.n"))
        return met.select(
            F.col("fp").alias("a"), F.col("oldest.fp").alias("b"), (near & (agree >= self._enough())).alias("near")
        )

    def shingle_levels(self, docs: DataFrame) -> np.ndarray:
        """One byte per hash bucket, four times the binary logarithm of its count over all
        documents. It only orders the prefixes: the join is exact for any order."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(BUCKETS, np.int64)
            for batch in slices(batches, "text"):
                flat = shingles([t or "" for t in batch.column("text").to_pylist()], width)
                counts += np.bincount((flat & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["b", "n"])

        levels = np.zeros(BUCKETS, np.uint8)
        counts = docs.select("text").mapInArrow(run, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n"))
        found = counts.toArrow()  # at most BUCKETS rows, as numbers
        levels[found["b"].to_numpy()] = np.minimum(1 + 4 * np.log2(found["n"].to_numpy()), 127)
        return levels

    def prefixes(self, docs: DataFrame) -> DataFrame:
        """(fp, keys): the ``n - ceil(t n) + 1`` rarest shingles of every distinct set."""
        levels, width, percent = self.shingle_levels(docs), self.width, self.percent
        smallest = -(-percent // (100 - percent))  # smaller sets are similar to equal ones only

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                found = [t or "" for t in batch.column("text").to_pylist()]
                flat, sizes = shingle_sets(found, width)
                prints = signatures(found, width, 1).prints
                level = levels[(flat & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.int64)
                keys = level << 56 | (flat >> np.uint64(8)).astype(np.int64)
                ends = np.cumsum(sizes)
                taken, lengths, names = [], [0], []
                for k, n in enumerate(sizes.tolist()):
                    if n >= smallest:
                        wide = n - -(-n * percent // 100) + 1
                        taken.append(np.sort(np.partition(keys[ends[k] - n : ends[k]], wide - 1)[:wide]))
                        lengths.append(wide)
                        names.append(prints[k])
                values = np.concatenate(taken) if taken else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths).astype(np.int32)), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), lists], ["fp", "keys"])

        return docs.select("text").mapInArrow(run, "fp binary, keys array<bigint>").dropDuplicates(["fp"])

    def prefix_join(self, nodes: DataFrame, roots: DataFrame, docs: DataFrame) -> DataFrame:
        """Candidate pairs (a, b), a < b, of classes in different components.

        Similar sets share one of their first ``n - ceil(t n) + 1`` shingles in any fixed
        order. Classes meet on those, in tasks that apply size, positional and sketch filter.
        A shingle of CROWD or more classes is nothing to do if one component holds them all;
        else the members of its largest component meet the others, and the others each other,
        in blocks that spread over tasks.
        """
        sketch = F.concat(*[F.substring("sig", 4 * k + 4, 1) for k in range(SKETCH)])
        about = nodes.select("fp", "n", sketch.alias("sketch")).join(
            roots.select(F.col("node").alias("fp"), "root"), "fp", "left"
        )
        rows = materialise(self.prefixes(docs).join(about, "fp"), "prefixes")
        each = rows.select(F.posexplode("keys").alias("pos", "key"), "fp", "n", "root", "sketch")
        hot = materialise(
            rows.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("size"))
            .where(F.col("size") >= CROWD), "prefix-crowds",
        )
        root = F.coalesce("root", "fp")
        shares = (
            lookup_join(rows.select(F.explode("keys").alias("key"), root.alias("main")), hot, "key", spread_by="main")
            .groupBy("key", "main", "size").agg(F.count("*").alias("own"))
        )
        blocks = lambda n: F.ceil(n / BLOCK).cast("int")
        split = materialise(
            shares.groupBy("key", "size").agg(F.max(F.struct("own", "main")).alias("m"))
            .select("key", "m.main", blocks(F.col("m.own")).alias("inner"), blocks(F.col("size") - F.col("m.own")).alias("outer")),
            "prefix-split",
        )
        known = lookup_join(each, split, "key", "left", spread_by="fp")
        spread = F.xxhash64("fp")
        inner, outer = F.pmod(spread, F.col("inner")).cast("int"), F.pmod(spread, F.col("outer")).cast("int")
        upto = lambda n: F.sequence(F.lit(0), n - 1)

        def meeting(kind: int, x: Column, y: Column, side: Column | int, cross: Column | bool) -> Column:
            side, cross = (v if isinstance(v, Column) else F.lit(v) for v in (side, cross))
            return F.struct(
                F.lit(kind).alias("kind"), x.cast("int").alias("x"), y.cast("int").alias("y"),
                side.cast("int").alias("side"), cross.alias("cross"),
            )

        own = F.transform(upto(F.col("outer")), lambda j: meeting(1, inner, j, 0, True))
        theirs = F.concat(
            F.transform(upto(F.col("inner")), lambda j: meeting(1, j, outer, 1, True)),
            F.transform(upto(F.col("outer")), lambda j: meeting(2, F.least(j, outer), F.greatest(j, outer), outer, j != outer)),
        )
        alone = F.array(meeting(0, F.lit(0), F.lit(0), 0, False))
        tasks = F.when(F.col("main").isNull(), alone).when(root == F.col("main"), own).otherwise(theirs)
        dealt = (
            known.where(F.col("main").isNull() | (F.col("outer") > 0))
            .select("key", "pos", "fp", "n", "root", "sketch", F.explode(tasks).alias("t"))
            .select("key", "t.*", "pos", "fp", "n", "root", "sketch")
        )
        place = ["key", "kind", "x", "y"]
        enough, percent = self._enough(SKETCH), self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tail: pa.Table | None = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                table = pa.Table.from_batches([batch])
                if tail is not None:
                    table = pa.concat_tables([tail, table])
                groups = np.stack([_flat(table, c).to_numpy() for c in place])
                last = table.num_rows - 1
                while last and (groups[:, last - 1] == groups[:, -1]).all():
                    last -= 1
                if last:
                    yield _meetings(table.slice(0, last), groups[:, :last], enough, percent)
                tail = table.slice(last)
            if tail is not None:
                groups = np.stack([_flat(tail, c).to_numpy() for c in place])
                yield _meetings(tail, groups, enough, percent)

        met = dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "a binary, b binary")
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def confirm(self, pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
        """The pairs that reach the threshold on full sets, which are made from the texts of
        the classes in question only."""
        wanted = (
            pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
        )
        ids = materialise(nodes.join(wanted, "fp", "left_semi").select(F.col("id").alias("doc_id")), "wanted")
        texts = lookup_join(docs.select("doc_id", "text"), ids.distinct(), "doc_id")
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                found = [t or "" for t in batch.column("text").to_pylist()]
                flat, sizes = shingle_sets(found, width)
                prints = signatures(found, width, 1).prints
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), lists], ["fp", "set"])

        sets = materialise(
            texts.select("text").mapInArrow(run, "fp binary, set array<bigint>").dropDuplicates(["fp"]), "sets"
        )
        first = pairs.join(sets.select(F.col("fp").alias("a"), F.col("set").alias("x")), "a")
        second = first.join(sets.select(F.col("fp").alias("b"), F.col("set").alias("y")), "b")
        shared = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - shared
        return second.where(shared * 100 >= union * self.percent).select("a", "b")

    def links(self, nodes: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(confirmed links between classes, components of the linked classes)."""
        links, roots, tested = self.forest_links(nodes, docs)
        if self.percent >= 100:
            return links, roots
        pairs = materialise(self.prefix_join(nodes, roots, docs), "prefix-pairs")
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        new = materialise(self.confirm(materialise(pairs, "pairs"), nodes, docs), "confirmed")
        if new.isEmpty():
            return links, roots
        links = links.unionByName(new)
        return links, components(links)

    def forest_links(self, nodes: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """(confirmed links of the forest, their components, pairs tested)."""
        active, links, roots, tested = nodes, None, None, None
        while True:
            rows = materialise(self.forest(active), "forest")
            met = materialise(self.crowded(rows), "crowded")
            found = self.neighbours(rows).unionByName(met.where("near").select("a", "b"))
            pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = materialise(pairs, "pairs")
            new = materialise(self.confirm(pairs, nodes, docs), "confirmed")
            if new.isEmpty():
                return (links, roots, tested) if links is not None else (new, components(new), pairs)
            links = new if links is None else links.unionByName(new)
            tested = pairs if tested is None else tested.unionByName(pairs)
            roots = components(links)
            ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
            degree = ends.groupBy("node").agg(F.count("*").alias("links"))
            best = (
                degree.join(roots, "node").groupBy("root")
                .agg(F.max(F.struct("links", "node")).alias("m")).select(F.col("m.node").alias("fp"))
            )
            crowd = met.select(F.col("a").alias("fp")).distinct()
            alone = crowd.join(roots.select(F.col("node").alias("fp")), "fp", "left_anti")
            active = materialise(nodes.join(best.unionByName(alone), "fp", "left_semi"), "active")

    def run(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; ``component_id``
        is the smallest doc_id that is reachable over links, the row's own included."""
        described = materialise(self.describe(docs), "described")
        nodes = materialise(self.classes(described), "classes")
        links, roots = self.links(nodes, docs)
        rooted = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
        smallest = rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("component"))
        linked = rooted.join(smallest, "root").select("fp", "component")
        copies = rooted.where(F.col("root").isNull() & (F.col("members") > 1)).select(
            "fp", F.col("id").alias("component")
        )
        table = materialise(linked.unionByName(copies), "components")
        out = lookup_join(described.select("id", "n", "fp"), table, "fp", "left", spread_by="id")
        component = F.coalesce("component", "id")
        return out.select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )


def _agreement():
    @F.arrow_udf("int")
    def agree(a: pa.Array, b: pa.Array) -> pa.Array:
        x = np.frombuffer(b"".join(a.to_pylist()), np.uint8).reshape(-1, _COUNT)
        y = np.frombuffer(b"".join(b.to_pylist()), np.uint8).reshape(-1, _COUNT)
        return pa.array((x == y).sum(1).astype(np.int32))

    return agree


def _marked(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows next to a cut, without a partner."""
    n = table.num_rows
    yield pa.RecordBatch.from_arrays(
        [_flat(table, "fp"), pa.nulls(n, pa.binary()), _flat(table, "tree"), _flat(table, "key"), _flat(table, "n")],
        ["a", "b", "tree", "key", "n"],
    )


def _flat(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table.column(name).chunks)


def _close_pairs(table: pa.Table, fresh: int, enough: int, percent: int) -> pa.RecordBatch:
    """Pairs at a distance of at most NEIGHBOURS of which the later row is new."""
    n = table.num_rows
    tree = table.column("tree").to_numpy()
    keys = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint32).reshape(n, DEPTH)[:, 0]
    sizes = table.column("n").to_numpy()
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(n, _COUNT)
    prints = _flat(table, "fp")
    left, right = [], []
    for k in range(1, NEIGHBOURS + 1):
        i = np.arange(max(fresh - k, 0), n - k)
        j = i + k
        i, j = i[j >= fresh], j[j >= fresh]
        ok = (tree[i] == tree[j]) & (keys[i] == keys[j])
        ok &= np.minimum(sizes[i], sizes[j]) * 100 >= np.maximum(sizes[i], sizes[j]) * percent
        i, j = i[ok], j[ok]
        ok = (sketch[i] == sketch[j]).sum(1) >= enough
        left.append(i[ok])
        right.append(j[ok])
    a, b = np.concatenate(left), np.concatenate(right)
    return pa.RecordBatch.from_arrays(
        [
            prints.take(pa.array(a)), prints.take(pa.array(b)), pa.nulls(len(a), pa.int32()),
            pa.nulls(len(a), pa.binary()), pa.nulls(len(a), pa.int64()),
        ],
        ["a", "b", "tree", "key", "n"],
    )


def _meetings(table: pa.Table, groups: np.ndarray, enough: int, percent: int) -> pa.RecordBatch:
    """Pairs of a group of rows (equal columns of ``groups``) that pass all filters."""
    n = table.num_rows
    prints = _flat(table, "fp")
    sizes, pos, side = (_flat(table, c).to_numpy().astype(np.int64) for c in ("n", "pos", "side"))
    cross = _flat(table, "cross").to_numpy(zero_copy_only=False)
    roots = pc.coalesce(_flat(table, "root"), prints).dictionary_encode().indices.to_numpy()
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(n, SKETCH)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    new = np.append(True, (groups[:, 1:] != groups[:, :-1]).any(0))
    group = np.cumsum(new)
    at, k = np.arange(n), 1
    while True:
        at = at[at < n - k]
        at = at[group[at] == group[at + k]]
        if not len(at):
            break
        i, j = at, at + k
        ok = (roots[i] != roots[j]) & (~cross[i] | (side[i] != side[j]))
        i, j = i[ok], j[ok]
        x, y = sizes[i], sizes[j]
        needed = -(-(x + y) * percent // (100 + percent))
        ok = np.minimum(x, y) * 100 >= np.maximum(x, y) * percent
        ok &= np.minimum(x - pos[i], y - pos[j]) >= needed
        i, j = i[ok], j[ok]
        ok = (sketch[i] == sketch[j]).sum(1) >= enough
        left.append(i[ok])
        right.append(j[ok])
        k += 1
    a, b = np.concatenate(left), np.concatenate(right)
    return pa.RecordBatch.from_arrays([prints.take(pa.array(a)), prints.take(pa.array(b))], ["a", "b"])
