"""Exact top-k inner products by best-first search in M-trees.

Inner products become distances by one more coordinate: with M the largest norm of a tree,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the
largest products are the nearest neighbours.

Index. Rows are dealt by a hash of their id to trees of about TREE_ROWS rows, and each
tree is loaded into pages: a page has a pivot, a covering radius, and its entries' distances
to the pivot. Inner pages list pages, leaves list vectors. Pages are rows of a table.

Search. Queries go to every tree in blocks of BLOCK queries; a task holds one tree and
one block. Pages wait in a heap by the least distance that pivot and radius leave
possible. Stored distances rule out entries by the triangle inequality before anything is
computed for them; what remains is scored in whole numbers. Bounds are widened by a
rounding margin and cut strictly, so that ties are found. A query's trees are merged by
score, then by smaller id.

Rows: vectors that are null or hold null or non-finite components take no part; vectors of
different length are never compared. Rows with a query's id count as its own and are no
candidates for it; of several rows with one query id the smallest vector asks. Equal
vectors under different ids all count; ties go to the smaller id. No vectors, no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelens.runtime import materialise

TREE_ROWS = 16_384
PAGE = 1024
FAN_OUT = 32
BLOCK = 4_096

_PAGES = (
    "tree int, dim int, page int, leaf boolean, radius double, top double, pivot binary, "
    "members binary, gaps binary, vectors binary"
)


def whole(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component, or null if the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(
        vector.isNotNull() & ~F.coalesce(bad, F.lit(False)),
        F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("bigint")),
    )


class _Loader:
    """Pages of one tree, bottom up by recursive nearest-pivot partition."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        norms = (vectors.astype(np.float64) ** 2).sum(1)
        self.top = float(norms.max())
        last = np.sqrt(np.maximum(self.top - norms, 0))
        self.points = np.column_stack([vectors.astype(np.float64), last])
        self.pages: list[dict] = []
        self.load(np.arange(len(ids)))

    def load(self, rows: np.ndarray) -> tuple[int, np.ndarray, float]:
        """(page, pivot, covering radius) over these rows; the page's number is its place."""
        number = len(self.pages)
        self.pages.append({})
        pivot = self.points[rows[self._middle(rows)]]
        reach = np.linalg.norm(self.points[rows] - pivot, axis=1)
        page = {"page": number, "radius": float(reach.max()), "pivot": pivot.tobytes(), "top": self.top}
        if len(rows) <= PAGE:
            page |= {"leaf": True, "members": self.ids[rows].tobytes(), "gaps": reach.tobytes()}
            page["vectors"] = self.vectors[rows].tobytes()
        else:
            below = [self.load(part) for part in self._parts(rows)]
            gaps = np.array([np.linalg.norm(p - pivot) for _, p, _ in below])
            numbers = np.array([n for n, _, _ in below], np.int64)
            page |= {"leaf": False, "members": numbers.tobytes(), "gaps": gaps.tobytes(), "vectors": b""}
        self.pages[number] = page
        return number, pivot, page["radius"]

    def _middle(self, rows: np.ndarray) -> int:
        centre = self.points[rows].mean(0)
        return int(np.linalg.norm(self.points[rows] - centre, axis=1).argmin())

    def _parts(self, rows: np.ndarray) -> list[np.ndarray]:
        """Rows by their nearest pivot, of up to FAN_OUT that lie far from each other."""
        count = min(FAN_OUT, -(-2 * len(rows) // PAGE))
        points = self.points[rows]
        far = np.full(len(rows), np.inf)
        best = np.zeros(len(rows), np.int64)
        chosen = 0
        for k in range(count):
            distance = np.linalg.norm(points - points[chosen], axis=1)
            best[distance < far] = k
            far = np.minimum(far, distance)
            chosen = int(far.argmax())
            if far[chosen] == 0:
                break
        parts = [rows[best == k] for k in range(count)]
        parts = [p for p in parts if len(p)]
        if len(parts) < 2 or max(map(len, parts)) > 0.9 * len(rows):
            return np.array_split(rows, min(FAN_OUT, -(-len(rows) // PAGE)))
        return parts


class _Tree:
    """Pages by number: (radius, members, gaps, vectors of a leaf or pivots of the pages below)."""

    def __init__(self, pages: pd.DataFrame):
        self.top = float(pages["top"].iloc[0])
        radius = dict(zip(pages["page"], pages["radius"]))
        pivots = {n: np.frombuffer(p) for n, p in zip(pages["page"], pages["pivot"])}
        self.first, self.reach = pivots[0], radius[0]
        self.pages = {}
        for p in pages.itertuples(index=False):
            members, gaps = np.frombuffer(p.members, np.int64), np.frombuffer(p.gaps)
            if p.leaf:
                below = np.frombuffer(p.vectors, np.int64).reshape(len(members), -1).astype(np.float64)
                self.pages[p.page] = (True, members, gaps, below, None)
            else:
                below = np.array([pivots[n] for n in members.tolist()])
                self.pages[p.page] = (False, members, gaps, below, np.array([radius[n] for n in members.tolist()]))

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best by score, then smaller id."""
        square = float(query @ query)
        place = np.append(query, 0.0)
        margin = 1e-7 * (1.0 + square + self.top)
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        reach, worst = np.inf, -np.inf  # distance and score of the k-th best so far
        here = float(np.linalg.norm(self.first - place))
        heap = [(max(0.0, here - self.reach), 0, here)]
        while heap:
            least, number, here = heapq.heappop(heap)
            if least > reach:
                break
            leaf, members, gaps, below, radii = self.pages[number]
            apart = np.abs(here - gaps)
            if not leaf:
                # The stored distance already rules a page out: its pivot is not looked at.
                open_ = np.flatnonzero(apart - radii <= reach)
                gap = np.sqrt(((below[open_] - place) ** 2).sum(1))
                bound = gap - radii[open_]
                for i in np.flatnonzero(bound <= reach).tolist():
                    heapq.heappush(heap, (max(0.0, float(bound[i])), int(members[open_[i]]), float(gap[i])))
                continue
            near = apart <= reach
            count = np.count_nonzero(near)
            if not count:
                continue
            if 4 * count < len(members):
                at = np.flatnonzero(near)
                found = below[at] @ query
                good = found >= worst
                at, found = at[good], found[good]
            else:
                found = below @ query
                at = np.flatnonzero(near & (found >= worst))
                found = found[at]
            if not len(at):
                continue
            names = members[at]
            other = names != own
            ids, scores = np.concatenate([ids, names[other]]), np.concatenate([scores, found[other]])
            if len(ids) > k:
                order = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[order], scores[order]
            if len(ids) == k:
                worst = scores.min()
                reach = np.sqrt(max(square + self.top - 2 * worst, 0.0) + margin)
        order = np.lexsort((ids, -scores))
        return ids[order], scores[order]


@dataclass(frozen=True)
class MetricIndex:
    """The page table and the number of trees."""

    pages: DataFrame
    trees: int

    @classmethod
    def build(cls, vectors: DataFrame) -> MetricIndex:
        """``vectors``: vec_id, vector (array of whole numbers); null vectors are left out."""
        rows = vectors.where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
        trees = max(1, -(-rows.count() // TREE_ROWS))
        dealt = rows.select(
            F.pmod(F.xxhash64("vec_id"), F.lit(trees)).cast("int").alias("tree"),
            F.size("vector").alias("dim"),
            "vec_id",
            "vector",
        )

        def load(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
            found = found.sort_values("vec_id", kind="stable")
            vectors = np.array(found["vector"].tolist(), np.int64).reshape(len(found), key[1])
            pages = pd.DataFrame(_Loader(found["vec_id"].to_numpy(np.int64), vectors).pages)
            return pages.assign(tree=key[0], dim=key[1])[[c.split()[0] for c in _PAGES.split(", ")]]

        pages = dealt.groupBy("tree", "dim").applyInPandas(load, _PAGES)
        return cls(materialise(pages, "metric-pages"), trees)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, vec_id, score): the k largest inner products of each query."""
        asked = (
            queries.where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
            .groupBy("vec_id").agg(F.min("vector").alias("vector"))
        )
        blocks = max(1, -(-asked.count() // BLOCK))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = self.pages.withColumn("block", every(blocks))
        right = asked.select(
            F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
            F.size("vector").alias("dim"),
            "vec_id",
            "vector",
        ).withColumn("tree", every(self.trees))
        key = ["tree", "dim", "block"]

        def find(pages: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(pages) and len(asked):
                tree = _Tree(pages)
                for query, vector in zip(asked["vec_id"].tolist(), asked["vector"]):
                    ids, scores = tree.search(np.asarray(vector, np.float64), query, k)
                    out.append(pd.DataFrame({"query_id": query, "vec_id": ids, "score": scores.astype(np.int64)}))
            return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
            find, "query_id bigint, vec_id bigint, score bigint"
        )
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")
