"""Merkle manifest of a table: digests of rows, a tree of them per group, a tree of the groups.

Tree. Within a group the leaves ascend by key; every FANOUT consecutive nodes of a level (the
last run may be shorter, even one) become the digest of their concatenation, until one is left,
the group's subroot. Subroots, in the groups' bytewise order (null first), become the root in
the same way. Digests are lower-case hex sha256, and it is their hex text that is hashed.

Places in a group come from one range sort: a row's place is its number within its sorted
partition plus what the partitions before hold of its group, a table of one row for each
partition and group. No group is gathered, whatever its share of the rows.

Proofs, by pointer jumping. Every inner node starts with a pointer to its parent and one segment,
the siblings to its left and right in its run. A self-join replaces the pointer by the pointer's
pointer and appends that node's segments, so the distance covered doubles: after
log2(height) joins all nodes hold the way to the root. Leaves of a run differ in their
first segment only, so a run is one row until the end: joins move a sixteenth of the leaves.
Only nodes high enough to be pointed at take part as targets; they are broadcast
within a measured bound, else copied under salts, since many nodes share an ancestor.

Rows: a null field is hashed as ``-``. Null keys come first; rows with equal keys are ordered by
their digest, and rows equal in all fields are leaves of their own. An empty table has no root
and gives no rows. Columns other than those named are ignored, so clashing names do no harm.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gripelens.runtime import lookup_join, materialise

BITS = 4  # a run has 2^BITS nodes
FANOUT = 1 << BITS
_TOP = "t"  # the tree of the groups; trees within groups are "" (null) or "s" and the group's name


def field_text(value: Column) -> Column:
    """``-`` for null, else byte length, colon, text (numbers in decimal)."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def _joined(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ""), 256)


def _beside(digests: Column, at: Column) -> Column:
    """Siblings of the node at place ``at`` of a run, left and right of it."""
    return F.struct(
        F.array_join(F.slice(digests, 1, at), "").alias("left"),
        F.array_join(F.slice(digests, at + 2, F.size(digests)), "").alias("right"),
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof (segments from the leaf upwards) lead to."""
    return F.aggregate(proof, leaf, lambda low, s: F.sha2(F.concat(s["left"], low, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return _joined(F.transform(proof, lambda s: F.concat(s["left"], s["right"])))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos`` (from 0, by ``order`` within ``tree``) and ``n`` (rows of the tree)."""
    keys = ["tree", *order]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    numbered = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    numbered = numbered.withColumn("_part", F.shiftright("_at", 33))
    parts = numbered.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    tree = W.partitionBy("tree")
    before = F.coalesce(F.sum("_rows").over(tree.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select(
        "tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(tree).alias("n")
    )
    return (
        lookup_join(numbered, materialise(offsets, "merkle-offsets"), ["tree", "_part"], spread_by="_at")
        .withColumn("pos", F.col("_at") + F.col("_shift"))
        .drop("_at", "_part", "_shift")
    )


def _id(tree, level, index) -> Column:
    return F.struct(
        F.lit(tree).alias("tree") if isinstance(tree, str) else tree.alias("tree"),
        F.lit(level).cast("int").alias("level"),
        F.lit(index).cast("bigint").alias("index"),
    )


def _runs(nodes: DataFrame, name: str) -> DataFrame:
    """Next level of ``nodes`` (tree, pos, n, node, digest): one row a run, ``kids`` in order."""
    kids = F.array_sort(F.collect_list(F.struct("pos", "node", "digest")))
    grouped = nodes.groupBy("tree", F.shiftright("pos", BITS).alias("run")).agg(kids.alias("kids"), F.first("n").alias("n"))
    parts = F.transform("kids", lambda k: k["digest"])
    return materialise(
        grouped.select(
            "tree", F.col("run").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"), "kids", _joined(parts).alias("digest")
        ),
        name,
    )


def _levels(nodes: DataFrame, level: int, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """All levels above ``nodes`` of ``level``, and the tables that hold the trees' tops."""
    ups, tops = [], []
    while True:
        tops.append(nodes.where("n = 1").select("tree", "node", "digest"))
        if most <= 1:
            return ups, tops
        level, most = level + 1, -(-most // FANOUT)
        up = _runs(nodes.where("n > 1"), f"merkle-level-{level}").withColumn("node", _id(F.col("tree"), level, F.col("pos")))
        ups.append(up)
        nodes = up


def _links(up: DataFrame) -> DataFrame:
    """(node, next, path) of the nodes below the rows of a level."""
    digests = F.transform("kids", lambda k: k["digest"])
    return up.select(F.posexplode("kids").alias("at", "kid"), F.col("node").alias("next"), digests.alias("digests")).select(
        "kid.node", "next", F.array(_beside(F.col("digests"), F.col("at"))).alias("path")
    )


def _jumped(links: DataFrame, root: Column, height: int, below: int) -> DataFrame:
    """(node, path): the segments from every node to the root. ``below``: levels under the top tree."""
    reach = 1
    while reach < height:
        level = F.col("node.level") + F.when(F.col("node.tree") == _TOP, below).otherwise(0)
        targets = links.where(level > reach).select(
            F.col("node").alias("next"), F.col("next").alias("_next"), F.col("path").alias("_path")
        )
        going = lookup_join(links.where(F.col("next") != root), targets, "next", spread_by="node")
        links = materialise(
            links.where(F.col("next") == root).unionByName(
                going.select("node", F.col("_next").alias("next"), F.concat("path", "_path").alias("path"))
            ),
            "merkle-jump",
        )
        reach *= 2
    return links.select("node", "path")


def prove(leaves: DataFrame, group: str, key: str, leaf: str = "leaf", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, leaf, *carry, subroot, root, proof) for every row of ``leaves``.

    ``leaf`` names the rows' digests; ``carry`` names small columns that go along. ``proof`` is an
    array of (left, right), the siblings from the leaf's level upwards, as ``fold`` takes it.
    """
    tree = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("s"), F.col(group).cast("string")))
    named = [F.col(key).alias("key"), F.col(leaf).alias("digest"), *[F.col(c).alias(f"c_{c}") for c in carry]]
    rows = _placed(materialise(leaves.select(tree.alias("tree"), *named), "merkle-leaves"), ["key", "digest"])
    kids = F.array_sort(F.collect_list(F.struct("pos", "digest", "key", *[f"c_{c}" for c in carry])))
    runs = rows.groupBy("tree", F.shiftright("pos", BITS).alias("pos")).agg(kids.alias("kids"), F.first("n").alias("n"))
    lone = F.col("n") == 1
    own = F.when(lone, F.col("kids")[0]["digest"]).otherwise(_joined(F.transform("kids", lambda k: k["digest"])))
    runs = materialise(
        runs.select("*", own.alias("digest"), _id(F.col("tree"), F.when(lone, 0).otherwise(1), F.col("pos")).alias("node")),
        "merkle-runs",
    )
    most = runs.agg(F.max("n").alias("n")).first()["n"]
    if not most:
        return leaves.select(*[F.col(c) for c in (key, leaf, *carry)]).withColumns(
            {"subroot": F.lit(None).cast("string"), "root": F.lit(None).cast("string"),
             "proof": F.array().cast("array<struct<left:string,right:string>>")}
        )
    first = runs.select("tree", "pos", F.ceil(F.col("n") / FANOUT).alias("n"), "node", "digest")
    inner, tops = _levels(first, 1, -(-most // FANOUT))
    below = len(inner) + 1
    subroots = materialise(reduce(DataFrame.unionByName, tops), "merkle-subroots")
    heads = subroots.select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), "node", "digest")
    outer, ends = _levels(_placed(heads, ["name"]), 0, subroots.count())
    found = reduce(DataFrame.unionByName, ends).first()
    root = _id(found["node"]["tree"], found["node"]["level"], found["node"]["index"])
    paths = runs.select(F.col("node")).limit(0).withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
    if inner or outer:
        links = materialise(reduce(DataFrame.unionByName, [_links(up) for up in [*inner, *outer]]), "merkle-links")
        paths = _jumped(links, root, len(inner) + len(outer), below)
    whole = lookup_join(runs, subroots.select("tree", F.col("digest").alias("subroot")), "tree", spread_by="node")
    whole = whole.join(paths, "node", "left")
    digests = F.transform("kids", lambda k: k["digest"])
    each = whole.select(
        F.posexplode("kids").alias("at", "kid"), digests.alias("digests"), "n", "subroot",
        F.coalesce("path", F.array().cast("array<struct<left:string,right:string>>")).alias("path"),
    )
    beside = F.array(_beside(F.col("digests"), F.col("at")))
    return each.select(
        F.col("kid.key").alias(key),
        F.col("kid.digest").alias(leaf),
        *[F.col(f"kid.c_{c}").alias(c) for c in carry],
        "subroot",
        F.lit(found["digest"]).alias("root"),
        F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(beside, "path")).alias("proof"),
    )
