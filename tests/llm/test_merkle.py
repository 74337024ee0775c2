"""The Merkle manifest against a plain recursive tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gripelens.llm import merkle
from gripelens.llm.registry import ORACLES, QUERIES
from tests.compare import connect, difference, spark_table, sql_table


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes):
    """(top, siblings of every node from below, left and right)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // 16 * 16 : k // 16 * 16 + 16]
            proofs[i].append(("".join(run[: k % 16]), "".join(run[k % 16 + 1 :])))
        at = [k // 16 for k in at]
        nodes = [digest("".join(nodes[b : b + 16])) for b in range(0, len(nodes), 16)]
    return nodes[0], proofs


def plain(rows):
    """key -> (subroot, root, proof) of (group, key, leaf) rows with distinct keys."""
    groups = sorted({g for g, _, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    sub, below = {}, {}
    for g in groups:
        own = sorted((k, leaf) for h, k, leaf in rows if h == g)
        sub[g], proofs = climb([leaf for _, leaf in own])
        below.update({k: (g, p) for (k, _), p in zip(own, proofs)})
    root, above = climb([sub[g] for g in groups])
    top = dict(zip(groups, above))
    return {k: (sub[g], root, p + top[g]) for k, (g, p) in below.items()}


SHAPES = {
    "one row": {"a": 1},
    "one group of a run": {"a": 16},
    "lone rows": {f"g{i}": 1 for i in range(20)},
    "short last run": {None: 1, "": 17, "é": 33, "z": 273, "Z": 2},
    "many groups": {f"h{i}": i % 4 + 1 for i in range(300)},
}


@pytest.mark.parametrize("shape", SHAPES)
def test_proofs_equal_a_plain_tree(spark, shape):
    rows, key = [], 0
    for g, n in SHAPES[shape].items():
        for _ in range(n):
            key += 7
            rows.append((g, key, digest(str(key))))
    df = spark.createDataFrame(rows, "grp string, id bigint, leaf string").repartition(5)
    want = plain(rows)
    proved = merkle.prove(df, "grp", "id")
    got = proved.withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.subroot, r.root, [tuple(s) for s in r.proof]) == want[r.id]
        assert r.folded == r.root


def test_fields_tell_nulls_empty_texts_and_lengths_apart(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "é-")], "id bigint, t string").withColumn(
        "leaf", merkle.row_digest(F.col("id"), F.col("t"))
    )
    assert {r.id: r.leaf for r in df.collect()} == {
        1: digest("1:1-"), 2: digest("1:20:"), 3: digest("1:33:é-")
    }


def test_repeated_rows_null_keys_clashing_columns_and_empty_tables(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", None, "y"), ("a", 1, "w")]
    df = spark.createDataFrame(rows, "source string, id bigint, leaf string")
    df = df.withColumn("root", F.lit("mine")).withColumn("pos", F.lit(3)).withColumn("node", F.lit(0))
    got = merkle.prove(df, "source", "id", carry=("pos",)).collect()
    assert {r.root for r in got} == {digest("ywxx")} and [r.pos for r in got] == [3] * 4
    assert sorted(r.proof[0].left for r in got) == ["", "y", "yw", "ywx"]
    empty = merkle.prove(df.limit(0), "source", "id", carry=("pos",))
    assert empty.columns == ["id", "leaf", "pos", "subroot", "root", "proof"] and empty.count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    name = "op11_merkle_manifest"
    got = spark_table(QUERIES[name](spark, sf_dir))
    assert difference(got, sql_table(connect(sf_dir), ORACLES[name])) == ""
