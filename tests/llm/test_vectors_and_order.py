import random

import numpy as np
import public_tokenizers
import pytest

from gripelens.llm import metric_tree
from gripelens.llm.byte_bpe import ByteBpe
from gripelens.llm.metric_tree import MetricIndex, whole
from gripelens.llm.training_order import Permutation, TrainingOrder, read_from, write_shards
from pyspark.sql import functions as F


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_a_bijection(size):
    p = Permutation(size, key=12)
    slots = p.slots(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size))
    assert (p.indices(slots) == np.arange(size)).all()


def test_shards_hold_every_token_once(spark, docs, tmp_path):
    bpe = ByteBpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = [f"text number {i} " * (i % 7) for i in range(80)] + [None, "", "word " * 5000]
    order = TrainingOrder(bpe, end_id=50256, length=32, per_shard=8)
    write_shards(order.shards(docs(texts)), str(tmp_path / "shards"))
    rows = read_from(spark, str(tmp_path / "shards"), 0, 8).collect()
    assert [r["shard"] for r in rows] == list(range(len(rows)))
    assert all(len(r["data"]) == r["sequences"] * 64 and r["first_slot"] == 8 * r["shard"] for r in rows)
    got = np.sort(np.concatenate([np.frombuffer(r["data"], "<u2") for r in rows]))
    ids, counts = bpe.encode(docs(texts)).selectExpr("sum(n_tokens)", "count_if(n_tokens > 0)").first()
    assert sum(r["filled"] for r in rows) == ids + counts
    want = np.sort(np.concatenate([np.array(r["ids"]) for r in bpe.encode(docs(texts)).collect()]))
    assert (got[got != 50256] == want).all()
    third = order.sequence(bytes(rows[0]["data"]), 3)
    assert len(third) == 32 and len(read_from(spark, str(tmp_path / "shards"), 17, 8).collect()) == len(rows) - 2
    assert order.shards(docs([])).count() == 0


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "TREE_ROWS", 150)
    rng = random.Random(8)
    vectors = {i: [rng.gauss(0, 0.3) for _ in range(6)] for i in range(400)}
    for i in range(50, 120):
        vectors[i] = vectors[50]  # ties and a hot vector
    rows = [(i, v) for i, v in vectors.items()]
    rows += [(1000, None), (1001, [float("nan")] * 6), (1002, [None] * 6), (1003, [1.0, 2.0]), (1020, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").select("vec_id", whole(F.col("embedding")).alias("vector"))
    index = MetricIndex.build(table)
    got = {}
    for r in index.search(table.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    ints = {i: np.floor(64 * np.array(v)).astype(int) for i, v in vectors.items()}
    for q in range(0, 400, 20):
        best = sorted(((-int(ints[q] @ v), i) for i, v in ints.items() if i != q))[:20]
        assert [got[q][k + 1] for k in range(20)] == [(i, -s) for s, i in best]
    assert got[1020] == {1: (1003, 64 * 64 * 3)} and 1000 not in got
    assert MetricIndex.build(table.limit(0)).search(table.limit(0), 20).count() == 0
