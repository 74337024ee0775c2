"""Samples after additions against the sample of all rows."""

import hashlib
import random

import pytest

from gripelens.operators import growing_sample


def test_additions_in_any_order_give_the_sample_of_the_whole(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice("aaab"), f"t{i}") for i in range(500)] + [(900, None, "x")]
    df = spark.createDataFrame(rows, "id int, g string, t string")
    want = {}
    for i, g, _ in rows:
        want.setdefault(g, []).append((hashlib.md5(f"33:{i}".encode()).hexdigest(), i))
    want = {g: {i for _, i in sorted(own)[:20]} for g, own in want.items() if g}
    for parts in ([0, 1, 2, 3, 4], [4, 2, 2, 0, 1, 3]):
        kept = growing_sample.lowest(df.limit(0), "g", "id", 20)
        for p in parts:
            new = df.where(f"id % 5 = {p}").repartition(3)
            kept = spark.createDataFrame(growing_sample.add(kept, new, "g", "id", 20).collect(), df.schema)
        got = {}
        for r in kept.collect():
            got.setdefault(r.g, set()).add(r.id)
        assert got == want and kept.columns == df.columns


def test_limits(spark):
    df = spark.createDataFrame([(1, "a")], "id int, g string")
    assert growing_sample.add(df, df.limit(0), "g", "id", 5).collect() == df.collect()
    with pytest.raises(ValueError):
        growing_sample.lowest(df, "g", "id", 5000)
