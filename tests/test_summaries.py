"""Mergeable summaries against all values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gripelens.operators import summaries

P = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
SCHEMA = "platform string, day int, v double"


def quantile(values, p):
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[min(math.floor(at) + 1, len(values) - 1)]
    return low if low == high else low + (high - low) * (at - math.floor(at))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(6)
    out = [("wide", i % 9, rnd.choice([-1, 1]) * 10 ** rnd.uniform(-12, 12)) for i in range(500)]
    out += [("common", i % 4, rnd.choice([0.0, 0.0, 0.0, rnd.random()])) for i in range(400)]
    return out + [("one", 3, -2.5), ("wide", 1, None), (None, 1, 1.0), ("wide", None, 1.0), ("one", 1, float("nan"))]


def test_days_merge_to_the_summary_of_the_whole_and_refine_exactly(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).where("day IS NOT NULL AND NOT isnan(coalesce(v, 0))").repartition(6)
    days = [summaries.summarise(df.where(f"day = {d}"), ["platform"], "v") for d in range(9)]
    parts = days[0]
    for more in days[1:]:
        parts = parts.unionByName(more)
    merged = summaries.merge(parts, ["platform"])
    whole = summaries.merge(summaries.summarise(df.withColumn("day", F.lit(0)), ["platform"], "v"), ["platform"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))

    values = {}
    for p, d, x in rows:
        if p and d is not None and x is not None and not math.isnan(x):
            values.setdefault(p, []).append(x)
    bounds = {(r.platform, r.p): r for r in summaries.approximate(merged, ["platform"], P).collect()}
    exact = {(r.platform, r.p): r for r in summaries.refine(df, merged, ["platform"], "v", P).collect()}
    assert len(bounds) == len(exact) == len(P) * len(values)
    for (platform, p), r in exact.items():
        want = quantile(sorted(values[platform]), p)
        assert r.rows == len(values[platform]) and r.quantile == pytest.approx(want, rel=1e-12, abs=0)
        assert bounds[platform, p].low <= r.quantile <= bounds[platform, p].high


def test_buckets_keep_the_order_and_the_stated_error(spark):
    xs = sorted([0.0, -1e-310, float("inf"), float("-inf"), *(s * 10.0**e for s in (-1, 1) for e in (-200, -3, 0, 0.01, 5, 200))])
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", summaries.bucket(F.col("x")).alias("b"))
    found = [r.b for r in df.orderBy("x").collect()]
    assert found == sorted(found) and len(set(found)) == len(xs) - 1
    steps = spark.range(20_000).selectExpr("1 + id / 5000 AS x").withColumn("b", summaries.bucket(F.col("x")))
    worst = steps.groupBy("b").agg((F.max("x") / F.min("x")).alias("r")).agg(F.max("r")).first()[0]
    assert worst <= summaries.BASE + 1e-9


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    merged = summaries.merge(summaries.summarise(df, ["platform"], "v"), ["platform"])
    assert merged.count() == 0 and summaries.refine(df, merged, ["platform"], "v", P).count() == 0
