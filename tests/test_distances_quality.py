"""Running totals, distances between distributions and curves against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from gripelens.operators.distances import platform_distances
from gripelens.operators.quality import areas, curve
from gripelens.operators.running import running_totals


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_across_partitions(spark, descending):
    rows = [(float(x), x % 7, 1) for x in random.Random(1).sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "x double, a int, b int").repartition(9)
    got = running_totals(df, "x", ["a", "b"], descending, next_col="after").collect()
    a = b = 0
    order = sorted(got, key=lambda r: -r.x if descending else r.x)
    for i, r in enumerate(order):
        assert (r.a_before, r.b_before, r.after) == (a, b, order[i + 1].x if i + 1 < len(order) else None)
        a, b = a + r.a, b + r.b


def plain_distance(a, b):
    values = sorted(set(a) | set(b))
    ks = area = 0.0
    for x, after in zip(values, [*values[1:], None]):
        gap = abs(sum(v <= x for v in a) / len(a) - sum(v <= x for v in b) / len(b))
        ks = max(ks, gap)
        area += gap * (after - x) if after is not None else 0
    return ks, area


def test_distances_equal_a_plain_version(spark):
    rnd = random.Random(2)
    samples = {
        "a": [rnd.gauss(0, 1) for _ in range(200)],
        "b": [rnd.gauss(0.5, 2) for _ in range(90)],
        "c": [0.0] * 300 + [-0.0, 1.0],  # a common value
        "d": [5.0],
    }
    rows = [(p, x) for p, xs in samples.items() for x in xs] + [("a", None), (None, 1.0), ("b", float("nan"))]
    got = platform_distances(spark.createDataFrame(rows, "platform string, v double").repartition(5), "v").collect()
    assert len(got) == 6
    for r in got:
        ks, area = plain_distance(samples[r.platform_a], samples[r.platform_b])
        assert (r.ks, r.wasserstein) == (pytest.approx(ks), pytest.approx(area))
        assert (r.n_a, r.n_b) == (len(samples[r.platform_a]), len(samples[r.platform_b]))


def test_distances_of_few_platforms(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "platform string, v double")
    assert [(r.ks, r.wasserstein) for r in platform_distances(df, "v").collect()] == [(0.0, 0.0)]
    assert platform_distances(df.where("platform = 'a'"), "v").count() == 0
    assert platform_distances(df.limit(0), "v").count() == 0


def test_curves_equal_comparison_of_all_pairs(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([0.5, rnd.random()]), int(rnd.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame([*rows, (None, 1), (0.4, None), (float("nan"), 0)], "s double, negative_experience int")
    points = curve(df.repartition(6), "s")
    for r in points.collect():
        assert (r.true_positives, r.false_positives) == tuple(sum(s >= r.score and y == k for s, y in rows) for k in (1, 0))
    found = areas(points).first()
    ones, zeros = ([s for s, y in rows if y == k] for k in (1, 0))
    wins = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
    assert found.roc_auc == pytest.approx(wins / len(ones) / len(zeros))
    precision = sum(
        sum(y for s, y in rows if s == t) * sum(y for s, y in rows if s >= t) / sum(s >= t for s, _ in rows)
        for t in {s for s, _ in rows}
    )
    assert found.average_precision == pytest.approx(precision / len(ones))


def test_curves_of_one_class_and_no_rows(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert tuple(areas(curve(df, "s", "y")).first()) == (2, 0, None, 1.0)
    assert tuple(areas(curve(df.limit(0), "s", "y")).first()) == (0, 0, None, None)
    assert curve(df.withColumn("score", F.lit("mine")), "s", "y").columns[0] == "score"
