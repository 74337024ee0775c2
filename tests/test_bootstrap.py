"""The bootstrap against a plain loop, and its intervals against the usual formula."""

import hashlib
import random
import statistics

import pytest

from gripelens.operators.bootstrap import POISSON_STEPS, bootstrap_means


def weight(row_id, r, seed=33):
    digest = hashlib.md5(f"{seed}:{r // 8}:{row_id}".encode()).hexdigest()
    return sum(int(digest[4 * (r % 8) : 4 * (r % 8) + 4], 16) >= s for s in POISSON_STEPS)


def test_equals_a_plain_loop_for_any_partitioning(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.choice("aab"), round(rnd.gauss(1, 2), 3)) for i in range(400)]
    rows += [(1000, "c", 5.0), (1001, None, 1.0), (1002, "a", None), (1003, "a", float("nan"))]
    df = spark.createDataFrame(rows, "review_id int, g string, v double")
    one = {r.g: tuple(r) for r in bootstrap_means(df.repartition(1), ["g"], "v", replicates=20).collect()}
    many = {r.g: tuple(r) for r in bootstrap_means(df.repartition(9), ["g"], "v", replicates=20).collect()}
    assert one == many and set(one) == {"a", "b", "c"}
    for g in one:
        own = [(i, v) for i, k, v in rows if k == g and v is not None and v == v]
        means = []
        for r in range(20):
            weights = [weight(i, r) for i, _ in own]
            if sum(weights):
                means.append(sum(w * v for w, (_, v) in zip(weights, own)) / sum(weights))
        means.sort()

        def at(p):
            place = p * (len(means) - 1)
            low = int(place)
            return means[low] + (means[min(low + 1, len(means) - 1)] - means[low]) * (place - low)

        assert one[g] == (g, len(own), pytest.approx(statistics.fmean(v for _, v in own)), pytest.approx(at(0.025)), pytest.approx(at(0.975)))


def test_interval_has_the_width_of_the_standard_error(spark):
    rnd = random.Random(9)
    rows = [(i, "a", rnd.gauss(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "review_id int, g string, v double")
    r = bootstrap_means(df, ["g"], "v", replicates=200).first()
    assert (r.high - r.low) == pytest.approx(2 * 1.96 / 3000**0.5, rel=0.25) and r.low < 0.06 and r.high > -0.06
    assert bootstrap_means(df.limit(0), ["g"], "v").count() == 0
