"""Segments of daily series against all possible divisions."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest

from gripelens.operators import breaks


def brute(n, total, strength, min_days):
    """Least cost over all divisions, and the divisions within rounding of it."""
    mean = [t / k / 1e6 if k else 0.0 for k, t in zip(n, total)]
    full = [i for i, k in enumerate(n) if k]
    near = [(mean[b] - mean[a]) ** 2 / (1 / n[a] + 1 / n[b]) for a, b in zip(full, full[1:])]
    penalty = strength * (sum(near) / len(near) if near else 0) * math.log(max(len(n), 2))

    def cost(a, b):
        w = sum(n[a:b])
        m = sum(n[i] * mean[i] for i in range(a, b)) / w
        return sum(n[i] * (mean[i] - m) ** 2 for i in range(a, b))

    found = {}
    for k in range(len(full)):
        for inner in itertools.combinations(full[1:], k):
            ends = [0, *inner, len(n)]
            parts = list(zip(ends, ends[1:]))
            if k and min(b - a for a, b in parts) < min_days:
                continue
            found[tuple(ends[:-1])] = sum(cost(a, b) for a, b in parts) + penalty * k
    least = min(found.values())
    return {s for s, c in found.items() if c <= least + 1e-7}


def test_best_division_of_short_series():
    rnd = random.Random(5)
    for case in range(150):
        size = rnd.randint(1, 11)
        n = [rnd.choice([0, 1, 3, 8]) for _ in range(size)]
        n[0] = n[-1] = rnd.randint(1, 5)
        step = rnd.randint(0, size)
        total = [k * (rnd.randint(0, 400_000) + 900_000 * (i >= step)) for i, k in enumerate(n)]
        strength, least = rnd.choice([0.2, 1.0, 3.0]), rnd.randint(1, 4)
        got = breaks.best_starts(np.array(n), np.array(total), strength, least)
        assert tuple(got) in brute(n, total, strength, least), case


def test_constant_series_has_no_break():
    n = np.array([2, 0, 3, 1, 4, 1])
    assert breaks.best_starts(n, n * 500_000, 3.0, 1) == [0]


def test_gaps_nulls_and_an_empty_table(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [("a", day + dt.timedelta(days=d), 1.0 if d >= 20 else 0.01 * (d % 2)) for d in range(30) if d not in (7, 8, 20)]
    rows += [(None, day, 0.5), ("a", None, 0.5), ("a", day, None), ("a", day, float("nan")), ("b", day, 0.25), ("b", day, 0.75)]
    df = spark.createDataFrame(rows, "platform string, event_ts timestamp, x double").repartition(5)
    got = {(r.platform, r.segment): r for r in breaks.trend_breaks(df, "x").collect()}
    assert set(got) == {("a", 1), ("a", 2), (None, 1), ("b", 1)}
    a, b = got["a", 1], got["a", 2]
    assert (a.first_day, a.last_day, a.days, a.n) == (dt.date(2024, 1, 1), dt.date(2024, 1, 21), 21, 18)
    assert (b.first_day, b.last_day, b.days, b.n, b.level) == (dt.date(2024, 1, 22), dt.date(2024, 1, 30), 9, 9, 1.0)
    assert a.shift is None and b.shift == pytest.approx(1.0 - a.level)
    assert (got["b", 1].level, got["b", 1].n, got["b", 1].days) == (0.5, 2, 1)
    assert breaks.trend_breaks(df.limit(0), "x").count() == 0
    with pytest.raises(ValueError):
        breaks.trend_breaks(df, "x", min_days=0)
