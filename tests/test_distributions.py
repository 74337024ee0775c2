import numpy as np
import pytest

from gripelens.operators import distributions as d


@pytest.fixture(scope="module")
def samples():
    """Groups of very different shape; 'hot' holds most rows and a single value half of them."""
    rng = np.random.default_rng(4)
    return {
        "hot": np.concatenate([np.zeros(4000), rng.normal(0, 1, 4000)]),
        "heavy": np.exp(rng.normal(0, 4, 500)) * rng.choice([-1, 1], 500),
        "counts": rng.integers(0, 40, 300).astype(float),
        "pair": np.array([3.0, 1.0]),
        "single": np.array([2.5]),
        "constant": np.full(50, -0.25),
    }


@pytest.fixture(scope="module")
def table(spark, samples):
    rows = [(g, float(x)) for g, xs in samples.items() for x in xs]
    return spark.createDataFrame(rows + [("hot", None), (None, 1.0)], "g string, v double").repartition(6)


def test_quantiles_are_exact(table, samples):
    probabilities = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
    counts = d.value_counts(table, ["g"], "v", digits=None)
    got = {r.g: r for r in d.group_quantiles(counts, ["g"], probabilities).collect()}
    assert set(got) == set(samples)
    for g, xs in samples.items():
        assert got[g].n_rows == len(xs)
        for i, p in enumerate(probabilities):
            assert got[g][f"q{i}"] == pytest.approx(np.quantile(xs, p), rel=1e-12, abs=1e-12), (g, p)


def test_small_golden(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4)], "g string, v double")
    row = d.group_quantiles(d.value_counts(df, ["g"], "v"), ["g"], (0.01, 0.5)).first()
    assert (row.q0, row.q1) == pytest.approx((1.03, 2.5))


def test_trimmed_summary(table, samples):
    got = {r.g: r for r in d.trimmed_distribution(table, ["g"], "v").collect()}
    for g, xs in samples.items():
        clipped = np.clip(xs, np.quantile(xs, 0.01), np.quantile(xs, 0.99))
        want = (len(xs), clipped.mean(), np.median(clipped), clipped.min(), clipped.max())
        row = got[g]
        assert (row.n, row["mean"], row.median, row["min"], row["max"]) == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_density_is_a_kernel_estimate_over_bins(table, samples):
    got = {}
    for r in d.violin_density(table, ["g"], "v", bins=20).collect():
        got.setdefault(r.g, {})[r.bin] = r
    for g in ("hot", "counts"):
        xs = samples[g]
        low, high = np.quantile(xs, 0.01), np.quantile(xs, 0.99)
        xs = np.clip(xs, low, high)
        width = (high - low) / 20
        bins = np.minimum(np.floor((xs - low) / width), 19).astype(int)
        h = xs.std(ddof=1) * len(xs) ** -0.2
        assert sum(r.n for r in got[g].values()) == len(xs)
        for b, row in got[g].items():
            assert row.n == (bins == b).sum()
            z = (bins - b) * width / h
            want = np.exp(-0.5 * z * z).sum() / (len(xs) * h * np.sqrt(2 * np.pi))
            assert row.density == pytest.approx(want, rel=1e-6)
    assert [(b, r.n, r.share, r.density) for b, r in got["constant"].items()] == [(0, 50, 1.0, None)]


def test_narrow_and_wide_ranges_are_exact(spark):
    for values in ([i * 1e-9 for i in range(1000)], [1.7e9 + i for i in range(1000)], [(-2.0) ** (i % 60) for i in range(1000)]):
        df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
        row = d.trimmed_distribution(df, ["g"], "v").first()
        lower, median, upper = np.quantile(values, [0.01, 0.5, 0.99])
        assert (row["min"], row["median"], row["max"]) == pytest.approx((lower, median, upper), rel=1e-12)
        assert row["mean"] == pytest.approx(np.clip(values, lower, upper).mean(), rel=1e-9)
