"""Platforms fitted together against each platform fitted alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gripelens.operators.grouped_fit import INTERCEPT, fit_groups
from gripelens.operators.model import fit_classifier
from gripelens.operators.sampling import plan_split
from tests.test_model import newton

SCHEMA = "review_id int, platform string, a double, b double, same int, flag boolean, kind string, negative_experience int"


@pytest.fixture(scope="module")
def reviews(spark):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    # one platform has most rows, one a single flag, one a single category
    for platform, n in (("big", 900), ("mid", 200), ("noflag", 120), ("onekind", 80)):
        for _ in range(n):
            a, b, flag = rng.normal(2, 3), rng.exponential(2), bool(rng.random() < 0.4) and platform != "noflag"
            kind = "k0" if platform == "onekind" else [None, "k0", "k1", ""][int(rng.integers(4))]
            y = int(0.4 * a - 0.7 * b + flag + (kind == "k1") + rng.logistic() > 0)
            rows.append((i, platform, float(a), float(b), 7, flag, kind, y))
            i += 1
    rows += [(i, "oneclass", 1.0, 2.0, 7, True, "k0", 1), (i + 1, None, 1.0, 1.0, 7, True, "k0", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6).persist()


NUMERIC, CATEGORICAL = ["a", "b", "same"], {"f__": "flag", "k__": "kind"}


def test_each_platform_equals_its_own_fit(spark, reviews):
    trains, alone = [], {}
    for p in ("big", "mid", "noflag", "onekind"):
        own = reviews.where(F.col("platform") == p)
        is_test, _ = plan_split(own, "negative_experience", "review_id")
        trains.append(own.where(~is_test))
        found = fit_classifier(own, NUMERIC, CATEGORICAL).coefficients().collect()
        alone.update({(p, r.feature): r.coef for r in found})
    train = trains[0].union(trains[1]).union(trains[2]).union(trains[3])
    fit = fit_groups(train, NUMERIC, CATEGORICAL)
    got = {(r.platform, r.feature): r.coef for r in fit.coefs.collect()}
    assert {k for k in got if k[1] != INTERCEPT} == set(alone)
    for k, v in alone.items():
        assert got[k] == pytest.approx(v, abs=1e-5)
    assert got["onekind", "k__kind_k0"] == pytest.approx(0, abs=1e-9)
    gradients = fit.gradient().collect()
    assert {(r.platform, r.feature) for r in gradients} == set(got)
    assert max(abs(r.gradient) for r in gradients) < 1e-9
    sizes = {p: t.count() for p, t in zip(("big", "mid", "noflag", "onekind"), trains)}
    assert all(r.rows == sizes[r.platform] for r in gradients)


def test_equals_an_independent_newton_solution(reviews):
    own = reviews.where("platform = 'mid'").toPandas()
    numbers = own[["a", "b"]].to_numpy()
    x = np.column_stack([own["flag"].astype(float), (numbers - numbers.mean(0)) / numbers.std(0)])
    y = own["negative_experience"].to_numpy(float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    want = newton(x, y, w)
    got = {r.feature: r.coef for r in fit_groups(reviews, ["a", "b"], {"f__": "flag"}).coefs.where("platform = 'mid'").collect()}
    listed = [got[n] for n in ("f__flag_True", "num_scaler__a", "num_scaler__b", INTERCEPT)]
    assert listed == pytest.approx(list(want), abs=1e-8)


def test_platforms_that_cannot_be_fitted_and_empty_tables(reviews):
    fit = fit_groups(reviews, ["a"], {})
    assert {r.platform for r in fit.betas.collect()} == {"big", "mid", "noflag", "onekind"}
    assert fit_groups(reviews.limit(0), ["a"], {}).coefs.count() == 0


def test_separable_rows_converge(spark):
    rows = [(i, "p", float(i), 0.0, 0, True, "k", int(i > 50)) for i in range(100)]
    fit = fit_groups(spark.createDataFrame(rows, SCHEMA), ["a"], {})
    assert max(abs(r.gradient) for r in fit.gradient().collect()) < 1e-9
