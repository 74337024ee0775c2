import numpy as np
import pytest
from pyspark.ml import PipelineModel

from gripelens.operators.encode import apply_encoding, class_weights, fit_one_hot, fit_scaler
from gripelens.operators.metrics import classification_report
from gripelens.operators.model import fit_classifier


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    n = 600
    a, b = rng.normal(5, 3, n), rng.normal(-1, 0.2, n)
    flag = rng.random(n) < 0.4
    y = (0.5 * (a - 5) - 6 * (b + 1) + flag - 1 + rng.logistic(0, 1, n) > 0).astype(int)
    rows = [(i, float(a[i]), float(b[i]), 7, bool(flag[i]), int(y[i])) for i in range(n)]
    df = spark.createDataFrame(
        rows, "review_id int, a double, b double, same int, flag boolean, negative_experience int"
    )
    return df.repartition(4).persist()


def newton(x, y, w, steps=60):
    """Minimiser of sum of weighted logistic losses + half the squared norm, free intercept."""
    z = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-z @ beta))
        gradient = z.T @ (w * (p - y)) + penalty @ beta
        hessian = z.T @ (z * (w * p * (1 - p))[:, None]) + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_coefficients_agree_with_newton(table, tmp_path):
    fitted = fit_classifier(table, ["a", "b", "same"], {"flag_ohe__": "flag"})
    assert fitted.names == ("flag_ohe__flag_True", "num_scaler__a", "num_scaler__b", "num_scaler__same")
    test_ids = {r.review_id for r in fitted.test.select("review_id").collect()}
    rows = [r for r in table.collect() if r.review_id not in test_ids]
    assert len(test_ids) == 120 and len(rows) == 480
    y = np.array([r.negative_experience for r in rows], float)
    numbers = np.array([[r.a, r.b] for r in rows])
    scaled = (numbers - numbers.mean(0)) / numbers.std(0)
    x = np.column_stack([[float(r.flag) for r in rows], scaled, np.zeros(len(rows))])
    weights = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta = newton(x, y, weights)
    got = {r.feature: r.coef for r in fitted.coefficients().collect()}
    assert [got[n] for n in fitted.names] == pytest.approx(list(beta[:-1]), abs=1e-5)
    assert got["num_scaler__same"] == 0.0
    listed = [r.coef for r in fitted.coefficients().collect()]
    assert listed == sorted(listed)

    predicted = fitted.predictions().select("review_id", "prediction").collect()
    fitted.pipeline.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(table)
    reloaded = {r.review_id: r.prediction for r in again.select("review_id", "prediction").collect()}
    assert all(reloaded[r.review_id] == r.prediction for r in predicted)
    report = {r["class"]: r for r in classification_report(fitted.predictions()).collect()}
    assert report["accuracy"].support == 120 and report["accuracy"].f1 > 0.7


@pytest.mark.parametrize("kind", ["tree", "forest"])
def test_tree_models_report_importances(table, kind):
    rows = fit_classifier(table, ["a", "b", "same"], {"flag_ohe__": "flag"}, kind=kind).importances().collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert {r.feature: r.importance for r in rows}["num_scaler__same"] == 0.0


def test_one_outcome_is_refused(table):
    with pytest.raises(ValueError):
        fit_classifier(table.where("negative_experience = 1"), ["a"], {})


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (3.0, 5)], "x double, c int")
    rows = apply_encoding(df, fit_scaler(df, ["x", "c"])).collect()
    assert [r.num_scaler__x for r in rows] == pytest.approx([-(1.5**0.5), 0, 1.5**0.5])
    assert [r.num_scaler__c for r in rows] == [0, 0, 0]


def test_one_hot_drops_the_first_of_two_only(spark):
    rows = [("", "x'y"), ("Early Access Review", "b\\c"), ("", "a.b")]
    df = spark.createDataFrame(rows, "e string, k string")
    encoded = fit_one_hot(df, {"e__": "e", "k__": "k"})
    assert [e.name for e in encoded] == ["e__e_Early Access Review", "k__k_a.b", "k__k_b\\c", "k__k_x'y"]
    got = [tuple(r) for r in apply_encoding(df, encoded).collect()]
    assert got == [(0, 0, 0, 1), (1, 0, 1, 0), (0, 1, 0, 0)]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "negative_experience int")
    rows = {r.negative_experience: (r.n, r.weight) for r in class_weights(df).collect()}
    assert rows == {1: (1, 2.0), 0: (3, pytest.approx(2 / 3))}


def test_report_by_hand(spark):
    pairs = [(1, 1.0)] * 3 + [(1, 0.0)] + [(0, 1.0)] * 2 + [(0, 0.0)] * 4
    df = spark.createDataFrame(pairs, "label int, prediction double")
    got = {r["class"]: tuple(r)[1:] for r in classification_report(df).collect()}
    assert got["1"] == pytest.approx((3 / 5, 3 / 4, 2 / 3, 4))
    assert got["0"] == pytest.approx((4 / 5, 4 / 6, 8 / 11, 6))
    assert got["accuracy"] == pytest.approx((0.7, 0.7, 0.7, 10))
    assert got["macro avg"][:2] == pytest.approx((0.7, (3 / 4 + 4 / 6) / 2))
    assert got["weighted avg"][1] == pytest.approx(0.7)


def test_report_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "label int, prediction double")
    got = {r["class"]: tuple(r)[1:] for r in classification_report(df).collect()}
    assert got["1"] == (0.0, 0.0, 0.0, 1)
