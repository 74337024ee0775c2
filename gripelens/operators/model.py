"""Per-platform classifiers on Spark ML.

The objective is the usual one of an L2-penalised, class-weighted logistic
regression with C = 1: sum of weighted losses plus half the squared norm,
intercept free. Spark averages the loss, hence ``regParam = 1 / (C * sum of weights)``;
inputs are scaled beforehand, so Spark's own standardisation is off.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelens.operators.encode import Encoded, fit_one_hot, fit_scaler, weight_column
from gripelens.operators.sampling import plan_split

SEED = 33  # fixed values
TEST_FRACTION = 0.2
MAX_ITER = 2000
PARTITION_BYTES = 32 * 1024 * 1024
COEF_SCHEMA = "feature string, coef double"


@dataclass(frozen=True)
class FittedModel:
    """A fitted preprocessing-plus-classifier pipeline and the rows it was judged on."""

    pipeline: PipelineModel
    names: tuple[str, ...]
    test: DataFrame
    train: DataFrame | None = None  # with ``label`` and ``weight``

    def gradient(self) -> DataFrame:
        """(feature, rows, gradient): derivative of a logistic model's objective by each coefficient,
        over the training rows and divided by their number; zero at the optimum."""
        model = self.pipeline.stages[-1]
        x = vector_to_array(F.col("features"))
        beta = [float(b) for b in model.coefficients]
        rows = self.train
        for stage in self.pipeline.stages[:-1]:
            rows = stage.transform(rows)
        rows = rows.select("label", "weight", x.alias("x"))
        z = F.lit(float(model.intercept))
        for i, b in enumerate(beta):
            z = z + F.get("x", F.lit(i)) * F.lit(b)
        error = F.col("weight") * (1 / (1 + F.exp(-z)) - F.col("label"))
        named = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(b).alias("beta")) for n, b in zip(self.names, beta)])
        each = rows.select(error.alias("error"), F.posexplode("x").alias("at", "value"))
        summed = each.groupBy("at").agg(F.count("*").alias("rows"), F.sum(F.col("error") * F.col("value")).alias("g"))
        own = F.get(named, F.col("at"))
        return summed.select(own["feature"].alias("feature"), "rows", ((F.col("g") + own["beta"]) / F.col("rows")).alias("gradient"))

    def coefficients(self) -> DataFrame:
        """(feature, coef), ascending by coefficient."""
        values = self.pipeline.stages[-1].coefficients.toArray()
        rows = sorted(
            ((n, float(v)) for n, v in zip(self.names, values)), key=lambda r: (r[1], r[0])
        )
        return self.test.sparkSession.createDataFrame(rows, COEF_SCHEMA)

    def importances(self) -> DataFrame:
        """(feature, importance) of a tree model, most important first."""
        values = self.pipeline.stages[-1].featureImportances.toArray()
        rows = sorted(
            ((n, float(v)) for n, v in zip(self.names, values)), key=lambda r: (-r[1], r[0])
        )
        return self.test.sparkSession.createDataFrame(rows, "feature string, importance double")

    def predictions(self) -> DataFrame:
        """Test rows with ``probability`` and ``prediction`` (threshold 0.5)."""
        return self.pipeline.transform(self.test)


def encoder_stages(encoded: Sequence[Encoded]) -> list:
    """Fitted preprocessing as savable pipeline stages. Inputs get neutral column
    names, because category values may contain any character."""
    inputs = [f"_x{i}" for i in range(len(encoded))]
    columns = ", ".join(f"{e.sql} AS {name}" for e, name in zip(encoded, inputs))
    return [
        SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
        VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"),
    ]


def logistic_regression(reg_param: float) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        regParam=reg_param,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=MAX_ITER,
        tol=1e-9,
    )


def fit_classifier(
    features: DataFrame,
    numeric: Sequence[str],
    categorical: Mapping[str, str],
    id_col: str = "review_id",
    label_col: str = "negative_experience",
    kind: str = "logistic",
    test_fraction: float = TEST_FRACTION,
    seed: int = SEED,
) -> FittedModel:
    """Split, fit preprocessing on the training part, fit the classifier.

    ``features`` is read several times: pass a materialised table. Only the columns
    the model uses are read.
    """
    used = [id_col, label_col, *numeric, *categorical.values()]
    table = features.select(*dict.fromkeys(used))
    is_test, sizes = plan_split(table, label_col, id_col, test_fraction, seed)
    train = table.where(~is_test)
    test = table.where(is_test).withColumn("label", F.col(label_col).cast("double"))
    if len(sizes) < 2:
        raise ValueError("training needs both outcomes")
    encoded = fit_one_hot(train, categorical) + fit_scaler(train, numeric)
    stages = encoder_stages(encoded)
    matrix = train.withColumns(
        {"label": F.col(label_col).cast("double"), "weight": weight_column(sizes, label_col)}
    )
    weighted = matrix
    for stage in stages:
        matrix = stage.transform(matrix)
    matrix = matrix.select("label", "weight", "features")
    # Every iteration is a pass over the cached matrix: few, well-filled partitions keep the
    # scheduling share small. This only ever lowers the number of partitions.
    rows = sum(sizes.values())
    matrix = matrix.coalesce(max(1, math.ceil(rows * (len(encoded) + 2) * 8 / PARTITION_BYTES)))
    if kind == "logistic":
        learner = logistic_regression(1.0 / rows)
    elif kind == "tree":
        learner = DecisionTreeClassifier(labelCol="label", weightCol="weight", seed=seed)
    elif kind == "forest":
        learner = RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=50, seed=seed)
    else:
        raise ValueError(f"unknown classifier: {kind}")
    matrix = matrix.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = learner.fit(matrix)
    finally:
        matrix.unpersist()
    return FittedModel(PipelineModel([*stages, fitted]), tuple(e.name for e in encoded), test, weighted)
