"""Classification report from a confusion count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def classification_report(
    predictions: DataFrame, label_col: str = "label", prediction_col: str = "prediction"
) -> DataFrame:
    """Rows per class, then 'accuracy', 'macro avg' and 'weighted avg'.

    The data is scanned once; after the confusion count everything is a few rows.
    Predictions and labels are compared as integers.
    """
    confusion = predictions.groupBy(
        F.col(label_col).cast("int").alias("actual"), F.col(prediction_col).cast("int").alias("guess")
    ).agg(F.count("*").alias("n"))
    hit = F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")

    def part(cls: Column, support: Column, tp: Column, predicted: Column) -> Column:
        return F.struct(
            cls.alias("cls"), support.alias("support"), tp.alias("tp"), predicted.alias("predicted")
        )

    per_class = (
        confusion.select(
            F.inline(
                F.array(
                    part(F.col("actual"), F.col("n"), hit.cast("bigint"), zero),
                    part(F.col("guess"), zero, zero, F.col("n")),
                )
            )
        )
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "tp", "predicted")])
        .withColumns(
            {
                "precision": _ratio(F.col("tp"), F.col("predicted")),
                "recall": _ratio(F.col("tp"), F.col("support")),
            }
        )
        .withColumn(
            "f1",
            _ratio(
                F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
    )
    scores = ("precision", "recall", "f1")

    def line(name: Column, values: list[Column], support: Column) -> Column:
        return F.struct(
            name.alias("class"),
            *[v.alias(s) for v, s in zip(values, scores)],
            support.alias("support"),
        )

    total = F.sum("support")
    accuracy = _ratio(F.sum("tp"), total)
    lines = per_class.agg(
        F.collect_list(line(F.col("cls").cast("string"), [F.col(s) for s in scores], F.col("support"))).alias("classes"),
        F.array(
            line(F.lit("accuracy"), [accuracy, accuracy, accuracy], total),
            line(F.lit("macro avg"), [F.avg(s) for s in scores], total),
            line(
                F.lit("weighted avg"),
                [_ratio(F.sum(F.col(s) * F.col("support")), total) for s in scores],
                total,
            ),
        ).alias("summary"),
    )
    return lines.select(F.inline(F.concat("classes", "summary")))
