"""Quality of a score without a threshold: exact ROC and precision-recall curves.

Rows reduce to distinct scores with their positives and negatives, so that rows with one common
score are one step of the curve, counted by all tasks. ``running_totals`` orders the steps
from the highest score down. Weights are whole numbers of rows.

Rows without score or label are left out. If one class is missing, what needs it is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelens.operators.running import running_totals


def curve(df: DataFrame, score_col: str, label_col: str = "negative_experience") -> DataFrame:
    """(score, positives, negatives, true_positives, false_positives): one row per distinct score;
    the last two count the rows at or above it."""
    rows = df.select(F.col(score_col).cast("double").alias("score"), F.col(label_col).alias("_y"))
    rows = rows.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("_y").isNotNull())
    steps = rows.groupBy((F.col("score") + F.lit(0.0)).alias("score")).agg(
        F.count(F.when(F.col("_y") == 1, 1)).alias("positives"), F.count(F.when(F.col("_y") == 0, 1)).alias("negatives")
    )
    grown = running_totals(steps, "score", ["positives", "negatives"], descending=True)
    return grown.select(
        "score", "positives", "negatives",
        (F.col("positives_before") + F.col("positives")).alias("true_positives"),
        (F.col("negatives_before") + F.col("negatives")).alias("false_positives"),
    )


def areas(points: DataFrame) -> DataFrame:
    """(positives, negatives, roc_auc, average_precision) of the rows of ``curve``.

    Under the ROC curve steps are joined by lines (a tie counts half); average precision sums the
    precision at each step times the recall gained there. Sums under the ROC curve are
    integers.
    """
    tp, fp, p, n = (F.col(c) for c in ("true_positives", "false_positives", "positives", "negatives"))
    area = F.sum((n * (2 * tp - p)).cast("decimal(38,0)"))
    precision = F.sum(p * tp / (tp + fp))
    total = points.agg(F.sum(p).alias("positives"), F.sum(n).alias("negatives"), area.alias("_a"), precision.alias("_p"))
    both = 2.0 * F.col("positives") * F.col("negatives")
    return total.select(
        F.coalesce("positives", F.lit(0)).alias("positives"), F.coalesce("negatives", F.lit(0)).alias("negatives"),
        F.try_divide(F.col("_a").cast("double"), both).alias("roc_auc"),
        F.try_divide(F.col("_p"), F.col("positives")).alias("average_precision"),
    )
