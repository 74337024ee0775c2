"""Preprocessing fitted on training rows: scaling, one-hot columns, class weights.

Fitted values are a handful of numbers per column, so they become literals of the
plan: encoding is a projection in the scan stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Encoded:
    """One output column: its name and the SQL text that computes it."""

    name: str
    sql: str


def _number(value: float) -> str:
    return f"({float(value)!r}D)"


def _text(value: str | None) -> str:
    if value is None:
        return "cast(NULL AS string)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _as_category(column: str, dtype: str) -> str:
    if dtype == "boolean":
        return f"initcap(cast({_quoted(column)} as string))"
    return f"cast({_quoted(column)} as string)"


def category_text(df: DataFrame, column: str) -> Column:
    """The column's values as category names."""
    return F.expr(_as_category(column, df.schema[column].dataType.typeName()))


def fit_scaler(train: DataFrame, numeric: Sequence[str], prefix: str = "num_scaler__") -> list[Encoded]:
    """Zero mean, unit population deviation; a constant column becomes 0."""
    if not numeric:
        return []
    row = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(numeric)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(numeric)],
    ).first()
    out = []
    for i, c in enumerate(numeric):
        mean, deviation = row[f"m{i}"] or 0.0, row[f"s{i}"]
        # An average of n equal values may differ from them in the last bits.
        constant = not deviation or deviation <= 1e-12 * max(1.0, abs(mean))
        centred = f"(cast({_quoted(c)} as double) - {_number(mean)})"
        out.append(Encoded(prefix + c, f"{centred} / {_number(1.0 if constant else deviation)}"))
    return out


def categories(train: DataFrame, column: str) -> list[str | None]:
    """Distinct values as text, in alphabetical order; a missing value is a category, the last.

    One column of the matrix each, so their number is the model's width, which the driver must
    hold in any case; ``operators.grouped_fit`` fits platforms one by one instead of as columns.
    """
    dtype = train.schema[column].dataType.typeName()
    seen = train.select(F.expr(_as_category(column, dtype)).alias("v")).distinct().collect()
    return sorted((r["v"] for r in seen), key=lambda v: (v is None, v))


def fit_one_hot(
    train: DataFrame, categorical: Mapping[str, str], unknown: str = "zero"
) -> list[Encoded]:
    """``categorical`` maps a name prefix to a column. A two-valued column gives one
    indicator (of the later value); any other gives one per value. A value that training did not
    see has zeros everywhere, or fails the job with ``unknown="error"``."""
    out = []
    for prefix, column in categorical.items():
        dtype = train.schema[column].dataType.typeName()
        values = categories(train, column)
        value = _as_category(column, dtype)
        otherwise = "0.0D"
        if unknown == "error":
            known = " OR ".join(f"{value} <=> {_text(v)}" for v in values) or "false"
            message = _text(f"{column} holds a value that training did not see")
            otherwise = f"if({known}, 0.0D, cast(raise_error({message}) AS double))"
        if len(values) == 2:
            values = values[1:]
        for v in values:
            out.append(Encoded(f"{prefix}{column}_{v}", f"if({value} <=> {_text(v)}, 1.0D, {otherwise})"))
    return out


def apply_encoding(df: DataFrame, encoded: Sequence[Encoded], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[F.expr(e.sql).alias(e.name) for e in encoded])


def class_weights(df: DataFrame, label_col: str = "negative_experience") -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    sizes = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(1))  # over one row per class
    weight = F.sum("n").over(every) / (F.count("*").over(every) * F.col("n"))
    return sizes.select(label_col, "n", weight.alias("weight"))


def weight_column(sizes: Mapping[object, int], label_col: str) -> Column:
    """Balanced class weight as an expression, from known class sizes."""
    total, k = sum(sizes.values()), len(sizes)
    weight = F.lit(None).cast("double")
    for label, n in sizes.items():
        weight = F.when(F.col(label_col) == label, F.lit(total / (k * n))).otherwise(weight)
    return weight
