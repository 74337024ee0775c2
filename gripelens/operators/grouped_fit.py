"""Logistic regressions of any number of platforms, fitted together.

Each platform has its own scaling, one-hot columns, class weights and coefficients; the
objective is that of ``operators.model`` (class-weighted losses plus half the squared norm,
intercept free). Newton's method runs for all platforms at once: in each step every task adds
up gradient and Gram matrix of its rows by platform, one small row per task and platform is
shuffled, and the tiny systems are solved where they meet. A platform with a third of all
rows is thus spread over all tasks. Platforms that have converged drop out; the driver
sees one number per step. Steps are tables in the shared folder.

Rows without a platform or an outcome, and platforms with one outcome only, take no part. A
missing category is a category of its own; missing numbers are an error. An empty table
gives no coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripelens.operators.encode import category_text
from gripelens.runtime import lookup_join, materialise

TOLERANCE, MAX_STEPS = 1e-8, 60
INTERCEPT = "(intercept)"
_MISSING = "\U0010ffff"  # sorts after all other categories
_HELD = 4096  # platforms whose sums a task keeps before it passes them on
_STATE = "platform string, beta array<double>, before array<double>, loss double, moved double"
_SUMS = "platform string, beta array<double>, before array<double>, loss double, sums array<double>"


@dataclass(frozen=True)
class GroupedFit:
    """``coefs``: (platform, feature, coef), the intercept as a feature. ``matrix`` and ``betas``
    hold the encoded rows and the coefficients as arrays in the order of ``names``."""

    names: tuple[str, ...]
    matrix: DataFrame
    betas: DataFrame
    coefs: DataFrame

    def gradient(self) -> DataFrame:
        """(platform, feature, rows, gradient): derivative of the objective at the coefficients by
        each of them, divided by the rows. Zero where, and only where, the fit is the optimum."""
        met = lookup_join(self.matrix, self.betas.select("platform", "beta", "active"), "platform", spread_by="w")
        dot = F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        error = F.col("w") * (1 / (1 + F.exp(-dot)) - F.col("y"))
        parts = met.select("platform", "beta", "active", "x", error.alias("error"))
        each = parts.select("platform", "beta", "active", "error", F.posexplode("x").alias("at", "value"))
        summed = each.groupBy("platform", "at").agg(
            F.count("*").alias("rows"), F.sum(F.col("error") * F.col("value")).alias("g"),
            F.first("beta").alias("beta"), F.first("active").alias("active"),
        )
        free = F.col("at") == len(self.names) - 1
        penalty = F.when(free, 0.0).otherwise(F.get("beta", F.col("at")))
        names = F.array(*[F.lit(n) for n in self.names])
        return summed.where(F.get("active", F.col("at"))).select(
            "platform", F.get(names, F.col("at")).alias("feature"), "rows",
            ((F.col("g") + penalty) / F.col("rows")).alias("gradient"),
        )


def _levels(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """All categories of each column, in order; one small aggregation."""
    if not columns:
        return {}
    row = train.agg(*[F.sort_array(F.collect_set(_category(train, c))).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def _category(df: DataFrame, column: str) -> Column:
    return F.coalesce(category_text(df, column), F.lit(_MISSING))


def _profile(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row per platform: class sizes, scaling, and the categories that occur."""
    y = F.col("y")
    measures = [F.sum(y).alias("ones"), F.count("*").alias("rows")]
    for i, c in enumerate(numeric):
        value = F.col(c).cast("double")
        measures += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    measures += [F.sort_array(F.collect_set(_category(train, c))).alias(f"c{i}") for i, c in enumerate(categorical)]
    return train.groupBy("platform").agg(*measures).where("ones > 0 AND ones < rows")


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Loss, gradient and Gram matrix of the rows of a task, by platform."""
    held: dict[str, list] = {}

    def flush() -> pa.RecordBatch:
        rows = [(k, *v) for k, v in held.items()]
        held.clear()
        columns = list(zip(*rows))
        kinds = [pa.string(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["platform", "beta", "before", "loss", "sums"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        platform = batch.column("platform").dictionary_encode()
        code = platform.indices.to_numpy(zero_copy_only=False)
        y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        for k, name in enumerate(platform.dictionary.to_pylist()):
            own = np.flatnonzero(code == k)
            at = int(own[0])
            if name not in held:
                state = [batch.column(c)[at].as_py() for c in ("beta", "before", "loss")]
                held[name] = [*state, np.zeros(1 + x.shape[1] + x.shape[1] ** 2)]
            rows, weight, mark = x[own], w[own], y[own]
            z = rows @ np.array(held[name][0])
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            loss = weight @ (np.logaddexp(0, z) - mark * z)
            gram = rows.T @ (rows * (weight * p * (1 - p))[:, None])
            held[name][3] += np.concatenate([[loss], rows.T @ (weight * (p - mark)), gram.ravel()])
        if len(held) > _HELD:
            yield flush()
    if held:
        yield flush()


def _step(strength: float):
    def run(parts: pd.DataFrame) -> pd.DataFrame:
        """Newton's step of one platform from the sums of all tasks; half the last step back if
        that made the objective larger."""
        first = parts.iloc[0]
        beta, total = np.array(first["beta"]), np.sum(np.stack(parts["sums"].to_list()), axis=0)
        size = len(beta)
        ridge = np.full(size, strength)
        ridge[-1] = 0.0
        loss = total[0] + 0.5 * float(ridge @ beta**2)
        if first["before"] is not None and loss > first["loss"] + 1e-9 * (1 + abs(first["loss"])):
            before, kept = np.array(first["before"]), float(first["loss"])
            new = (beta + before) / 2
            moved = float(np.abs(new - before).max())
        else:
            gradient = total[1 : 1 + size] + ridge * beta
            hessian = total[1 + size :].reshape(size, size) + np.diag(ridge + 1e-12)
            move = np.linalg.solve(hessian, gradient)
            before, kept, new, moved = beta, float(loss), beta - move, float(np.abs(move).max())
        return pd.DataFrame(
            {"platform": [first["platform"]], "beta": [new], "before": [before], "loss": [kept], "moved": [moved]}
        )

    return run


def fit_groups(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Mapping[str, str],
    platform_col: str = "platform",
    label_col: str = "negative_experience",
    strength: float = 1.0,
) -> GroupedFit:
    """Fit every platform of ``train`` (training rows only; ``categorical`` maps prefixes to columns)."""
    columns = list(categorical.values())
    label = F.col(label_col)
    named = train.where(label.isNotNull() & F.col(platform_col).isNotNull()).select(
        F.col(platform_col).cast("string").alias("platform"), label.cast("double").alias("y"),
        *[F.col(c) for c in dict.fromkeys([*numeric, *columns]) if c not in ("platform", "y")],
    )
    levels = _levels(named, columns)
    profile = materialise(_profile(named, numeric, columns), "platform-profile")
    rows = lookup_join(named, profile, "platform", spread_by=numeric[0] if numeric else None)
    names, values, active = [], [], []
    for i, (prefix, c) in enumerate(categorical.items()):
        seen = F.col(f"c{i}")
        for level in levels[c]:
            shown = "None" if level == _MISSING else level
            used = F.array_contains(seen, level) & ((F.size(seen) != 2) | (F.element_at(seen, -1) == level))
            names.append(f"{prefix}{c}_{shown}")
            active.append(used)
            values.append(F.when(used & (_category(named, c) == level), 1.0).otherwise(0.0))
    for i, c in enumerate(numeric):
        mean, spread = F.col(f"m{i}"), F.col(f"s{i}")
        varies = spread > 1e-12 * F.greatest(F.lit(1.0), F.abs(mean))
        names.append(f"num_scaler__{c}")
        active.append(F.lit(True))
        values.append(F.when(varies, (F.col(c).cast("double") - mean) / spread).otherwise(0.0))
    names.append(INTERCEPT)
    weight = F.col("rows") / (2 * F.when(F.col("y") == 1, F.col("ones")).otherwise(F.col("rows") - F.col("ones")))
    matrix = materialise(
        rows.select("platform", "y", weight.alias("w"), F.array(*values, F.lit(1.0)).alias("x")), "grouped-matrix"
    )
    flags = profile.select("platform", F.array(*active, F.lit(True)).alias("active"))
    state = profile.select(
        "platform", F.array_repeat(F.lit(0.0), len(names)).alias("beta"), F.lit(None).cast("array<double>").alias("before"),
        F.lit(None).cast("double").alias("loss"), F.lit(None).cast("double").alias("moved"),
    )
    done: list[DataFrame] = []
    for step in range(MAX_STEPS):
        met = lookup_join(matrix, state.drop("moved"), "platform", spread_by="w")
        sums = met.select("platform", "y", "w", "x", "beta", "before", "loss").mapInArrow(_partial_sums, _SUMS)
        new = materialise(sums.groupBy("platform").applyInPandas(_step(strength), _STATE), f"newton-{step}")
        last = step == MAX_STEPS - 1
        done.append(new if last else new.where(F.col("moved") < TOLERANCE))
        state = new.where(F.col("moved") >= TOLERANCE)
        if last or not state.limit(1).count():
            break
    betas = done[0]
    for more in done[1:]:
        betas = betas.unionByName(more)
    betas = betas.select("platform", "beta").join(flags, "platform")
    listed = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("beta").alias("coef"), F.col("active"))
    coefs = betas.select("platform", F.inline(listed)).where("active").select("platform", "feature", "coef")
    return GroupedFit(tuple(names), matrix, betas, coefs)
