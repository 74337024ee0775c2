"""Exact-size samples and splits without sorting or gathering rows.

Every sample is "the first n rows in hash order". The hash is ``md5(seed:id)``,
so the outcome depends on the seed and the ids only, never on partitioning.
The n-th hash is located by narrowing down hexadecimal prefixes: each round
counts rows per three-digit prefix (map-side combined, at most 4,096 counters
per stratum) and descends into the prefix that holds the n-th row. Once that
prefix holds few rows they are ranked. What remains is a plain row filter
``hash <= cut``, which runs in the scan stage: no shuffle of rows, no window over
the data, no task that holds the sample.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 3
_RANK_LIMIT = 20_000
_KEY_LENGTH = 48  # a digest, and a place among equal rows


@dataclass(frozen=True)
class Cut:
    """``key`` is the last key that takes part; ``room`` of its weight is wanted."""

    key: str
    room: int


def hash_key(identity: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), identity.cast("string")))


def find_cuts(keys: DataFrame, quotas: Mapping[object, int]) -> dict[object, Cut | None]:
    """Locate, per stratum, the key at which the running weight reaches the quota.

    ``keys`` has columns ``stratum``, ``key`` (hex text) and ``weight``. A
    stratum that holds less than its quota maps to None: it is taken whole.
    """
    cuts: dict[object, Cut | None] = {s: None for s in quotas}
    prefix = {s: "" for s, n in quotas.items() if n > 0}
    need = {s: n for s, n in quotas.items() if n > 0}
    for s, n in quotas.items():
        if n <= 0:
            cuts[s] = Cut("", 0)
    while prefix:
        depth = len(next(iter(prefix.values())))
        inside = _inside(prefix)
        histogram = (
            keys.where(inside)
            .groupBy("stratum", F.substring("key", depth + 1, _DIGITS).alias("digits"))
            .agg(F.sum("weight").alias("weight"), F.count("*").alias("rows"))
            .collect()
        )
        rankable: dict[object, str] = {}
        for s in list(prefix):
            before, found = 0, None
            for row in sorted((r for r in histogram if r["stratum"] == s), key=lambda r: r["digits"]):
                if before + row["weight"] >= need[s]:
                    found = row
                    break
                before += row["weight"]
            if found is None:
                del prefix[s]
                continue
            need[s] -= before
            prefix[s] += found["digits"]
            if found["rows"] <= _RANK_LIMIT or len(prefix[s]) >= _KEY_LENGTH:
                rankable[s] = prefix.pop(s)
        if rankable:
            cuts.update(_rank(keys, rankable, need))
    return cuts


def _inside(prefixes: Mapping[object, str]) -> Column:
    condition = F.lit(False)
    for s, p in prefixes.items():
        here = F.col("stratum").eqNullSafe(F.lit(s))
        condition = condition | ((here & F.col("key").startswith(p)) if p else here)
    return condition


def _rank(keys: DataFrame, prefixes: Mapping[object, str], need: Mapping[object, int]) -> dict:
    """Running weight inside prefixes that hold at most ``_RANK_LIMIT`` keys."""
    order = Window.partitionBy("stratum").orderBy("key")
    wanted = F.lit(None).cast("bigint")
    for s in prefixes:
        wanted = F.when(F.col("stratum").eqNullSafe(F.lit(s)), F.lit(need[s])).otherwise(wanted)
    ranked = (
        keys.where(_inside(prefixes))
        .withColumn("upto", F.sum("weight").over(order))
        .withColumn("before", F.col("upto") - F.col("weight"))
        .where((F.col("before") < wanted) & (F.col("upto") >= wanted))
    )
    return {
        r["stratum"]: Cut(r["key"], need[r["stratum"]] - r["before"]) for r in ranked.collect()
    }


def _keys(df: DataFrame, key: Column, stratum: Column | None = None, weight: Column | None = None):
    return df.select(
        (F.lit(0) if stratum is None else stratum).alias("stratum"),
        key.alias("key"),
        (F.lit(1) if weight is None else weight).cast("bigint").alias("weight"),
    )


def _upto(key: Column, cut: Cut | None) -> Column:
    if cut is None:
        return F.lit(True)
    return key <= cut.key if cut.room > 0 else F.lit(False)


def sample_uniform(df: DataFrame, n: int, id_col: str, seed: int = 33) -> DataFrame:
    """Exactly ``n`` rows drawn uniformly (all rows if there are fewer)."""
    key = hash_key(F.col(id_col), seed)
    return df.where(_upto(key, find_cuts(_keys(df, key), {0: n})[0]))


def sample_by_key(df: DataFrame, n: int, key: Column) -> DataFrame:
    """The ``n`` rows with the lowest keys (hex text, unique)."""
    return df.where(_upto(key, find_cuts(_keys(df, key), {0: n})[0]))


def sample_bounded(
    df: DataFrame,
    n: int,
    record_col: str,
    buffer: int = 100_000,
    seed: int = 42,
) -> DataFrame:
    """``n`` rows from the head of a stream, as a shuffle buffer of that size draws them.

    ``record_col`` is the dense position of the record, counted from 0; only the
    first ``buffer + n`` records can be chosen.
    """
    return sample_uniform(df.where(F.col(record_col) < buffer + n), n, record_col, seed)


def sample_files(
    df: DataFrame,
    n: int,
    id_col: str,
    file_col: str,
    seed: int = 33,
    key: Column | None = None,
) -> DataFrame:
    """Whole files in hash order until ``n`` rows are reached; the last file gives
    only as many rows as are missing, chosen by row hash (or by ``key``).

    ``df`` holds the eligible rows. If eligibility is costly to decide, pass a
    materialised table: this makes a pass for the file sizes and one inside the
    last file.
    """
    file_key = hash_key(F.col(file_col), seed)
    row_key = hash_key(F.col(id_col), seed) if key is None else key
    sizes = df.groupBy(file_col).agg(F.count("*").alias("rows"))
    sizes = sizes.persist()
    try:
        cut = find_cuts(_keys(sizes, file_key, weight=F.col("rows")), {0: n})[0]
    finally:
        sizes.unpersist()
    if cut is None:
        return df
    if cut.room == 0:
        return df.where(F.lit(False))
    last = df.where(file_key == cut.key)
    within = find_cuts(_keys(last, row_key), {0: cut.room})[0]
    return df.where((file_key < cut.key) | ((file_key == cut.key) & _upto(row_key, within)))


def train_quotas(sizes: Mapping[object, int], test_fraction: float) -> dict[object, int]:
    """Training rows per class: proportional shares of ``n - ceil(test_fraction * n)``,
    the remainder going to the classes with the largest fractional part."""
    total = sum(sizes.values())
    train = total - math.ceil(round(test_fraction * total, 9))
    share = {c: (train * size) // total for c, size in sizes.items()}
    left = train - sum(share.values())
    by_rest = sorted(sizes, key=lambda c: (-((train * sizes[c]) % total), str(c)))
    for c in by_rest[:left]:
        share[c] += 1
    return share


def plan_split(
    df: DataFrame, label_col: str, id_col: str, test_fraction: float = 0.2, seed: int = 33
) -> tuple[Column, dict[object, int]]:
    """The predicate that marks test rows, and the number of training rows per class."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("n")).collect()
    sizes = {r[label_col]: r["n"] for r in counts}
    train = train_quotas(sizes, test_fraction)
    key = hash_key(F.col(id_col), seed)
    cuts = find_cuts(
        _keys(df, key, stratum=F.col(label_col)),
        {c: size - train[c] for c, size in sizes.items()},
    )
    is_test = F.lit(False)
    for c, cut in cuts.items():
        is_test = F.when(F.col(label_col).eqNullSafe(F.lit(c)), _upto(key, cut)).otherwise(is_test)
    return is_test, train


def stratified_split(
    df: DataFrame, label_col: str, id_col: str, test_fraction: float = 0.2, seed: int = 33
) -> DataFrame:
    """Add boolean ``is_test``; class proportions match in both parts.

    Test rows are the lowest hashes of their class.
    """
    is_test, _ = plan_split(df, label_col, id_col, test_fraction, seed)
    return df.withColumn("is_test", is_test)
