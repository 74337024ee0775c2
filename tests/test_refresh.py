"""Incremental feature tables against full recomputation."""

import os

import pytest
from pyspark.sql import functions as F

from gripelens.plans.refresh import FeatureStore, Refreshed

SCHEMA = "review_id bigint, platform string, text string"


def measured(df):
    """A scoring that drops blank texts, as label rules and filters do."""
    return df.where(F.col("text") != "").select("review_id", "platform", F.length("text").alias("chars"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_ino
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def test_refreshes_equal_recomputation_and_leave_the_rest_alone(spark, tmp_path):
    path = str(tmp_path / "store")
    store = FeatureStore(path, measured, partition_col="platform")
    first = [(1, "a", "one"), (2, "a", None), (3, "b", "three"), (4, None, "four"), (5, "c", ""), (6, "", "six")]
    df = spark.createDataFrame(first, SCHEMA)
    assert store.refresh(df) == Refreshed(6, 0, 0, 0, 6, 5)
    assert rows_of(store.read(spark)) == rows_of(measured(df))
    before = files(path)
    assert store.refresh(df.repartition(3)) == Refreshed(0, 0, 0, 6, 0, 0)
    assert files(path) == before
    # 1 changes its text, 3 moves from b to c and leaves b empty, 7 is new, 6 goes.
    second = [(1, "a", "other"), (2, "a", None), (3, "c", "three"), (4, None, "four"), (5, "c", ""), (7, "a", "new")]
    df = spark.createDataFrame(second, SCHEMA)
    assert store.refresh(df) == Refreshed(1, 2, 1, 3, 3, 4)
    assert rows_of(store.read(spark)) == rows_of(measured(df))
    untouched = {f: i for f, i in before.items() if "=null" in f}
    assert untouched and untouched.items() <= files(path).items()
    assert store.refresh(df).partitions == 0


def test_null_and_text_null_differ_and_versions_score_again(spark, tmp_path):
    path = str(tmp_path / "store")
    store = FeatureStore(path, measured, buckets=3)
    store.refresh(spark.createDataFrame([(1, "a", None), (2, "b", "x")], SCHEMA))
    df = spark.createDataFrame([(1, "a", "null"), (2, "b", "x")], SCHEMA)
    assert store.refresh(df).changed == 1
    assert rows_of(store.read(spark)) == rows_of(measured(df))
    assert FeatureStore(path, measured, buckets=3, version="2").refresh(df).scored == 2


def test_empty_input_and_null_ids(spark, tmp_path):
    store = FeatureStore(str(tmp_path / "store"), measured, partition_col="platform")
    df = spark.createDataFrame([(1, "a", "one")], SCHEMA)
    assert store.refresh(df.limit(0)) == Refreshed(0, 0, 0, 0, 0, 0)
    store.refresh(df)
    assert store.refresh(df.limit(0)).removed == 1
    assert store.read(spark).collect() == []
    with pytest.raises(Exception, match="review_id is null"):
        store.refresh(spark.createDataFrame([(None, "a", "one")], SCHEMA))
