"""Counts of hash buckets reach the driver as numbers, not as a Python row for each."""

from pyspark.sql import DataFrame

from gripelens.llm import line_dedup
from gripelens.llm.near_dedup import NearDedup


def no_rows(*_):
    raise AssertionError("rows were collected")


def test_buckets_come_as_numbers(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b b\nc " + "d " * 9), (2, None), (3, "")], "doc_id bigint, text string")
    with monkeypatch.context() as m:
        m.setattr(type(docs), "collect", no_rows)
        counts = line_dedup.word_counts(docs)
        levels = NearDedup(width=3, percent=80).shingle_levels(docs)
    assert isinstance(docs, DataFrame) and levels.max() == int(1 + 4 * 2.8073549220576041)  # seven times d d d
    table = spark.range(1).select(counts.alias("t")).first()["t"]
    at = spark.sql("SELECT w, CAST(xxhash64(w) & 262143 AS INT) AS b FROM VALUES ('a'), ('b'), ('c'), ('d') AS t(w)")
    assert {r["w"]: table[r["b"]] for r in at.collect()} == {"a": 1, "b": 5, "c": 1, "d": 13}
