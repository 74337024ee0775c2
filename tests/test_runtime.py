"""Measured broadcasts: nested values count with all their elements."""

from pyspark.sql import functions as F

from gripelens.runtime import fits_broadcast, payload_bytes


def test_arrays_count_all_their_elements(spark):
    wide = spark.range(1000).select("id", F.sequence(F.lit(1), F.lit(20_000)).alias("a"))
    assert payload_bytes(wide) >= 80_000_000 and not fits_broadcast(wide)


def test_nested_texts_maps_and_structs_are_measured(spark):
    df = spark.range(10).select(
        F.struct(F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.repeat(F.lit("y"), 500), F.lit(None)).alias("u")).alias("s"),
        F.create_map(F.lit("k"), F.repeat(F.lit("z"), 300)).alias("m"),
    )
    assert 10 * 1800 <= payload_bytes(df) <= 10 * 2200


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None)], "a array<struct<t:string>>, t string")
    assert 0 < payload_bytes(df) < 100
    assert payload_bytes(df.limit(0)) == 0
