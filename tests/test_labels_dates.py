from gripelens.functions.dates import parse_date
import pytest
import datetime as dt

from pyspark.sql import functions as F

from gripelens.functions.dates import age_days, from_epoch_ms, parse_date
from gripelens.functions.labels import label_rating, label_recommend


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_star_rule(spark):
    stars = [1.0, 2.0, 3.0, 4.0, 5.0, None, 2.5, 3.9]
    assert column(spark, stars, "double", label_rating) == [1, 1, None, 0, 0, None, None, None]


def test_zero_based_rule_as_is_and_corrected(spark):
    raw = [0, 1, 2, 3, 4]
    assert column(spark, raw, "int", label_rating) == [1, 1, 1, None, 0]
    assert column(spark, raw, "int", lambda c: label_rating(c, offset=1)) == [1, 1, None, 0, 0]


def test_recommend_rule(spark):
    verdicts = ["Recommended", "Not Recommended", "", None, "recommended"]
    assert column(spark, verdicts, "string", label_recommend) == [0, 1, None, None, None]


def test_epoch_and_age(spark):
    utc = dt.timezone.utc
    as_of = dt.datetime(2024, 1, 2, tzinfo=utc)
    hour_before = int(dt.datetime(2024, 1, 1, 23, tzinfo=utc).timestamp() * 1000)
    day_before = hour_before - 23 * 3600 * 1000
    day_before_less = day_before + 1
    after = int(as_of.timestamp() * 1000) + 1
    ages = column(
        spark,
        [hour_before, day_before, day_before_less, after],
        "bigint",
        lambda c: age_days(from_epoch_ms(c), as_of),
    )
    assert ages == [0, 1, 0, -1]
    stamp = column(spark, [1_700_000_000_000], "bigint", lambda c: F.date_format(from_epoch_ms(c), "yyyy-MM-dd HH:mm:ss"))
    assert stamp == ["2023-11-14 22:13:20"]


def test_lenient_dates(spark):
    texts = ["2024-01-05", "Jan 5, 2024", "", "junk", None, "2024-13-01"]
    got = column(spark, texts, "string", lambda c: F.date_format(parse_date(c), "yyyy-MM-dd"))
    assert got == ["2024-01-05", "2024-01-05", None, None, None, None]


def test_values_that_are_not_numbers(spark):
    from gripelens.functions.labels import label_rating
    from gripelens.operators.encode import apply_encoding, fit_one_hot
    from gripelens.operators.profile import missing_profile

    df = spark.createDataFrame([(float("nan"), True), (None, False), (1.0, None), (4.5, True)], "r double, b boolean")
    assert [r[0] for r in df.select(label_rating(F.col("r"))).collect()] == [None, None, 1, 0]
    missing = {r["column_name"]: r["missing"] for r in missing_profile(df).collect()}
    assert missing == {"r": 2, "b": 1}
    encoded = fit_one_hot(df, {"cat__": "b"})
    assert [e.name for e in encoded] == ["cat__b_False", "cat__b_True", "cat__b_None"]
    got = [tuple(r) for r in apply_encoding(df, encoded).collect()]
    assert got == [(0, 1, 0), (1, 0, 0), (0, 0, 1), (0, 1, 0)]
    known = fit_one_hot(df.where("b"), {"cat__": "b"}, unknown="error")
    with pytest.raises(Exception, match="did not see"):
        apply_encoding(df, known).collect()


def test_date_styles(spark):
    styles = [
        "2024-01-05", "2024-1-5", "2024-01-05 10:00:00", "2024-01-05T10:00:00", "Jan 5, 2024", "January 5, 2024",
        "5 January, 2024", "01/05/2024",
    ]
    df = spark.createDataFrame([(x,) for x in [*styles, "", "someday", None]], "d string")
    got = [str(r[0]) for r in df.select(F.to_date(parse_date(F.col("d")))).collect()]
    assert got == ["2024-01-05"] * len(styles) + ["None"] * 3
