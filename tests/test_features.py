import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gripelens.operators.sentiment import Lexicon
from gripelens.plans.features import build_features, text_features
from gripelens.plans.platform_model import run_platform
from gripelens.plans.presets import PRESETS, star_corrected
from gripelens.plans.reports import outcome_group, sentiment_by_outcome, sentiment_by_platform

AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def lexicon(spark):
    words = [("great", 0.8, 0.75), ("terrible", -1.0, 1.0), ("ok", 0.5, 0.5)]
    return Lexicon.from_rows(spark, words, [("very", "intensify", 1.3)])


def amazon(spark, n=10):
    rows = [
        (i, 5.0 if i % 2 == 0 else 1.0, "Great! Very great." if i % 2 == 0 else "TERRIBLE", i % 4, i % 2 == 0, 1700000000000)
        for i in range(n)
    ]
    rows += [(100, 3.0, "ok", 0, True, 1700000000000), (101, 5.0, None, 0, True, 1700000000000)]
    return spark.createDataFrame(
        rows, "review_id int, rating double, text string, helpful_vote bigint, verified_purchase boolean, timestamp bigint"
    )


def test_amazon_features(spark, lexicon):
    df = build_features(amazon(spark), PRESETS["amazon_beauty"], lexicon, AS_OF)
    assert df.columns == [
        "review_id", "rating", "helpful_vote", "verified_purchase", "negative_experience", "review_age_days",
        "sentiment_polarity", "sentiment_subjectivity", "review_length_words", "review_length_chars",
        "avg_sentence_length", "exclamation_count", "capital_ratio",
    ]
    rows = {r.review_id: r for r in df.collect()}
    assert sorted(rows) == list(range(10))  # neutral and textless rows are gone
    assert rows[0].review_age_days == 77
    assert (rows[0].review_length_words, rows[0].avg_sentence_length) == (3, 1.5)
    assert rows[0].sentiment_polarity == pytest.approx((0.8 + 1.0) / 2)
    assert (rows[1].negative_experience, rows[1].capital_ratio) == (1, 1.0)


def test_metadata_may_come_later(spark, lexicon):
    whole = amazon(spark)
    narrow = whole.drop("helpful_vote", "timestamp")
    meta = whole.select("review_id", "helpful_vote", "timestamp")
    one = build_features(whole, PRESETS["amazon_health"], lexicon, AS_OF)
    two = build_features(narrow, PRESETS["amazon_health"], lexicon, AS_OF, metadata=meta)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_steam_features_drop_bad_dates(spark, lexicon):
    rows = [
        (1, 10.0, 1.0, "great", "2024-01-01", "Recommended", ""),
        (2, 1.0, 0.0, "terrible!", "Jan 30, 2024", "Not Recommended", "Early Access Review"),
        (3, 1.0, 0.0, "ok", "someday", "Recommended", ""),
        (4, 1.0, 0.0, "ok", "2024-01-01", "", ""),
    ]
    df = spark.createDataFrame(
        rows,
        "review_id int, playtime double, helpfulness double, review string, post_date string, recommend string, early_access_review string",
    )
    got = {r.review_id: r for r in build_features(df, PRESETS["steam"], lexicon, AS_OF).collect()}
    assert sorted(got) == [1, 2]
    assert (got[1].review_age_days, got[2].review_age_days) == (30, 1)
    assert (got[1].negative_experience, got[2].negative_experience) == (0, 1)


def test_yelp_labels(spark, lexicon):
    df = spark.createDataFrame([(i, i, "ok") for i in range(5)], "review_id int, label int, text string")

    def labels(preset):
        return {r.label: r.negative_experience for r in build_features(df, preset, lexicon, AS_OF).collect()}

    assert labels(PRESETS["yelp"]) == {0: 1, 1: 1, 2: 1, 4: 0}
    assert labels(star_corrected(PRESETS["yelp"])) == {0: 1, 1: 1, 3: 0, 4: 0}


def test_own_scorer(spark):
    @F.pandas_udf("polarity double, subjectivity double")
    def scorer(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"polarity": text.str.len() * 0.1, "subjectivity": text.str.len() * 0.2})

    df = spark.createDataFrame([(1, " ab "), (2, None)], "review_id int, text string")
    got = {r.review_id: r for r in text_features(df, scorer=scorer).collect()}
    assert (got[1].sentiment_polarity, got[1].sentiment_subjectivity) == pytest.approx((0.2, 0.4))
    assert (got[2].sentiment_polarity, got[2].review_length_words) == (0.0, 0)
    with pytest.raises(ValueError):
        text_features(df)


def test_whole_platform_run(spark, lexicon, tmp_path):
    run = run_platform(amazon(spark, 40), PRESETS["amazon_beauty"], lexicon, AS_OF, str(tmp_path / "out"))
    coefs = {r.feature: r.coef for r in run.coefs.collect()}
    assert len(coefs) == 10 and coefs["num_scaler__sentiment_polarity"] < 0
    assert coefs["num_scaler__review_age_days"] == 0.0  # constant
    report = {r["class"]: r for r in run.report.collect()}
    assert report["accuracy"].f1 == 1.0 and report["accuracy"].support == 8
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"features", "coefs", "model"}


def test_reports_of_small_tables(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    nan = float("nan")
    base = "sentiment_polarity double, negative_experience int, "
    frames = {
        "amazon_health": frame(
            [(-0.125, 1, 2.5), (-0.125, 1, 1.5), (-0.75, 1, nan), (0.5, 0, 4.5), (None, 1, 2.0), (0.25, None, 3.0)],
            base + "rating double",
        ),
        "steam": frame([(0.0, 1, "Not Recommended"), (nan, 1, None), (0.625, 0, "Recommended")], base + "recommend string"),
        "yelp": frame([(-1.0, 1, 1), (-1.0, 1, 1), (1.0, 0, None)], base + "label int"),
        "unknown_shop": frame([(7,)], "x int"),
    }
    by_platform = {r.platform: r for r in sentiment_by_platform(frames).collect()}
    assert {p: r.n for p, r in by_platform.items()} == {"Amazon (Health)": 3, "Steam": 1, "Yelp": 2}
    assert by_platform["Amazon (Health)"].median == pytest.approx(-0.125)
    by_outcome = {(r.dataset, r.outcome): r.n for r in sentiment_by_outcome(frames).collect()}
    # Half stars go to the even neighbour; rows without an outcome or a polarity are left out.
    assert by_outcome == {
        ("amazon_health", "2"): 2, ("amazon_health", "4"): 1, ("amazon_health", "3"): 1,
        ("steam", "Not Recommended"): 1, ("steam", "Recommended"): 1, ("yelp", "2"): 2,
    }
    assert outcome_group("unknown_shop") is None
    only = {"unknown_shop": frames["unknown_shop"]}
    assert sentiment_by_outcome(only).count() == 0 and sentiment_by_platform(only).count() == 0


def test_unlabelled_texts_are_not_tokenised(spark, sf_dir):
    from gripelens.checks.registry import labelled_features

    plan = labelled_features(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("LeftSemi") > plan.rindex("Generate")  # below the text work
