import pytest

from gripelens.operators.coefs import key_matrix, rank_by_importance, sort_by_coef, top_coefs
from gripelens.sources.tables import read_coefs, write_coefs

# Published standardised coefficients of three platforms.
N = "num_scaler__"
PUBLISHED = {
    "Amazon (Beauty)": {
        N + "sentiment_polarity": -1.526639,
        N + "review_length_chars": -1.163615,
        N + "exclamation_count": -0.235342,
        N + "review_age_days": -0.126881,
        N + "avg_sentence_length": -0.071320,
        N + "helpful_vote": -0.024007,
        N + "sentiment_subjectivity": -0.011761,
        N + "capital_ratio": 0.044897,
        "verified_ohe__verified_purchase_True": 0.884535,
        N + "review_length_words": 1.147388,
    },
    "Steam": {
        N + "sentiment_polarity": -1.172056,
        N + "review_length_chars": -1.070260,
        "early_access_ohe__early_access_review_Early Access Review": -0.724235,
        N + "exclamation_count": -0.190767,
        N + "sentiment_subjectivity": -0.154133,
        N + "capital_ratio": -0.041681,
        N + "playtime": 0.037233,
        N + "helpfulness": 0.067985,
        N + "review_age_days": 0.195222,
        N + "avg_sentence_length": 0.212996,
        N + "review_length_words": 1.357615,
    },
    "Yelp": {
        N + "review_length_chars": -2.026951,
        N + "sentiment_polarity": -1.790832,
        N + "exclamation_count": -0.414538,
        N + "capital_ratio": -0.097901,
        N + "avg_sentence_length": 0.076233,
        N + "sentiment_subjectivity": 0.086375,
        N + "review_length_words": 2.253899,
    },
}
# The matrix that follows from them (rank, feature, one value per platform).
MATRIX = [
    (1, "Review age days", -0.126881, 0.195222, 0.0),
    (2, "Avg sentence length", -0.071320, 0.212996, 0.076233),
    (3, "Exclamation count", -0.235342, -0.190767, -0.414538),
    (4, "Early access review", 0.0, -0.724235, 0.0),
    (5, "Verified purchase True", 0.884535, 0.0, 0.0),
    (6, "Sentiment polarity", -1.526639, -1.172056, -1.790832),
    (7, "Review length chars", -1.163615, -1.070260, -2.026951),
    (8, "Review length words", 1.147388, 1.357615, 2.253899),
]


@pytest.fixture(scope="module")
def coefs(spark):
    rows = [(p, f, c) for p, table in PUBLISHED.items() for f, c in table.items()]
    return spark.createDataFrame(rows, "platform string, feature string, coef double")


def test_matrix_from_published_coefficients(coefs):
    assert [tuple(r) for r in key_matrix(coefs, list(PUBLISHED)).collect()] == MATRIX


def test_matrix_can_leave_missing_pairs_empty(coefs):
    rows = {r.feature: r for r in key_matrix(coefs, list(PUBLISHED), fill=None).collect()}
    assert rows["Verified purchase True"].Steam is None


def test_names_that_collide_share_a_row(spark):
    rows = [("Steam", "num_scaler__a_b", 0.5), ("Steam", "cat_ohe__a_b", 0.9)]
    df = spark.createDataFrame(rows, "platform string, feature string, coef double")
    # The first raw name gives the value, the larger one the rank.
    assert [tuple(r) for r in key_matrix(df, ["Steam"]).collect()] == [(1, "A b", 0.9)]


def test_top_and_orders(coefs):
    top = top_coefs(coefs, n=2).where("platform = 'Steam'").orderBy("rank").collect()
    assert [(r["rank"], r.feature) for r in top] == [(1, "Review Length Words"), (2, "Sentiment Polarity")]
    yelp = coefs.where("platform = 'Yelp'")
    assert sort_by_coef(yelp).first().coef == -2.026951
    assert rank_by_importance(yelp).first().coef == 2.253899


def test_coefficient_files(spark, coefs, tmp_path):
    paths = {}
    for platform in PUBLISHED:
        paths[platform] = str(tmp_path / platform)
        write_coefs(coefs.where(coefs.platform == platform).select("feature", "coef"), paths[platform])
    paths["Absent"] = str(tmp_path / "absent")
    back = read_coefs(spark, paths)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in coefs.collect())
    with pytest.raises(FileNotFoundError):
        read_coefs(spark, paths, missing="error")
    assert read_coefs(spark, {"Absent": paths["Absent"]}).count() == 0
