from pyspark.sql import functions as F

from gripelens.operators.language import LanguageModel, detect_language
from gripelens.plans import datasets
from gripelens.sources import tables


def test_ids_are_unique_and_positions_dense(spark):
    df = spark.createDataFrame([(1.0, "same")] * 50 + [(2.0, None), (None, "x")], "rating double, text string").repartition(7)
    keyed = datasets.with_position(datasets.with_review_id(df))
    rows = keyed.collect()
    assert len({r["review_id"] for r in rows}) == 52
    assert len({r["review_id"][:32] for r in rows}) == 3
    assert sorted(r["position"] for r in rows) == list(range(52))


def test_sample_of_equal_rows_has_the_exact_size(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "same")] * 300 + [(2.0, f"t{i}") for i in range(30)], "rating double, text string")
    df.write.parquet(str(tmp_path / "in"))
    one = datasets.create_yelp(spark, str(tmp_path / "in"), str(tmp_path / "a"), n=100)
    df.repartition(5).write.parquet(str(tmp_path / "in2"))
    two = datasets.create_yelp(spark, str(tmp_path / "in2"), str(tmp_path / "b"), n=100)
    assert one.count() == 100
    assert sorted(r["text"] for r in one.collect()) == sorted(r["text"] for r in two.collect())


def test_steam_stops_early_and_keeps_english(spark, tmp_path):
    counts = spark.createDataFrame(
        [("en", " th", 9), ("en", "the", 9), ("en", "he ", 9), ("de", " de", 9), ("de", "der", 9), ("de", "er ", 9)],
        "lang string, gram string, n bigint",
    )
    LanguageModel.from_counts(counts).save(str(tmp_path / "model"))
    model = LanguageModel.load(spark, str(tmp_path / "model"))
    assert model.languages == ("de", "en")
    probe = spark.createDataFrame([(1, "the the"), (2, "der der"), (3, "!")], "review_id int, text string")
    assert {r["review_id"]: r["lang_detected"] for r in detect_language(probe, model).collect()} == {1: "en", 2: "de", 3: "unknown"}
    rows = [("the " * (1 + i % 5) if i % 3 else "der der", "Recommended", f"g{i % 6}") for i in range(600)]
    rows += [("  ", None, "g1"), (None, "Recommended", "g2")]
    df = spark.createDataFrame(rows, "review string, recommend string, user string")
    tables.write_csv(df.repartition(6, "user"), str(tmp_path / "csv"))
    made = datasets.create_steam(
        spark, str(tmp_path / "csv"), str(tmp_path / "raw"), str(tmp_path / "out"), model, n=50,
        game=lambda d: F.col("user"), schema="review string, recommend string, user string",
    )
    got = made.collect()
    assert len(got) == 50 and all(r["review"].startswith("the") for r in got)
    # Whole games but for the last.
    eligible = {g: sum(1 for t, _, u in rows[:600] if u == g and t.startswith("the")) for g in {u for *_, u in rows[:600]}}
    taken = {g: sum(r["user"] == g for r in got) for g in {r["user"] for r in got}}
    assert sum(taken[g] < eligible[g] for g in taken) <= 1


def test_the_head_of_several_files_is_that_of_the_first_by_name(spark, tmp_path):
    """Spark reads the largest file first; the place in the source does not depend on that."""
    schema, start = "rating double, text string", 0
    for name, n in (("a", 20), ("b", 2000), ("c", 200)):
        rows = [(1.0, f"t{i}") for i in range(start, start + n)]
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / name))
        start += n
    source = tables.read_json_reviews(spark, str(tmp_path / "in" / "*"), schema)
    placed = datasets.with_position(source, from_files=True).collect()
    assert all(r["text"] == f"t{r['position']}" for r in placed) and len(placed) == start
    made = datasets.create_amazon(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out"), n=10, buffer=15, schema=schema)
    assert made.count() == 10 and all(int(r["text"][1:]) < 25 for r in made.collect())
