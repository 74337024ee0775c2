import datetime as dt

import pytest
from pyspark.sql import functions as F

from gripelens.operators.sentiment import Lexicon
from gripelens.operators.trends import daily_trend, moving_trend
from gripelens.plans.platform_model import run_platform
from gripelens.plans.presets import PRESETS
from gripelens.streaming import monitor

UTC = dt.timezone.utc


def reviews(spark, n=400):
    rows = [
        (i, "hot" if i % 3 == 0 else f"p{i % 5}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), (i * 7 % 10 < 4) if i % 11 else None)
        for i in range(n)
    ]
    rows = [(i, p, t, None if y is None else int(y)) for i, p, t, y in rows]
    return spark.createDataFrame(rows, "review_id int, platform string, event_ts timestamp, negative_experience int")


def shares_of(table):
    return sorted(map(tuple, table.collect()))


@pytest.mark.parametrize("files_per_trigger", [1, 2, 1000])
def test_drained_result_does_not_depend_on_batches(spark, tmp_path, files_per_trigger):
    df = reviews(spark)
    source = str(tmp_path / "in")
    # Newest reviews first, the oldest far behind any watermark, repeated rows in several files.
    for part in ("review_id >= 300", "review_id < 40", "review_id BETWEEN 40 AND 310", "review_id < 60"):
        df.where(part).coalesce(1).write.mode("append").parquet(source)
    stream = monitor.read_review_stream(spark, source, df.schema, files_per_trigger=files_per_trigger)
    stored = monitor.drain_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    table = monitor.negative_share(stored)
    assert shares_of(table) == shares_of(monitor.negative_share(df))
    high = monitor.alerts(table, 0.5, min_reviews=3)
    assert {r.platform for r in high.collect()} <= {r.platform for r in table.collect()}
    assert all(r.share > 0.5 and r.n >= 3 for r in high.collect())


def test_later_files_are_added(spark, tmp_path):
    df = reviews(spark)
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    df.where("review_id >= 200").coalesce(1).write.parquet(source)
    monitor.drain_to_table(monitor.read_review_stream(spark, source, df.schema), out, cp)
    df.where("review_id < 210").coalesce(1).write.mode("append").parquet(source)
    stored = monitor.drain_to_table(monitor.read_review_stream(spark, source, df.schema), out, cp)
    assert shares_of(monitor.negative_share(stored)) == shares_of(monitor.negative_share(df))


def test_live_job_emits_closed_windows_and_counts_late_rows(spark, tmp_path):
    df = reviews(spark).where("negative_experience IS NOT NULL")
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def run(part):
        df.where(part).coalesce(1).write.mode("append").parquet(source)
        shares = monitor.negative_share(monitor.read_review_stream(spark, source, df.schema))
        query = monitor.watch(shares, out, cp, state_partitions=2, once=True)
        query.awaitTermination()
        return monitor.late_rows(query)

    assert run("review_id BETWEEN 100 AND 399") == 0
    assert run("review_id < 50") > 0  # two weeks behind the watermark
    emitted = spark.read.parquet(out)
    want = {tuple(r) for r in monitor.negative_share(df.where("review_id >= 100")).collect()}
    assert emitted.count() and {tuple(r) for r in emitted.collect()} <= want


def test_sliding_windows(spark):
    df = reviews(spark, 48)
    n = monitor.negative_share(df, window="1 day", slide="12 hours").agg(F.sum("n")).first()[0]
    assert n == 2 * df.where("negative_experience IS NOT NULL").count()


def test_incoming_reviews_are_scored(spark, tmp_path):
    lexicon = Lexicon.from_rows(spark, [("great", 0.8, 0.7), ("awful", -0.9, 0.9)], [])
    rows = [(i, 4 if i % 2 else 0, "great " * (1 + i % 3) if i % 2 else "awful thing") for i in range(40)]
    train = spark.createDataFrame(rows, "review_id int, label int, text string")
    as_of = dt.datetime(2024, 2, 1, tzinfo=UTC)
    run = run_platform(train, PRESETS["yelp"], lexicon, as_of, str(tmp_path / "run"))
    incoming = spark.createDataFrame(
        [(1, "awful", dt.datetime(2024, 1, 5)), (2, "great", dt.datetime(2024, 1, 6)), (3, None, dt.datetime(2024, 1, 6))],
        "review_id int, text string, seen timestamp",
    )
    incoming.write.parquet(str(tmp_path / "in"))
    stream = monitor.read_review_stream(spark, str(tmp_path / "in"), incoming.schema)
    scored = monitor.score_incoming(
        stream, PRESETS["yelp"], lexicon, run.model.pipeline, as_of, str(tmp_path / "scored"), str(tmp_path / "cp"), "seen"
    )
    assert {r.review_id: r.negative_experience for r in scored.collect()} == {1: 1, 2: 0}


def test_trends(spark):
    day = dt.datetime(2024, 1, 1, 12)
    rows = [("a", day + dt.timedelta(days=d), float(d)) for d in range(10) for _ in range(2)]
    df = spark.createDataFrame(rows, "platform string, event_ts timestamp, m double")
    daily = daily_trend(df, ["m"])
    got = [(r.n, r.avg_m) for r in daily.orderBy("day").collect()]
    assert got == [(2, float(d)) for d in range(10)]
    moving = [r.moving_m for r in moving_trend(daily, ["m"]).orderBy("day").collect()]
    assert moving[0] == 0.0 and moving[-1] == pytest.approx(6.0)


def test_a_source_without_files_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "review_id bigint, event_ts timestamp, platform string, negative_experience int"
    stream = monitor.read_review_stream(spark, str(tmp_path / "in"), schema)
    stored = monitor.drain_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert stored.columns == stream.columns and stored.count() == 0
    assert monitor.negative_share(stored).count() == 0
