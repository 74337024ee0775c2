"""The change detector: batch against a plain loop, stream against batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gripelens.streaming import monitor
from gripelens.streaming.changes import ChangeDetector

SCHEMA = "review_id bigint, event_ts timestamp, platform string, negative_experience int"
START = dt.datetime(2024, 1, 1)


def plain(rows, rule):
    days = {}
    for i, ts, platform, label in {r[0]: r for r in rows}.values():
        if platform is None or ts is None or label is None:
            continue
        n, bad = days.get((platform, ts.date()), (0, 0))
        days[platform, ts.date()] = (n + 1, bad + label)
    out, score, alert, last = [], 0, False, None
    for (platform, day), (n, bad) in sorted(days.items()):
        if last is None or last[0] != platform or (day - last[1]).days > rule.idle_days:
            score, alert = 0, False
        score = max(0, score + 1000 * bad - rule.limit * n)
        out.append((platform, day, n, bad, score, score > rule.bound, score > rule.bound and not alert))
        last, alert = (platform, day), score > rule.bound
    return out


def some_reviews(seed):
    rnd, rows = random.Random(seed), []
    for platform in ("a", "b", "quiet"):
        for day in range(70):
            if platform == "quiet" and 10 <= day < 55 or rnd.random() < 0.1:
                continue
            share = 0.3 + (0.25 if day > 40 and platform == "a" else 0)
            for _ in range(rnd.randint(1, 12)):
                ts = START + dt.timedelta(days=day, seconds=rnd.randrange(86400))
                rows.append((len(rows), ts, platform, int(rnd.random() < share)))
    return rows + [(10**6, None, "a", 1), (10**6 + 1, START, None, 1), (10**6 + 2, START, "a", None)]


def listed(df):
    return sorted((r.platform, r.day.date(), r.n, r.negative, r.score, r.alert, r.started) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_equals_a_plain_loop(spark, seed):
    rule, rows = ChangeDetector(limit=400, bound=6000), some_reviews(seed)
    df = spark.createDataFrame(rows + rows[:30], SCHEMA).repartition(5)
    want = plain(rows, rule)
    assert listed(rule.batch(df)) == want
    assert any(r[6] for r in want)
    assert rule.batch(df.limit(0)).count() == 0


def test_stream_gives_the_closed_days_whatever_the_files(spark, tmp_path):
    rule, rows = ChangeDetector(limit=400, bound=6000), some_reviews(3)
    df = spark.createDataFrame(rows, SCHEMA)
    latest = max(r[1] for r in rows if r[1])
    closed = [r for r in plain(rows, rule) if dt.datetime.combine(r[1], dt.time()) + dt.timedelta(days=3) <= latest]
    for name, seed in (("x", 1), ("y", 2)):
        # eight files in the order of time, rows at the borders dealt to either side
        jitter = F.unix_timestamp("event_ts") + F.pmod(F.xxhash64("review_id", F.lit(seed)), F.lit(40_000))
        path = str(tmp_path / name)
        timed = df.where("event_ts IS NOT NULL").withColumn("_at", jitter)
        for k in range(8):
            low, high = (START.timestamp() + 70 * 86400 * q / 8 for q in (k, k + 1))
            part = timed.where((F.col("_at") >= low) & ((F.col("_at") < high) | F.lit(k == 7)))
            part.drop("_at").coalesce(1).write.mode("append").parquet(path)
        source = monitor.read_review_stream(spark, path, SCHEMA, files_per_trigger=1)
        out = str(tmp_path / f"{name}-out")
        query = monitor.watch(rule.stream(source, "2 days"), out, str(tmp_path / f"{name}-cp"), 2, once=True)
        query.awaitTermination()
        got = listed(spark.read.parquet(out))
        assert set(closed) <= set(got) <= set(plain(rows, rule)) and len(got) == len(set(got))
