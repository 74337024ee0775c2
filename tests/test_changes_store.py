"""The live detector in a session that has Spark's default state store."""

import datetime as dt

from gripelens.streaming import monitor
from gripelens.streaming.changes import ChangeDetector

SCHEMA = "review_id bigint, event_ts timestamp, platform string, negative_experience int"
DEFAULT = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def test_default_state_store_will_do(spark, tmp_path):
    rule, start = ChangeDetector(limit=400, bound=1000), dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=6 * i), "a", int(i % 3 > 0)) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.coalesce(1).write.parquet(path)
    chosen = spark.conf.get(monitor.STATE_STORE)
    spark.conf.set(monitor.STATE_STORE, DEFAULT)
    try:
        live = rule.stream(monitor.read_review_stream(spark, path, SCHEMA))
        monitor.watch(live, out, str(tmp_path / "cp"), 1, once=True).awaitTermination()
        assert spark.conf.get(monitor.STATE_STORE) == DEFAULT
    finally:
        spark.conf.set(monitor.STATE_STORE, chosen)
    listed = lambda d: sorted((r.day, r.n, r.negative, r.score, r.alert, r.started) for r in d.collect())
    got, want = listed(spark.read.parquet(out)), listed(rule.batch(df))
    assert got and got == want[: len(got)] and any(r[4] for r in got)
