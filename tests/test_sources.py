import pytest

from gripelens import runtime
from gripelens.sources import tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_folder_with_different_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('review,recommend,playtime\n"two\nlines, ""quoted""",Recommended,1.5\n,,x\n')
    (tmp_path / "b.csv").write_text("recommendationid,user,review\n7,u1,Great game\n")
    (tmp_path / "notes.txt").write_text("review\nignored\n")
    df = tables.read_csv_folder(spark, str(tmp_path))
    got = {r.review: r for r in df.collect()}
    assert len(got) == 3
    assert got['two\nlines, "quoted"'].recommend == "Recommended"
    assert got['two\nlines, "quoted"'].playtime == 1.5
    assert got[None].playtime is None
    assert got["Great game"].user == "u1" and got["Great game"].recommend is None
    assert got["Great game"].file.endswith("b.csv")


def test_csv_folder_of_one_layout(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user,review\nu,x\n")
    (tmp_path / "b.csv").write_text("user,review\nv,y\n")
    for same in (True, False):
        df = tables.read_csv_folder(spark, str(tmp_path), "user string, review string", None, same)
        assert rows(df) == [("u", "x"), ("v", "y")]
    with pytest.raises(FileNotFoundError):
        empty = tmp_path / "empty"
        empty.mkdir()
        tables.read_csv_folder(spark, str(empty))


def test_json_reads_only_wanted_fields(spark, tmp_path):
    line = '{"rating": 5.0, "title": "t", "text": "ok", "helpful_vote": 2, "verified_purchase": true, "timestamp": 1700000000000}\n'
    (tmp_path / "r.jsonl").write_text(line + '{"asin": "A", "overall": 5}\n')
    df = tables.read_json_reviews(spark, str(tmp_path))
    assert rows(df) == [(5.0, "ok", 2, True, 1700000000000), (None,) * 5]


def test_snapshot_refuses_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, platform string")
    path = str(tmp_path / "s")
    tables.write_snapshot(df, path, partition_by="platform")
    assert rows(tables.read_snapshot(spark, path).select("id", "platform")) == rows(df)
    with pytest.raises(Exception, match="already exists"):
        tables.write_snapshot(df, path)
    plan = tables.read_snapshot(spark, path).where("platform = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(platform" in plan


def test_parquet_with_missing_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(2, 0.5)], "id int, y double").write.mode("append").parquet(str(tmp_path / "t"))
    df = tables.read_table(spark, str(tmp_path / "t"), merge_schema=True).select("id", "x", "y")
    assert rows(df) == [(1, "a", None), (2, None, 0.5)]


def test_spread_only_where_there_are_few_splits(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(100).repartition(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert tables.read_table(spark, path, spread_by="id").rdd.getNumPartitions() == cores
    spark.range(100).repartition(2 * cores).write.mode("overwrite").parquet(path)
    plan = tables.read_table(spark, path, spread_by="id")._jdf.queryExecution().executedPlan().toString()
    splits = tables.read_table(spark, path).rdd.getNumPartitions()
    assert ("Exchange" in plan) == (splits < cores)


def test_lookup_size_is_measured(spark):
    df = spark.createDataFrame([("ab", 1.0), (None, 2.0)], "term string, x double")
    assert runtime.payload_bytes(df) == (2 + 16 + 8) + (0 + 16 + 8)
    assert runtime.fits_broadcast(df) and not runtime.fits_broadcast(df, max_bytes=10)


def test_shared_folder_comes_from_the_session(spark):
    class Session:
        """Only what the rule looks at."""

        def __init__(self, master, folder):
            self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})

    assert runtime.shared_folder(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert runtime.shared_folder(Session("local[8]", None)).endswith("/run-app-1")
    with pytest.raises(RuntimeError):
        runtime.shared_folder(Session("yarn", None))
    assert runtime.fresh_path(spark, "x") != runtime.fresh_path(spark, "x")


def test_intermediate_data_is_accounted_for_and_released(spark, tmp_path):
    from gripelens import runtime

    before = set(runtime.made_paths())
    table = runtime.materialise(spark.range(5).toDF("x"), "probe")
    mine = [p for p in runtime.made_paths() if p not in before]
    assert table.count() == 5 and len(mine) == 1
    runtime.release(spark, mine)
    assert set(runtime.made_paths()) == before
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(mine[0])
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
