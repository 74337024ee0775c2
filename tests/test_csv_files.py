"""CSV exports whose files one task can read."""

import glob

from gripelens.checks import registry
from gripelens.sources import tables


def test_files_hold_no_more_rows_than_asked(spark, tmp_path):
    rows = spark.range(100).selectExpr("concat('a\\n\"', id) AS review", "'one' AS user").repartition(2, "user")
    tables.write_csv(rows, str(tmp_path / "csv"), rows_per_file=10)
    files = glob.glob(str(tmp_path / "csv" / "*.csv"))
    counts = [spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f).count() for f in files]
    assert len(files) == 10 and max(counts) == 10
    back = tables.read_csv_folder(spark, str(tmp_path / "csv"), "review string, user string", file_col=None)
    assert sorted(r.review for r in back.collect()) == sorted(f'a\n"{i}' for i in range(100))


def test_create_steam_splits_a_platform_over_files(spark, sf_dir, monkeypatch):
    asked, write = [], tables.write_csv
    monkeypatch.setattr(tables, "write_csv", lambda df, path, **k: asked.append(k) or write(df, path, **k))
    assert registry.QUERIES["create_steam"](spark, sf_dir).count() == 70
    assert asked == [{"rows_per_file": registry.CSV_ROWS}]
