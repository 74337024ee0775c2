import random

import corpus_pipeline
import pytest


@pytest.fixture
def folder(spark, docs, tmp_path):
    rng = random.Random(6)

    def text(n):
        return "\n".join(" ".join(f"w{rng.randrange(20_000)}" for _ in range(12)) for _ in range(n))

    item = " ".join(f"q{i}" for i in range(30))
    texts = [text(6) for _ in range(420)]
    for i in range(0, 390, 3):
        words = texts[i].split(" ")
        for _ in range(8):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "foul"]))
        texts[i] = " ".join(words)
    near = texts[400].replace("\n", " ")
    texts += [texts[1], near + " more", near + " less", f"{text(3)}\n{item}\n{text(3)}", "", None]
    table = docs(texts).selectExpr("*", "doc_id * 2 AS n_removed", "'x' AS score")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i + 1, 0, int(i % 3 == 0)) for i in range(390)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_every_stage_takes_effect(spark, folder):
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    toxic = {i + 1 for i in range(0, 390, 3)}
    assert len(toxic & set(rows)) <= 6  # rejected, up to the model's errors
    clean = set(range(1, 421)) - toxic
    assert len(clean - set(rows)) <= 3
    assert 421 not in rows  # a copy: nothing is left of it
    # The second repeats the first's only line; the first is a near copy of 401, which stays.
    assert not {422, 423} & set(rows) and 401 in rows
    assert 424 not in rows  # holds the benchmark item
    assert rows[425]["text"] == "" and rows[426]["text"] is None
    assert all(r["round_trip"] and r["n_removed"] == 2 * i and r["score"] == "x" for i, r in rows.items())
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in rows.values())


def test_stage_names_and_columns(spark, folder):
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0, name
