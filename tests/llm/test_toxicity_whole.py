"""No pair of the counted texts is left out, however rare it is, and large tables score as arrays do."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gripelens.llm import toxicity


def ordered_texts(n, toxic):
    """Texts of the classes hold the same words; two of them stand in another order."""
    rnd, texts = random.Random(n), []
    for i in range(n):
        words = rnd.choices([f"c{k}" for k in range(60)], k=12)
        for _ in range(3):
            at = rnd.randint(0, len(words))
            words[at:at] = ["kill", "them"] if toxic(i) else ["them", "kill"]
        texts.append(" ".join(words))
    return texts


def test_every_pair_is_counted(spark):
    texts = [("one two three", 1), ("one two four", 0), ("two one", 0), ("", 0)]
    rows = spark.createDataFrame(texts, "text string, toxic int")
    counts = toxicity.continuation_counts(rows.select(toxicity.words(F.col("text")).alias("words"), "toxic"))
    named = spark.createDataFrame([(w,) for t, _ in texts for w in t.split()], "w string").select("w", F.xxhash64("w").alias("h"))
    names = {0: "", **{r.h: r.w for r in named.collect()}}
    got = {(names[r.before], names[r.word]): (r.toxic, r.ordinary) for r in counts.where("before IS NOT NULL").collect()}
    assert got == {
        ("", "one"): (1, 1), ("one", "two"): (1, 1), ("two", "three"): (1, 0), ("two", "four"): (0, 1),
        ("", "two"): (0, 1), ("two", "one"): (0, 1),
    }


def test_pairs_of_rare_words_tell_texts_apart(spark, docs):
    toxic = lambda i: i % 4 == 0
    texts = ordered_texts(480, toxic)
    labels = spark.createDataFrame([(i + 1, int(toxic(i))) for i in range(360)], "doc_id bigint, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.train(docs(texts), labels).score(docs(texts)).collect()}
    assert sum((scores[i + 1] >= 0.7) == toxic(i) for i in range(360, 480)) >= 0.9 * 120


def test_pipeline_drops_texts_that_only_pairs_give_away(spark, docs, tmp_path):
    toxic = lambda i: i % 3 == 0
    texts = ordered_texts(480, toxic)
    rows = [(i + 1, 1, int(toxic(i))) for i in range(480)]
    spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs(texts), str(tmp_path)).collect()}
    assert sum((i + 1 in kept) != toxic(i) for i in range(480)) >= 0.9 * 480


@pytest.mark.parametrize("sent", [1, 40, 400])
def test_large_tables_score_as_arrays(spark, docs, monkeypatch, sent):
    texts = ordered_texts(240, lambda i: i % 3 == 0)
    texts += [texts[0], texts[1], None, "", " ".join(texts[:100])]
    labels = spark.createDataFrame([(i + 1, int(i % 3 == 0)) for i in range(240)], "doc_id bigint, toxic int")
    rows = docs(texts).withColumn("w", toxicity.words(F.col("text")))

    def evidence():
        found = toxicity.train(docs(texts), labels).with_evidence(rows, "w").collect()
        return {r.doc_id: r._evidence for r in found}

    small = evidence()
    monkeypatch.setattr(toxicity, "TABLE_WORDS", sent)
    large = evidence()
    assert large.keys() == small.keys() and len({e.total for e in small.values()}) > 100
    for field in ("total", "lower", "n"):
        assert [large[i][field] for i in sorted(small)] == pytest.approx([small[i][field] for i in sorted(small)], abs=1e-6)
