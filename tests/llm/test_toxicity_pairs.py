"""The bigram order of the toxicity model against dictionaries."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gripelens.llm import toxicity


def shrunk(ratio, margin):
    beyond = max(abs(ratio) - margin, 0)
    return math.copysign(beyond + 0.001 * (abs(ratio) - beyond), ratio)


def plain_model(texts, discount, margin):
    """evidence(words), by the formulas of the module's docstring."""
    pairs = [Counter(), Counter()]
    for words, toxic in texts:
        pairs[toxic].update(zip(["", *words], words))
    words = [Counter(w for _, w in c) for c in pairs]
    totals, n = [sum(c.values()) for c in words], [sum(c.values()) for c in pairs]
    d, off = ([discount * x / sum(t) for x in t] for t in (totals, n))
    seen = [Counter(), Counter()]
    taken = [Counter(), Counter()]
    for c in (0, 1):
        for (v, _), k in pairs[c].items():
            seen[c][v] += k
            taken[c][v] += min(k, off[c])

    def p_word(c, w):
        shared = sum(min(words[x][w], d[x]) for x in (0, 1)) / sum(totals)
        return max(words[c][w] - d[c], 0) / totals[c] + shared

    def keep(c, v):
        return taken[c][v] / seen[c][v] if seen[c][v] else 1.0

    def evidence(text):
        total = 0.0
        for v, w in zip(["", *text], text):
            alone = 0.0
            if any(words[c][w] > d[c] for c in (0, 1)):
                alone = shrunk(math.log(p_word(1, w) / p_word(0, w)), margin)
            lower = alone + shrunk(math.log(keep(1, v) / keep(0, v)), margin)
            if any(pairs[c][v, w] > off[c] for c in (0, 1)):
                p = [max(pairs[c][v, w] - off[c], 0) / max(seen[c][v], 1) + keep(c, v) * p_word(c, w) for c in (0, 1)]
                own = shrunk(math.log(p[1] / p[0]), margin)
                lower = own if abs(own - lower) >= toxicity.DEPARTURE else lower
            total += lower
        return total

    return evidence


@pytest.mark.parametrize("joined", [False, True])
def test_evidence_equals_dictionaries(spark, joined):
    rnd, texts = random.Random(4), []
    for i in range(300):
        words = rnd.choices([f"c{k}" for k in range(30)], k=rnd.randint(0, 50))
        for _ in range(2 * (i % 4 == 0)):
            at = rnd.randint(0, len(words))
            words[at:at] = ["x", "y"]
        if i % 4:
            words += ["y", "x"]
        texts.append((words, int(i % 4 == 0)))
    rows = spark.createDataFrame([(i, " ".join(w), t) for i, (w, t) in enumerate(texts)], "doc_id bigint, text string, toxic int")
    rows = rows.select("doc_id", "toxic", toxicity.words(F.col("text")).alias("words"))
    counts = toxicity.continuation_counts(rows, 3.0).persist()
    table = toxicity.ratio_table(counts, 3.0, 1.0).unionByName(toxicity.higher_order(counts, 3.0, 1.0, 3.0))
    if joined:
        made = toxicity.joined_evidence(rows, "words", table)
    else:
        found = table.toPandas().sort_values("word")
        made = rows.withColumn("_evidence", toxicity.evidence(found["word"].to_numpy(), found["ratio"].to_numpy())("words"))
    evidence = plain_model(texts, 3.0, 1.0)
    got = {r.doc_id: r._evidence for r in made.collect()}
    assert [got[i].n for i in range(300)] == [len(w) for w, _ in texts]
    assert [got[i].total for i in range(300)] == pytest.approx([evidence(w) for w, _ in texts], abs=1e-6)


def test_texts_that_differ_in_word_order_only_are_told_apart(spark, docs):
    rnd, texts, toxic = random.Random(6), [], []
    for i in range(1200):
        words = rnd.choices([f"c{k}" for k in range(200)], k=40)
        for _ in range(3):
            at = rnd.randint(0, len(words))
            words[at:at] = ["kill", "them"] if i % 4 == 0 else ["them", "kill"]
        texts.append(" ".join(words))
        toxic.append(int(i % 4 == 0))
    labels = spark.createDataFrame([(i + 1, t) for i, t in enumerate(toxic) if i < 900], "doc_id bigint, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.train(docs(texts), labels).score(docs(texts)).collect()}
    right = sum((scores[i + 1] >= 0.7) == bool(t) for i, t in enumerate(toxic) if i >= 900)
    assert right >= 0.95 * 300


def test_equal_texts_count_once(spark, docs, monkeypatch):
    counted, count = [], toxicity.continuation_counts
    monkeypatch.setattr(toxicity, "continuation_counts", lambda rows: counted.append(rows.count()) or count(rows))
    texts = [f"one two {i}" for i in range(40)] + ["again and again"] * 400
    labels = spark.createDataFrame([(i + 1, i % 2) for i in range(len(texts))], "doc_id bigint, toxic int")
    toxicity.train(docs(texts), labels)
    assert counted[0] <= 42
