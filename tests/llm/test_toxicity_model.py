"""The toxicity model's counts and ratios against dictionaries."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from gripelens.llm import toxicity


def plain_ratios(texts, discount, margin):
    """word -> evidence, from (text, toxic) pairs, by the formula of the module's docstring."""
    pairs = set()
    for text, toxic in texts:
        words = re.findall(r"[^\W_]+", text.lower())
        pairs |= {(w, v, toxic) for w, v in zip(words, [None, *words])}
    n = [{}, {}]
    for w, _, toxic in pairs:
        n[toxic][w] = n[toxic].get(w, 0) + 1
    totals = [sum(c.values()) for c in n]
    d = [discount * t / sum(totals) for t in totals]
    out = {}
    for w in set(n[0]) | set(n[1]):
        counts = [c.get(w, 0) for c in n]
        if all(k <= off for k, off in zip(counts, d)):
            continue
        shared = sum(min(k, off) for k, off in zip(counts, d)) / sum(totals)
        p = [max(k - off, 0) / t + shared for k, off, t in zip(counts, d, totals)]
        ratio = math.log(p[1] / p[0])
        beyond = max(abs(ratio) - margin, 0)
        out[w] = math.copysign(beyond + 0.001 * (abs(ratio) - beyond), ratio)
    return out


@pytest.mark.parametrize("discount,margin", [(20, 1.0), (3, 0.0), (3, 1.0)])
def test_ratios_equal_dictionaries(spark, discount, margin):
    rnd = random.Random(discount)
    common, marked = [f"c{i}" for i in range(40)], [f"bad{i}" for i in range(5)]
    texts = []
    for i in range(300):
        toxic = int(i % 4 == 0)
        words = rnd.choices(common, k=rnd.randint(0, 60)) + (rnd.choices(marked, k=4) if toxic else [])
        rnd.shuffle(words)
        texts.append((", ".join(words), toxic))
    texts += texts[:50] * 3  # copies count once
    rows = spark.createDataFrame(texts, "text string, toxic int")
    counts = toxicity.continuation_counts(rows.select(toxicity.words(F.col("text")).alias("words"), "toxic"))
    got = {r.word: r.ratio for r in toxicity.ratio_table(counts, discount, margin).collect()}
    named = spark.createDataFrame([(w,) for w in common + marked], "w string").select("w", F.xxhash64("w").alias("h"))
    hashes = {r.w: r.h for r in named.collect()}
    want = {hashes[w]: v for w, v in plain_ratios(texts, discount, margin).items()}
    assert got.keys() == want.keys() and want
    assert [got[h] for h in sorted(got)] == pytest.approx([want[h] for h in sorted(got)])


def test_marked_stems_are_found_beside_words_that_only_tell_languages_apart(spark, docs):
    """One class holds more of one language; what marks a text are a few rare words."""
    rnd = random.Random(2)
    tongues = [[f"{p}{i}" for i in range(600)] for p in ("aa", "bb")]
    marked = [[f"{p}x{i}" for i in range(6)] for p in ("aa", "bb")]
    texts, toxic = [], []
    for i in range(3200):
        bad, tongue = int(i % 8 == 0), int(rnd.random() < (0.6 if i % 8 == 0 else 0.3))
        words = rnd.choices(tongues[tongue], k=150) + (rnd.choices(marked[tongue], k=5) if bad else [])
        rnd.shuffle(words)
        texts.append(" ".join(words))
        toxic.append(bad)
    half = spark.createDataFrame([(i + 1, t) for i, t in enumerate(toxic) if i < 2400], "doc_id bigint, toxic int")
    model = toxicity.train(docs(texts), half)
    scores = {r.doc_id: r.score for r in model.score(docs(texts)).collect()}
    unseen = [(scores[i + 1] >= 0.7, bool(t)) for i, t in enumerate(toxic) if i >= 2400]
    assert sum(a == b for a, b in unseen) >= 0.98 * len(unseen)


def test_long_texts_lose_their_lines_in_linear_time(docs):
    from gripelens.llm.line_dedup import LineDedup

    lines = [f"line {i % 30_000} of a long list" for i in range(60_000)]
    r = LineDedup(percent=100).run(docs(["\n".join(lines)])).first()
    assert (r.n_lines, r.n_removed, r.text) == (60_000, 30_000, "\n".join(lines[:30_000]))
