"""Periodic runs against all lags and all words."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gripelens.llm.periodic_runs import Runs, periodic_runs
from gripelens.llm.registry import QUERIES


def plain_runs(words, least=12):
    """(start, length, period) by comparing all words at all lags."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - first + q >= max(least, 2 * q):
                found.setdefault((first - q, i - first + q), q)
            i += 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def some_words(rnd):
    names = [f"w{i}" for i in range(rnd.choice([1, 2, 2, 3, 5, 30]))]
    words = []
    for _ in range(rnd.randint(0, 6)):
        block = [rnd.choice(names) for _ in range(rnd.randint(1, rnd.choice([3, 9, 20, 60])))]
        words += block * rnd.choice([1, 1, 2, 3, 7, 20])
    return words[: rnd.choice([10, 50, 300, 700])]


def check(texts):
    found = Runs(texts)
    lists, collapsed = found.run_lists().to_pylist(), found.collapsed().to_pylist()
    for text, got, kept in zip(texts, lists, collapsed, strict=True):
        want = plain_runs(words_of(text))
        assert [(r["start"], r["length"], r["period"]) for r in got] == want
        assert kept == plain_collapsed(words_of(text), want)


@pytest.mark.parametrize("seed", range(8))
def test_equals_comparison_of_all_lags(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        check([" ".join(some_words(rnd)) for _ in range(rnd.randint(1, 5))])


@pytest.mark.parametrize(
    "text",
    [
        "x " * 200,
        "x " * 11,
        "a b " * 40 + "a " + "a b " * 40 + "a",
        "x " * 70 + "y " + "x " * 70 + "y " + "x " * 70,
        ("a b a a b " * 9 + "c ") * 5,
        " ".join(str(i % 64) for i in range(200)),
        " ".join(str(bin(i).count("1") % 2) for i in range(512)),
        "\t é x y\n" * 20,
    ],
)
def test_periods_within_periods(text):
    check([text, "", text + " z", text])


def test_very_long_texts_stay_linear():
    found = Runs(["x " * 400_000 + "y " + "x " * 400_000])
    assert found.rows[:, 1:].tolist() == [[0, 400_000, 1], [400_001, 400_000, 1]]
    block = " ".join(str(i * i % 7919) for i in range(5000)) + " "
    assert Runs([block * 60]).rows.tolist() == [[0, 0, 300_000, 5000]]


def test_table_rules(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (4, "x y " * 6, "d"), (4, "x y " * 6, "d"), (None, "q", "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string").withColumn("n_words", F.lit("old"))
    got = periodic_runs(df).orderBy("doc_id").collect()
    assert periodic_runs(df).columns == ["doc_id", "text", "runs", "collapsed", "n_words"]
    assert [(r.doc_id, len(r.runs), r.collapsed, r.n_words) for r in got] == [
        (None, 0, "q", 1), (1, 0, "", 0), (2, 0, "", 0), (3, 0, "", 0), (4, 1, "x y", 12), (4, 1, "x y", 12)
    ]
    assert periodic_runs(df.limit(0)).count() == 0
    shorter = periodic_runs(spark.createDataFrame([("k " * 5,)], "text string"), least=4).first()
    assert [tuple(r) for r in shorter.runs] == [(0, 5, 1)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_plain_version(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op12_periodic_runs"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    made = 0
    for r in got:
        words = words_of(texts[r.doc_id])
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            made += 1
        if n > 2500:
            continue  # comparing all lags takes too long here; long texts are tested above
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert r.collapsed_sha256 == sha(plain_collapsed(words, runs))
    assert made
