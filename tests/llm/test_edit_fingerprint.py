"""Edit-embedding fingerprints: the walk step by step, planted edits, neighbours, bands."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gripelens.llm import edit_fingerprint as ef
from gripelens.llm.registry import QUERIES


def plain_emitted(text, walk):
    """(segment, step) -> code point class, by walking one code point at a time."""
    classes, bits = ef._shared()
    out, cuts = {}, list(range(0, len(text), ef.SEGMENT))
    if len(cuts) > 1 and len(text) - cuts[-1] < ef.SEGMENT // 2:
        cuts.pop()
    for number, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(text)])):
        step = 0
        while a < b:
            symbol = int(classes[ord(text[a])])
            out[number, step] = symbol
            a += int(bits[step][walk * 256 + symbol])
            step += 1
    return out


def like(a, b):
    if not a or not b:
        return float(a == b)
    return max(sum(x == y for x, y in zip(a, b)) / ef.SAMPLES * 16 / 15 - 1 / 15, 0)


@pytest.mark.parametrize("length", [1, 5, 300, 4096, 6143, 6144, 9000])
def test_sampled_symbols_equal_a_plain_walk(length):
    rnd = random.Random(length)
    text = "".join(rnd.choice("abc é漢😀") for _ in range(length))
    other = "".join(rnd.choice("ab") for _ in range(777))
    classes, _ = ef._shared()
    _, number, size = ef._segments(np.array([len(other), length]))
    points = np.frombuffer((other + text).encode("utf-32-le"), np.uint32)
    got = ef._walked(classes.take(points), size)[:, 1:]
    steps, firsts = ef._samples()
    assert len(firsts) == ef.SAMPLES
    walks = [plain_emitted(text, w) for w in range(ef.WALKS)]
    for row, step in enumerate(steps.tolist()):
        walk = (np.searchsorted(firsts, row, side="right") - 1) // ef.BINS
        assert [int(x) for x in got[row]] == [walks[walk].get((n, step), 0) for n in number[1:].tolist()]


def test_likeness_follows_edits():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("etaoin shrdlu") for _ in range(3000)) for _ in range(40)]

    def changed(text, k):
        s = list(text)
        for _ in range(k):
            at = rnd.randrange(len(s))
            s[at : at + rnd.choice([0, 1])] = rnd.choice(["", "q"])
        return "".join(s)

    base = ef.fingerprints(texts)
    means = [np.mean([like(a, b) for a, b in zip(base, ef.fingerprints([changed(t, k) for t in texts]))]) for k in (0, 2, 20, 200)]
    assert means[0] == 1 and means[1] > 0.9 and means[1] > means[2] > means[3]
    assert np.mean([like(a, b) for a, b in zip(base, base[1:])]) < 0.2
    assert min(like(a, b) for a, b in zip(base, ef.fingerprints([t[:2000] + t[:1000] for t in texts]))) > 0.45


def test_equal_texts_alone_or_in_company():
    texts = ["", "a", "ab", "abc " * 5000, "x" * 9000, "漢字😀"]
    together = ef.fingerprints(texts + texts[::-1])
    assert together[:6] == together[:5:-1] and together[0] == ""
    assert [ef.fingerprints([t])[0] for t in texts] == together[:6]
    assert all(len(f) == ef.SAMPLES for f in together[1:6])


def plain_beside(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        k = len(text) // 3
        out.append((doc, len(text), text[: len(text) - k] + after[:k], text, after))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_next_documents_across_partitions(spark, parts):
    rnd = random.Random(9)
    rows = [(i, rnd.choice([None, "", "é😀", "abc " * rnd.randint(1, 400)]) if i % 5 else "z" * 9000) for i in range(60)]
    rows.append((None, "without id"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("part", F.lit("mine")).repartition(parts)
    got = {r.doc_id: r for r in ef.beside_next(df).collect()}
    assert len(got) == len(rows)
    for doc, n, text, own, after in plain_beside(rows):
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())
        assert [r.fingerprint, r.edited_fingerprint, r.next_fingerprint] == ef.fingerprints([own, text, after])


def test_one_document_repeated_rows_and_no_documents(spark):
    one = spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")
    assert ef.beside_next(one).first().edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    twice = ef.beside_next(one.union(one)).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    assert ef.beside_next(one.limit(0)).count() == 0
    named = ef.fingerprint(one.withColumn("fingerprint", F.lit(1)).union(spark.sql("select null, null, 2")))
    assert named.columns == ["doc_id", "text", "fingerprint"]
    assert sorted(r.fingerprint for r in named.collect()) == ["", *ef.fingerprints(["abcdef"])]


def test_bands_find_near_documents(spark):
    rnd = random.Random(1)
    texts = {100 * i: "".join(rnd.choice("etaoin shrdlu") for _ in range(2500)) for i in range(1, 30)}
    rows = dict(texts)
    for doc, text in list(texts.items())[:15]:
        rows[doc + 1], rows[doc + 2] = text, text[:1200] + "#" + text[1200:]
    rows[7] = ""
    ids, prints = list(rows), ef.fingerprints(list(rows.values()))
    df = spark.createDataFrame(list(zip(ids, prints)), "doc_id bigint, fingerprint string")
    near = {r.fingerprint: r.near_id for r in ef.near_first(df).collect()}
    assert "" not in near and set(near) == set(prints) - {""}
    got = {i: near[p] for i, p in zip(ids, prints) if p}
    assert all(got[d] == d for d in texts) and all(got[d + 1] == d for d in list(texts)[:15])
    assert sum(got[d + 2] == d for d in list(texts)[:15]) >= 13


def test_query_equals_plain_version(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op13_edit_fingerprints"](spark, sf_dir).collect()}
    want = plain_beside(rows)
    assert len(got) == len(want)
    for (doc, n, text, own, after), a, b, c in zip(
        want, *(ef.fingerprints([w[k] for w in want]) for k in (3, 2, 4))
    ):
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (a, b)
        assert r.near_edited == pytest.approx(like(a, b)) and r.near_next == pytest.approx(like(a, c))
        assert r.near_id <= doc
