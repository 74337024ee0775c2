"""The first near fingerprint against all pairs."""

import random

import pytest

from gripelens.llm import edit_fingerprint as ef

DIGITS = "0123456789abcdef"


def like(a, b):
    return max(sum(x == y for x, y in zip(a, b)) / len(a) * 16 / 15 - 1 / 15, 0)


def changed(rnd, print_, places):
    out = list(print_)
    for at in places:
        out[at] = rnd.choice([d for d in DIGITS if d != out[at]])
    return "".join(out)


@pytest.mark.parametrize("block", [512, 3])
def test_every_near_pair_counts(spark, monkeypatch, block):
    monkeypatch.setattr(ef, "BLOCK", block)
    rnd, prints = random.Random(block), []
    for _ in range(12):
        base = "".join(rnd.choices(DIGITS, k=128))
        prints.append(base)
        # At the threshold, spread evenly; just beyond it; and a part that many share.
        prints += [changed(rnd, base, range(k, 128, 128 // 24 + 1)[:24]) for k in range(4)]
        prints += [changed(rnd, base, rnd.sample(range(128), k)) for k in (1, 12, 24, 25, 24, 30)]
        prints += [base[:64] + "".join(rnd.choices(DIGITS, k=64)) for _ in range(4)]
    ids = rnd.sample(range(1000), len(prints))
    rows = list(zip(ids, prints)) + [(1000, prints[0]), (ids[5], prints[20]), (None, prints[1]), (2000, "")]
    got = {r.fingerprint: (r.doc_id, r.n_docs, r.near_id) for r in ef.near_first(spark.createDataFrame(rows, "doc_id bigint, fingerprint string")).collect()}
    named = [(i, p) for i, p in rows if i is not None and p]
    for p in {p for _, p in named}:
        mine = [i for i, q in named if q == p]
        near = min(i for i, q in named if like(p, q) >= 0.8 - 1e-12)
        assert got.pop(p) == (min(mine), len(mine), min(near, min(mine)))
    assert not got
