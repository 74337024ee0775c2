"""Crowds that share a key: tables of the search stay in proportion, and the nearest is still exact."""

import random

import numpy as np

from gripelens.llm import edit_fingerprint as ef

DIGITS = "0123456789abcdef"


def test_crowds_make_no_table_of_pairs(spark, monkeypatch):
    rnd, rows = random.Random(4), {}

    def other(print_, places):
        out = list(print_)
        for at in places:
            out[at] = rnd.choice([d for d in DIGITS if d != out[at]])
        return "".join(out)

    # Strangers that share ten digits, the first of them before a crowd of which most are near each other.
    shared, base = "".join(rnd.choices(DIGITS, k=10)), "".join(rnd.choices(DIGITS, k=118))
    for i in range(300):
        rows[i] = shared + "".join(rnd.choices(DIGITS, k=118))
        rows[1000 + i] = shared + other(base, rnd.sample(range(118), rnd.randrange(4, 22)))
    written = {}

    def counted(df, name, *more):
        made = kept(df, name, *more)
        written[name] = max(written.get(name, 0), made.count())
        return made

    kept = ef.materialise
    monkeypatch.setattr(ef, "materialise", counted)
    prints = spark.createDataFrame(list(rows.items()), "doc_id bigint, fingerprint string")
    got = {r.doc_id: r.near_id for r in ef.near_first(prints).collect()}
    ids, digits = np.array(list(rows)), np.array([list(p) for p in rows.values()])
    for i, d in zip(ids, digits):
        assert got[i] == ids[(digits != d).sum(1) <= 24].min()
    # A class has 128 keys, ten of which all of them share; the crowd's pairs were 90,000 and more before.
    assert written["print-pairs"] <= 128 * len(rows) // 2
    assert all(n <= 128 * len(rows) for n in written.values()), written
