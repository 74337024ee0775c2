"""Candidates of op3 with enough of an item's words around them, against plain counting."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gripelens.llm import decontaminate as d


@pytest.mark.parametrize("at_a_time", [1_000_000, 50])
def test_enough_words_around(monkeypatch, at_a_time):
    monkeypatch.setattr(d, "AROUND_WORDS", at_a_time)
    rnd = random.Random(at_a_time)
    words = [np.array(rnd.choices(range(30), k=n), np.int32) for n in (1, 5, 8, 20, 70)]
    answers = [w[-3:] if len(w) > 7 else w[:0] for w in words]
    docs = [rnd.choices(range(-1, 30), k=n) for n in (0, 3, 40, 64, 500, 0)]
    docs += [[-1] * 50 + words[3].tolist() + [-1] * 90 + words[4].tolist()]
    h = d._Halves(pa.array(docs, pa.list_(pa.int32())))
    window, item = (x.ravel() for x in np.meshgrid(np.arange(h.count), np.arange(len(words))))
    got = {}
    for at, *where in d.Around(words, answers, 30).enough(h, window, item):
        got.update(zip(at.tolist(), zip(*[x.tolist() for x in where])))
    for i, (w, k) in enumerate(zip(window.tolist(), item.tolist())):
        doc = max(j for j in range(len(docs)) if h.first[j] <= w)
        n, begin = len(words[k]), (w - int(h.first[doc])) * d.HALF
        a, b = max(begin - n, 0), min(begin + 2 * d.HALF + n, len(docs[doc]))
        there = Counter(docs[doc][a:b])
        times = Counter(words[k].tolist())
        shared = min(sum(there[x] for x in times), sum(times[x] for x in times if there[x]))
        answered = len(answers[k]) > 0 and all(there[x] for x in answers[k].tolist())
        share = 1.0 if n < d.SHORT else d.PARAPHRASE_SHARE if answered else d.LCS_SHARE
        assert got.pop(i, None) == ((doc, a, b, answered) if shared >= n * share else None)
    assert not got
