"""Pieces that keep coming up are merged once, however many others a worker meets."""

import random

import numpy as np
import pytest

from gripelens.llm import byte_bpe
from gripelens.llm.registry import vocabulary


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(vocabulary())


def test_common_pieces_stay(monkeypatch, ranks):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 300)
    codec, merged = byte_bpe.Codec(ranks), []
    merge = codec.merge
    monkeypatch.setattr(codec, "merge", lambda pieces: merged.extend(pieces) or merge(pieces))
    rnd = random.Random(5)
    common = ["".join(rnd.choices("abcdefgh", k=12)) for _ in range(40)]
    for _ in range(30):
        codec.encode([" ".join(common + ["".join(rnd.choices("qrstuvw", k=12)) for _ in range(60)])])
    assert max(map(merged.count, {f" {w}".encode() for w in common[1:]})) == 1


def test_pairs_in_the_open_table(ranks):
    codec = byte_bpe.Codec(ranks)
    pairs = {
        (codec.ranks[w[:i]], codec.ranks[w[i:]]): r
        for w, r in codec.ranks.items()
        for i in range(1, len(w))
        if w[:i] in codec.ranks and w[i:] in codec.ranks
    }
    left, right = np.array(list(pairs), np.int32).T
    assert codec._cost(left, right).tolist() == list(pairs.values())
    rnd = np.random.default_rng(1)
    left, right = rnd.integers(0, 50_000, (2, 200_000)).astype(np.int32)
    wanted = [pairs.get(p, byte_bpe._NEVER) for p in zip(left.tolist(), right.tolist())]
    assert codec._cost(left, right).tolist() == wanted


def test_short_pieces_beyond_the_table(monkeypatch, ranks):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 20)
    codec, rnd = byte_bpe.Codec(ranks), random.Random(7)
    for _ in range(3):
        words = ["".join(rnd.choices("aäb€c0\0!😀", k=rnd.randint(1, 6))) for _ in range(200)]
        texts = ["", " ".join(words[:120]), "\n".join(words[120:]), ""]
        ids, counts = codec.encode(texts)
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends):
            assert ids[a:b].tolist() == byte_bpe.Codec(ranks).encode([text])[0].tolist()
            assert codec.decode(ids[a:b])[0].tobytes() == text.encode()
        assert codec.short.count < 20 + 2 * 200 + 1
