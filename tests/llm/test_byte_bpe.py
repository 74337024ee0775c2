import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gripelens.llm.byte_bpe import ByteBpe, Codec, read_ranks
from gripelens.llm.token_counts import at_limits, length_histogram, length_table, quantiles

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
CODEC = Codec(read_ranks(PATH))
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
KNOWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def same(texts):
    ids, counts = CODEC.encode(texts)
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == KNOWN.encode_ordinary(text), text
        assert CODEC.decode(ids[a:b])[0].tobytes() == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abst're vldmN  \n\t\r'12é٣ñ!?.\xa0\x85\x1c　😀"), max_size=30), max_size=6))
def test_equals_the_library(texts):
    same(texts)


def test_long_pieces_and_long_texts():
    letters = random.Random(5)
    same(["a" * 3000, "'" * 2000, " " * 1500 + "x", "".join(letters.choice("abcdefgh") for _ in range(5000)), "", "ab" * 200_000])


def test_table_operator(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "it's  so", 7), (3, "it's  so", 7)], "id int, text string, ids int")
    bpe = ByteBpe.load(PATH)
    got = sorted(bpe.decode(bpe.encode(rows)).collect(), key=lambda r: r["id"])
    assert [(r["id"], r["n_tokens"], bytes(r["decoded"])) for r in got] == [
        (1, 0, b""), (2, 0, b""), (3, 4, b"it's  so"), (3, 4, b"it's  so"),
    ]
    one = bpe.encode(rows, decoded_col="again").orderBy("id").collect()
    assert [bytes(r["again"]) for r in one] == [bytes(r["decoded"]) for r in got]
    assert bpe.encode(rows.limit(0)).count() == 0
    assert bpe.decode(spark.createDataFrame([(None,)], "ids array<int>")).first()["decoded"] == b""


@pytest.mark.parametrize("lengths", [[], [0], [3, 3, 3], [0, 1, 1, 5, 1024, 1025, 5000, 5000]])
def test_length_table(spark, lengths):
    rows = spark.createDataFrame([(n,) for n in lengths], "n_tokens bigint")
    histogram = length_histogram(rows)
    got = {r["length"]: r for r in length_table(histogram).collect()}
    assert sorted(got) == sorted(set(lengths))
    for n, r in got.items():
        assert r["docs"] == lengths.count(n)
        assert r["docs_from"] == sum(x >= n for x in lengths)
        assert r["tokens_from"] == sum(x for x in lengths if x >= n)
        assert r["docs_upto"] == sum(x <= n for x in lengths)
        assert r["kept_tokens"] == sum(min(x, n) for x in lengths)
        assert r["lost_tokens"] == sum(max(x - n, 0) for x in lengths)
    if lengths:
        found = {r["context_limit"]: r for r in at_limits(histogram, [0, 2, 1024]).collect()}
        assert {k: r["kept_tokens"] for k, r in found.items()} == {k: sum(min(x, k) for x in lengths) for k in (0, 2, 1024)}
        middle = {r["share"]: r["length"] for r in quantiles(length_table(histogram), [0.5, 1.0]).collect()}
        assert middle[1.0] == max(lengths) and middle[0.5] == sorted(lengths)[-(-len(lengths) // 2) - 1]


def test_null_lengths_count_as_zero(spark):
    rows = spark.createDataFrame([(None,), (2,)], "n_tokens bigint")
    assert {r["length"]: r["docs"] for r in length_histogram(rows).collect()} == {0: 1, 2: 1}
