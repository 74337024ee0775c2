import hashlib
import math

import pytest

from gripelens.operators import sampling as s


def md5(seed, x):
    return hashlib.md5(f"{seed}:{x}".encode()).hexdigest()


@pytest.fixture(params=[20_000, 1], ids=["one level", "many levels"])
def rank_limit(request, monkeypatch):
    """A tiny limit forces the search to descend through several prefixes."""
    monkeypatch.setattr(s, "_RANK_LIMIT", request.param)


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


@pytest.mark.parametrize("n", [0, 1, 17, 3000, 5000])
def test_uniform_is_the_lowest_hashes(spark, rank_limit, n):
    df = spark.range(3000)
    want = sorted(sorted(range(3000), key=lambda i: md5(33, i))[:n])
    assert ids(s.sample_uniform(df, n, "id")) == want
    assert ids(s.sample_uniform(df.repartition(7), n, "id")) == want


def test_bounded_draws_from_the_head_only(spark):
    got = ids(s.sample_bounded(spark.range(2000), 50, "id", buffer=200))
    assert got == sorted(sorted(range(250), key=lambda i: md5(42, i))[:50])


@pytest.mark.parametrize("n", [1, 399, 400, 1200, 1300, 10_000])
def test_files_with_one_hot_file(spark, rank_limit, n):
    """File f0 holds a third of all rows."""
    file_of = {i: "f0" if i % 3 == 0 else f"f{1 + i % 40}" for i in range(1300)}
    df = spark.createDataFrame(list(file_of.items()), "id bigint, file string")
    order = sorted(file_of, key=lambda i: (md5(33, file_of[i]), md5(33, i)))
    assert ids(s.sample_files(df, n, "id", "file")) == sorted(order[:n])


def test_files_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, file string")
    assert s.sample_files(df, 5, "id", "file").count() == 0


@pytest.mark.parametrize("n", [5, 10, 399, 1000])
def test_split_sizes_and_determinism(spark, rank_limit, n):
    label_of = {i: 1 if i % 4 == 0 else 0 for i in range(n)}
    df = spark.createDataFrame([(i, c) for i, c in label_of.items()], "id bigint, y int")
    test = ids(s.stratified_split(df, "y", "id").where("is_test"))
    assert len(test) == math.ceil(0.2 * n)
    assert ids(s.stratified_split(df.repartition(5), "y", "id").where("is_test")) == test
    for c in (0, 1):
        rows = [i for i in label_of if label_of[i] == c]
        share = sum(i in set(test) for i in rows)
        assert abs(share - 0.2 * len(rows)) < 1
        assert sorted(rows, key=lambda i: md5(33, i))[:share] == sorted(
            (i for i in test if label_of[i] == c), key=lambda i: md5(33, i)
        )


def test_train_quotas_follow_largest_remainders():
    assert s.train_quotas({0: 299, 1: 100}, 0.2) == {0: 239, 1: 80}
    assert s.train_quotas({0: 3027, 1: 953}, 0.2) == {0: 2422, 1: 762}


def test_plan_keeps_rows_in_place(spark):
    """The sample itself is a filter: no shuffle and no sort of the sampled rows."""
    plan = s.sample_uniform(spark.range(1000), 10, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
