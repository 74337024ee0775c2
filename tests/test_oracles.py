"""Every registered query against its SQL counterpart (sf0.001; set CHECK_SF_DIR for more)."""

import pytest

import __spark_entry__ as entry
from gripelens.checks.oracles import ORACLES
from gripelens.checks.registry import QUERIES
from tests.compare import connect, difference, spark_table, sql_table

ROWS_ONLY = {"sentence_stats_bi", "coef_table", "predictions", "tree_importance", "pooled_coefs"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_is_accounted_for():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    got = spark_table(QUERIES[name](spark, sf_dir))
    assert got[1], "no rows"
    if name in ORACLES:
        assert difference(got, sql_table(duck, ORACLES[name])) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
