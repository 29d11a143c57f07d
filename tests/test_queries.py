"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 1000 and "value_w3_mean" in df.columns


def test_every_oracle_has_a_query():
    assert not set(ORACLES) - set(QUERIES)
