"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

from __spark_entry__ import oracle_sql, queries

from .oracle_check import compare, duck

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    problems = compare(df, con, oracle_sql()[name])
    assert not problems, f"{name}: {problems}"


def test_every_query_has_a_builder():
    assert set(oracle_sql()) <= set(queries())
