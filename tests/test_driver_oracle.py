"""Every driver query equals its DuckDB oracle (multiset compare) at sf0.001."""

import re

import pytest

from tierwise.plans.driver import QUERIES
from tierwise.plans.oracle import ORACLE

from .oracle_harness import compare, duck


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, key):
    r = compare(spark, key, sf_small, con)
    assert r["ok"], r


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    own = {q for q in e.queries() if not re.match(r"op\d+_|pipeline$", q)}      # the others have tests of their own
    assert own == {q for q in e.oracle_sql() if not re.match(r"op\d+_|pipeline$", q)}
