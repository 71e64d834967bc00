"""Every registered query against its DuckDB oracle (the driver's correctness gate), at sf0.001."""

import pytest

import __spark_entry__ as E
from strata.plans import registry
from tests.oracle_compare import compare, duck

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES.get(name), sf, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_type", "n"] and df.count() > 0


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLES)) == []
