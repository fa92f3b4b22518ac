"""Every registered query against its DuckDB twin at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry_mod
from oracle_check import compare, duck_connect
from runway import catalog, oracle

from conftest import SF_ORACLE, SF_SMALL

QUERIES = {k: v for k, v in entry_mod.queries().items() if k in catalog.QUERIES}
SQL = {k: v for k, v in entry_mod.oracle_sql().items() if k in oracle.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    n, problems = compare(spark, duck, name, QUERIES[name], SQL[name], SF_ORACLE)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["carrier", "origin", "dest", "count", "count2"]
    assert df.count() > 0
    assert df.schema == entry_mod.entry(spark).schema


def test_golden_busiest_route(spark):
    r = QUERIES["busiest_route"](spark, SF_ORACLE).first()
    assert (r.origin, r.dest, r.route_freq) == (9, 10, 291)
    assert QUERIES["busiest_route"](spark, SF_SMALL).count() == 1
