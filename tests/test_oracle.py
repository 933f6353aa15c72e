"""Every registered query against its DuckDB oracle (driver's correctness gate)."""

import os

import pytest

import __spark_entry__ as entry_mod
from oracle_check import compare, duck_connection
from skewkit.plans.registry import all_queries

SF_DIR = os.environ.get("SKEWKIT_TEST_SF", "/root/testdata/sf0.001")
# the corpus operators' queries, if present, have tests of their own
QUERIES = {k: v for k, v in entry_mod.queries().items() if k in all_queries()}
ORACLE = {k: v for k, v in entry_mod.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(QUERIES[name](spark, SF_DIR), duck, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["event_type", "user_id", "cnt", "rn"]
    assert df.count() > 0
