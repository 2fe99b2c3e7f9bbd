"""Every registered query against its DuckDB oracle on the smallest scale
factor (the driver repeats this at sf0.01)."""

import os

import pytest

from tools.oracle_check import compare, duck

import __spark_entry__ as E
from bourse.plans import registry

registry.load_all()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE
SF = os.environ.get("BOURSE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, QUERIES[name], ORACLE.get(name), con)
    assert r["status"] == "ok", r
    assert "type_mismatch" not in r, r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["security_code", "exchange_code", "base_date", "base_close", "reference_date",
                          "reference_close", "performance", "period"]
    assert df.count() > 0
