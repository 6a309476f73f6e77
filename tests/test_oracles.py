"""Differential tests: every query key against its DuckDB oracle on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from ledgerlight.oracles import ORACLES  # noqa: E402
from ledgerlight.registry import QUERIES  # noqa: E402
from oracle_check import duck, rows  # noqa: E402

KEYS = sorted(ORACLES)


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(entry.oracle_sql())
    assert not missing


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, small_dir, key):
    got = entry.queries()[key](spark, small_dir).toPandas()
    exp = con.execute(entry.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert rows(got) == rows(exp)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["Store_ID", "Period", "CY_Amount", "PY_Amount", "National_Sales_CY", "Periodo_Sort"]
