"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import os
import re
import sys

import pytest
from tests_support import SF_SMOKE

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

# the optional training-data queries have their own tests
NAMES = sorted(n for n in E.queries() if not re.fullmatch(r"op\d+_\w+|pipeline", n))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMOKE, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert res["status"] == "MATCH", res
    assert res["spark_rows"] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "category"
