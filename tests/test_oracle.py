"""Every named query against its SQL on the smallest sample tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_check import compare, connect  # noqa: E402

from gridtide.catalog import ORACLES, QUERIES  # noqa: E402

DATA = os.environ.get("GRIDTIDE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables not present")


@pytest.fixture(scope="module")
def sql():
    con = connect(DATA)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sql, name):
    assert compare(QUERIES[name](spark, DATA).toPandas(), sql.sql(ORACLES[name]).df()) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["pacf", "backtest", "validate_model"])
def test_query_without_sql_runs(spark, name):
    rows = QUERIES[name](spark, DATA).collect()
    assert rows
    if name == "pacf":
        assert all(r.pacf == 1 for r in rows if r.lag == 0)
    if name == "validate_model":
        assert rows[0].valid
