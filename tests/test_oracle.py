"""Every registered query against its DuckDB oracle (exact values)."""

import os
import sys

import pytest

import __spark_entry__ as entry
from tributary.plans.queries import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
from oracle_check import compare, duck_connection  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    res = compare(spark, SF, name, entry.queries()[name], sql, con)
    assert res["status"] in ("ok", "rows-only"), res
    assert res["rows"] > 0, res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ano", "mes", "loja_id", "total_vendas", "meta_total", "pct_meta"]
