"""Every registered query equals its DuckDB oracle on the smoke tables (whole tables)."""

import pytest

from marketlens.registry import QUERIES
from marketlens.testing.compare import compare, duck_connect
from marketlens.testing.oracle_sql import ORACLE_SQL


@pytest.fixture(scope="module")
def con(smoke_dir):
    return duck_connect(smoke_dir)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, smoke_dir, name):
    res = compare(QUERIES[name](spark, smoke_dir), con, ORACLE_SQL[name])
    assert res["ok"], res
