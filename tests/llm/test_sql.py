"""Queries of the operators against their DuckDB SQL on the smallest tables."""
import os

import pytest

from oracle_check import compare, duck
from shelfwise.llm.queries import ORACLE, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    st = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert st["status"] == "ok", st
