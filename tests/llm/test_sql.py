"""Operators that SQL can express, against DuckDB."""

import os

import pytest
from oracle import connect, differences

from rasterloom.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert differences(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) == ""
