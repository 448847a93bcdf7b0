"""Queries of the llm subpackage that have SQL, against DuckDB."""

import pytest

from floodmark.llm import queries
from tests.conftest import assert_same


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    assert_same(queries.queries()[name](spark, sf_dir), duck, queries.oracle_sql()[name])
