"""Every query of the library that has SQL, against DuckDB on the same files."""

import pytest

from floodmark.plans import registry
from tests.conftest import assert_same


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    assert_same(registry.queries()[name](spark, sf_dir), duck, registry.oracle_sql()[name])
