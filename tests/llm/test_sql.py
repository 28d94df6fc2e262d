"""Queries against their SQL, all rows."""

import pytest

from compare import compare, connect
from tickloom.llm.queries import all_oracles, all_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query(spark, name):
    assert compare(spark, connect(SF), all_queries()[name], all_oracles()[name], SF) is None
