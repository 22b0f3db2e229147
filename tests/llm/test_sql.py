"""Queries that other test files do not hold against their SQL."""

import pytest
from compare import differences

from quayside.llm import queries, sql


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_tag_paths", "op13_collocations"])
def test_equals_sql(spark, sf_dir, name):
    assert differences(queries.queries()[name](spark, sf_dir), sql.oracle_sql()[name], sf_dir) == []
