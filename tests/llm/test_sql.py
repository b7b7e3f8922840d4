"""The queries that SQL can express, against it."""

import pytest
from compare import differences, open_tables

from carestrata.llm.queries import llm_queries
from carestrata.llm.sql import llm_sql


@pytest.mark.parametrize("name", list(llm_sql()))
def test_query(spark, sf_dir, name):
    assert differences(llm_queries()[name](spark, sf_dir), open_tables(sf_dir), llm_sql()[name]) == []


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in llm_queries())
    assert numbers == list(range(1, 14)) and set(llm_sql()) <= set(llm_queries())
