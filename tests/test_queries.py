"""Every registered query against its SQL on the given tables."""

import pytest
from compare import differences, open_tables

from carestrata.oracle import all_sql
from carestrata.registry import all_queries

SQL = all_sql()


@pytest.fixture(scope="module")
def tables(sf_dir):
    return open_tables(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(all_queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, sf_dir, tables, name):
    assert differences(all_queries()[name](spark, sf_dir), tables, SQL[name]) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["age_group", "age_group_sort_order", "total_encounters"]
