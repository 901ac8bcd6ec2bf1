"""Every registered query against its reference SQL on the same files."""

import pytest

import __spark_entry__ as contract
from tests.compare import rows_of, rows_of_duck

ORACLE = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_reference_sql(spark, duck, folder, name):
    columns, rows = rows_of(QUERIES[name](spark, folder))
    expected_columns, expected = rows_of_duck(duck, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_all_reference_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_other_queries_run(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
