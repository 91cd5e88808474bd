"""Queries with a SQL twin give the same rows in both engines; a hint that the whole list is registered."""

import pytest

from roadtally.llm.queries import ORACLE, QUERIES
from tests.compare import connect, kinds, rows_of_duckdb, rows_of_spark


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, sf_dir, name):
    columns, rows = rows_of_spark(QUERIES[name](spark, sf_dir))
    with connect(sf_dir) as con:
        expected_columns, expected = rows_of_duckdb(con, ORACLE[name])
    assert columns == expected_columns and rows == expected and kinds(rows) == kinds(expected)


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(QUERIES) <= set(entry.queries())
