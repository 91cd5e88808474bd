"""Every query with a SQL twin gives the same rows, columns and value types in both engines."""

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from roadtally.plans.catalog import QUERIES
from roadtally.plans.oracle import ORACLE
from tests.compare import connect, kinds, rows_of_duckdb, rows_of_spark

@pytest.fixture(scope="module")
def duck(sf_dir):
    with connect(sf_dir) as con:
        yield con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, duck, sf_dir, name):
    columns, rows = rows_of_spark(queries()[name](spark, sf_dir))
    expected_columns, expected = rows_of_duckdb(duck, oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected
    assert kinds(rows) == kinds(expected)


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_entry_loads_without_a_library_of_the_text_operators():
    """In a process of its own, where the library cannot be imported."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(QUERIES)), str(len(ORACLE))]


def test_entry(spark):
    flagship = entry(spark)
    assert flagship.columns[:3] == ["event_date", "lat_grid", "lon_grid"]
    assert flagship.count() > 0
