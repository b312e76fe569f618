"""Every registered query against its SQL in DuckDB, on the smallest tables."""
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, con, sf_dir, name):
    mine, theirs, differences = compare(queries()[name](spark, sf_dir), con, oracle_sql()[name])
    assert not differences and mine == theirs > 0


def test_entry(spark, sf_dir):
    assert entry(spark).columns == [
        "series_id", "series_label", "best_year", "summed_value", "quarters_available", "status"
    ]
