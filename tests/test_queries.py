"""Every query beside its SQL."""

import pytest

import __spark_entry__ as entry_points
import check_sql

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check_sql.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    rows = QUERIES[name](spark, sf_dir).toArrow()
    assert len(set(rows.column_names)) == rows.num_columns
    if name in SQL:
        assert check_sql.compare(rows, duck.sql(SQL[name]).to_arrow_table()) == ""


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
