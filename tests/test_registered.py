"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry
import registered

QUERIES = {name: run for name, (run, _) in registered.all_queries().items()}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def tables(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, tables, name):
    result = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert oracle.compare(result, tables, SQL[name]) is None
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["match", "lang", "source"]


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.queries())
