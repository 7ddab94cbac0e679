"""Every registered query of the package against its SQL, or for rows."""

import oracle
import pytest

from hitlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, tables, name):
    run, sql = QUERIES[name]
    result = run(spark, sf_dir)
    if sql:
        assert oracle.compare(result, tables, sql) is None
    else:
        assert result.count() > 0
