"""Every registered query that has SQL gives the SQL's rows; the others give rows with distinct names."""

import pytest
from compare import connect, difference

from gleanery.plans.registry import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir).toPandas(), con.execute(ORACLE_SQL[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0
