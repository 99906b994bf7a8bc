"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from nestmeans.catalog.oracles import ORACLES
from nestmeans.catalog.queries import QUERIES
from compare import DATA, difference, duck, duck_rows, spark_rows, type_difference

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df, sql = entry_point.queries()[name](spark, FOLDER), entry_point.oracle_sql()[name]
    assert type_difference(df, con, sql) is None
    assert difference(spark_rows(df), duck_rows(con, sql)) is None


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["vec_id", "cluster_k1", "CLUSTER_k2", "DISTANCE_k2"]
    assert result.count() > 0
