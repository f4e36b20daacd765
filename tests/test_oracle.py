"""Every query against its DuckDB counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tillspan.catalog import QUERIES as CATALOG
from tools.check import SAME, duck, ordered

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return duck(SF_DIR)


def test_every_retail_query_has_an_oracle():
    assert set(CATALOG) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SF_DIR)
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    duck_types = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(columns)
    assert {f.name: SAME[f.dataType.simpleString()] for f in df.schema.fields} == duck_types
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(result.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
