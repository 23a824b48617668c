"""Each registered query against its check SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import rows

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, TABLES)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got or name in ("low_quality_docs", "lookup_by_suffix")
    if name in oracle_sql():
        result = db.execute(oracle_sql()[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows(columns, result.fetchall()) == got


def test_entry(spark):
    assert entry(spark).count() == 200
