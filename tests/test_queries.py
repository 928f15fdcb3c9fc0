"""Every registered query against the same result as DuckDB SQL."""

import glob
import os

import pytest

import __spark_entry__ as driver
from workload.catalog import QUERIES
from workload.oracle import ORACLE

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = driver.queries()[name](spark, SF_DIR)
    rows = df.collect()
    want = db.execute(driver.oracle_sql()[name])
    names = [d[0] for d in want.description]
    expected = multiset(names, want.fetchall())
    assert sorted(df.columns) == sorted(names)
    types = db.execute(f"DESCRIBE {driver.oracle_sql()[name]}").fetchall()
    assert {t[0]: TYPES[t[1]] for t in types} == dict(df.dtypes)
    assert rows
    assert multiset(df.columns, rows) == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
