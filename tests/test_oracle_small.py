"""Every registered query against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, digest
from strata.plans import catalog
from tests.conftest import SF_SMALL

SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
    otypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    for col, t in df.dtypes:
        assert SPARK_TO_DUCKDB.get(t, t) == otypes[col], (col, t, otypes[col])


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["url", "num_units", "conversion_rate"]
    df.collect()
