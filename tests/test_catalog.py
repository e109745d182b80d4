"""Every catalog query against its DuckDB oracle on the smallest driver
tables (row count, column names, types, exact value hash)."""

import duckdb
import pytest

import __spark_entry__ as E
from recaudo.plans.catalog import ORACLES, QUERIES
from recaudo.sources.tables import TABLES
from tools.check_oracle import spark_type, table_hash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


ROWS_ONLY: set[str] = set()     # every entry has an oracle


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    stypes = {f.name: spark_type(f.dataType.simpleString()) for f in df.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert table_hash(df.columns, srows)[0] == table_hash(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == E.entry(spark).columns
