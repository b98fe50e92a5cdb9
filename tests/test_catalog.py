"""Every query that has SQL gives the rows that DuckDB gives on the same tables."""

from collections import Counter

import duckdb
import pytest

from corpusmill.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want = duck.sql(sql)
    assert sorted(want.columns) == columns
    assert Counter(rows) == Counter(want.select(*[f'"{c}"' for c in columns]).fetchall())
