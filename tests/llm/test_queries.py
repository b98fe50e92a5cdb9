"""The queries that SQL can express, against DuckDB; the names that the driver looks for."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill.llm import queries


def test_names():
    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == columns
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == Counter(want.select(*columns).fetchall())
