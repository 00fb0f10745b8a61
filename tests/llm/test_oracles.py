"""Queries next to their SQL."""

from __future__ import annotations

import duckdb
import pytest

from wattshed.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    assert sorted(con.sql(ORACLES[name]).columns) == columns
    theirs = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(theirs, key=str)
