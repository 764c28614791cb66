"""The registered queries against their SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

from panelcraft.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    rows = got.collect()
    assert rows
    if name not in ORACLES:
        return
    connection = duckdb.connect()
    for t in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    expected = connection.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(r[c] for c in columns) for r in rows) == sorted(expected.fetchall())
