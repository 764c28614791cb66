"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def order(row):
    return [(v is None, str(type(v)), v if v is not None else 0) for v in row]


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    if name not in ORACLES:
        assert got.columns
        return
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(got.columns) == sorted(columns)
    names = sorted(columns)
    theirs = [tuple(r[columns.index(c)] for c in names) for r in expected.fetchall()]
    ours = [tuple(r[c] for c in names) for r in got.collect()]
    assert len(ours) == len(theirs)
    for a, b in zip(sorted(ours, key=order), sorted(theirs, key=order), strict=True):
        assert all(same(x, y) for x, y in zip(a, b, strict=True)), dict(
            (n, (x, y)) for n, x, y in zip(names, a, b, strict=True) if not same(x, y)
        )
