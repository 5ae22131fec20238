"""Every registered query against its SQL: same columns, same types, same rows.

``TRIPMILL_SF_DIR`` picks other tables than the smallest ones.
"""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tripmill.plans.queries import QUERIES

SF_DIR = os.environ.get("TRIPMILL_SF_DIR", "/root/testdata/sf0.001")

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert QUERIES.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got = entry_points.queries()[name](spark, SF_DIR)
    want = duck.sql(entry_points.oracle_sql()[name])
    assert sorted((c, TYPES[t]) for c, t in got.dtypes) == sorted(
        (c, str(t)) for c, t in zip(want.columns, want.types, strict=True)
    )
    rows = Counter(tuple(r) for r in got.select(*[f"`{c}`" for c in want.columns]).collect())
    assert rows == Counter(want.fetchall())
    assert rows


def test_entry(spark):
    assert {r.pickup_week_day for r in entry_points.entry(spark).collect()} >= {"Monday", "Friday"}
