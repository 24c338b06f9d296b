"""Every query with SQL gives what that SQL gives."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = [p.stem for p in Path(FOLDER).glob("*.parquet")]


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and (math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-6) or (math.isnan(a) and math.isnan(b)))
    if isinstance(a, list):
        return len(a) == len(b) and all(map(same, a, b))
    return a == b


def sortable(row):
    return tuple((x is None, round(x, 4) if isinstance(x, float) else str(x)) if not isinstance(x, float) else (False, str(round(x, 4))) for x in row)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    rel = db.execute(registry.ORACLES[name])
    columns = [c[0] for c in rel.description]
    want = rel.fetchall()
    frame = registry.QUERIES[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(columns)
    got = [tuple(r) for r in frame.select(*columns).collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=sortable), sorted(want, key=sortable), strict=True):
        assert all(map(same, a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert registry.QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
