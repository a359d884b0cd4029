"""Every query with SQL gives DuckDB's rows on the small tables."""

import glob
import math
import os

import duckdb
import pytest

from strandline.plans.catalogue import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 6) if isinstance(v, float) and math.isfinite(v) else str(v) if v is not None else None
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF)
    if name not in ORACLES:
        assert found.count() > 0
        return
    wanted = duck.execute(ORACLES[name])
    names = [c[0] for c in wanted.description]
    assert sorted(names) == sorted(found.columns)
    assert rows_of(found.columns, found.collect()) == rows_of(names, wanted.fetchall())
