"""Every query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

from scriptorium.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, con, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    cur = con.execute(catalog.SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain([tuple(r) for r in df.select(*columns).collect()]) == plain(cur.fetchall())
