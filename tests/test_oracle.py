"""Every catalogued query against its SQL, on the smallest tables."""

import duckdb
import pytest

from kgsync.catalog.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(repr(r[i]) for i in order) for r in data)


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    got = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, map(tuple, got.collect())) == rows(names, want.fetchall())
