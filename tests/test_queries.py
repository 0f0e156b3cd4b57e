"""Every query returns rows, and those of its SQL."""

import duckdb
import pytest

from civicframe import plans

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([float(f"{r[i]:.9g}") if isinstance(r[i], float) else r[i] for i in order]) for r in data)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, FOLDER)
    got = df.collect()
    assert got
    if name in plans.SQL:
        want = duck.execute(plans.SQL[name])
        columns = [c[0] for c in want.description]
        assert sorted(df.columns) == sorted(columns)
        assert rows(df.columns, got) == rows(columns, want.fetchall())
