"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"pipeline"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = plain(df.select(*columns).collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    found = duck.sql(sql)
    assert sorted(found.columns) == columns
    order = [found.columns.index(c) for c in columns]
    assert got == plain([tuple(r[i] for i in order) for r in found.fetchall()])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
