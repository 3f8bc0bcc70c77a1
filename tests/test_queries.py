import duckdb
import pytest

import __spark_entry__ as entry
from quorumkit.plans import catalogue, files, learning  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"reprofiled", "composition_clusters", "composition_classes"}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(v):
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_agrees_with_sql(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    at = [columns.index(c) for c in sorted(columns)]
    expected = sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
    got = sorted(tuple(map(plain, r)) for r in df.select(*sorted(df.columns)).collect())
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL) - SLOW))
def test_other_queries_give_rows(spark, data, name):
    assert entry.queries()[name](spark, data).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 3
