"""Every query of the engine against its SQL."""

import decimal

import duckdb
import pytest

from keyloft import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if isinstance(v, list | tuple):
        return [plain(x) for x in v]
    return str(v)


def test_each_query_has_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sql, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    cursor = sql.execute(catalog.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert got == expected
