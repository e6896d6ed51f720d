"""Every query that has SQL gives what DuckDB gives for it."""

import decimal
import math

import duckdb
import pytest

from opinara.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, data, duck, name):
    df = registry.QUERIES[name](spark, data)
    names = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    if name in registry.ORACLES:
        said = duck.execute(registry.ORACLES[name])
        there = [c[0] for c in said.description]
        assert sorted(there) == names
        order = [there.index(c) for c in names]
        assert rows == sorted((tuple(plain(r[i]) for i in order) for r in said.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns and set(entry.oracle_sql()) <= set(entry.queries())
