"""Every query with SQL gives DuckDB's rows."""

import math

import duckdb
import pytest

from spectral_spark.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int | float) or type(v).__name__ == "Decimal":
        if isinstance(v, float) and math.isnan(v):
            return "None"
        return str(int(v)) if v == int(v) else repr(round(float(v), 6))
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_others_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark, sf_dir):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
