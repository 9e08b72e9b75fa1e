"""Every registered query next to its SQL at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def normal(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v + 0.0:.6f}"
        return str(v)

    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    mine = rows_of([tuple(r) for r in df.collect()], df.columns)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert mine == rows_of(result.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"als_grid"}))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).take(1)


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
