"""Every query against its DuckDB twin, over the whole smallest tables."""

import math
import os

import duckdb
import pytest

from sievewright import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_small}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.7g}"
    return str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_twin(spark, sf_small, duck, name):
    got = catalogue.QUERIES[name](spark, sf_small)
    want = duck.sql(catalogue.ORACLE_SQL[name])
    assert table(got.columns, got.collect()) == table(want.columns, want.fetchall())


def test_queries_without_twin_run(spark, sf_small):
    for name in set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL):
        assert catalogue.QUERIES[name](spark, sf_small).count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
