"""Every registered query with SQL, held against DuckDB on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from resultlake.plans import game_queries, study_queries, upkeep_queries  # noqa: F401  register their queries
from resultlake.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return str(v.date()) if v.time() == datetime.time() else str(v)
    return f"{v:.9g}" if isinstance(v, int) and abs(v) < 1 << 53 else str(v)


def canonical(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, got) == canonical(columns, want)


def test_samples_of_orders(spark):
    n = {r["o_orderpriority"]: r["count"] for r in QUERIES["stratified_rows"](spark, SF).groupBy("o_orderpriority").count().collect()}
    assert n == {r["o_orderpriority"]: r["take"] for r in QUERIES["stratified"](spark, SF).collect()}
    assert QUERIES["nested_samples"](spark, SF).filter("sample = 50").count() == 50


def test_nearest_names(spark):
    for r in QUERIES["fuzzy_names"](spark, SF).collect():
        assert 0.5 <= r["score"] <= 1
