import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.operators import aggs, fuzzy, joins, pick, quality, sets, shape, windows


def test_out_of_range(spark, rows):
    df = spark.createDataFrame(list(zip(range(8), [0.0, 1.0, 0.5, 9.99, 1.06, 0.05, None, -0.01], [1.0, 0.0, 0.5, 9.99, 0.2, 2.45, None, 1.0])), "i int, a double, b double")
    assert [r[0] for r in rows(quality.drop_out_of_range(df, ["a", "b"]).orderBy("i"))] == [0, 1, 2, 6]
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (None,), (-0.1,)], "p double")
    got = {r[0]: r[1:] for r in rows(quality.check_ranges(df, ["p", "q"], 0, 1))}
    assert got == {"range p": (False, "", 2), "range q": (False, "missing", 0)}


def test_int_ids_meet_text_ids(spark, rows):
    fact = spark.createDataFrame([("7",), ("#155",), (None,)], "Player_ID_N string")
    dim = spark.createDataFrame([(7, 1500.0)], "Player_ID int, Elo double")
    got = joins.join_roles(fact, dim, "Player_ID", {"N": "Player_ID_N"}, ["Elo"])
    assert sorted(rows(got), key=str) == [("#155", None), ("7", 1500.0), (None, None)]


def test_null_joins(spark, rows):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(None, 5), (2, 6)], "k int, w int")
    assert sorted(rows(joins.null_equal_join(a, b, ["k"], "left")), key=str) == [(1, "x", None), (None, "y", 5)]
    assert sorted(rows(joins.null_safe_left(a, b, ["k"])), key=str) == [(1, "x", None), (None, "y", 5)]
    with pytest.raises(Exception, match="not unique"):  # by the job that joins
        joins.null_safe_left(a, b.union(b), ["k"]).collect()


def test_overlays(spark, rows):
    old, new = spark.createDataFrame([(1, "old"), (2, "old")], "id int, v string"), spark.createDataFrame([(1, "new")], "id int, v string")
    assert sorted(rows(joins.overlay(old, new, "id"))) == [(1, "new"), (2, "old")]
    assert sorted(rows(joins.fresh_first(new, old, "id"))) == [(1, "new", 0), (2, "old", 1)]
    got = {r["id"]: (r["v"], r["source"]) for r in joins.override_merge(old, new.union(spark.createDataFrame([(3, "n3")], new.schema)), ["id"], ["v"]).collect()}
    assert got == {1: ("new", "both"), 2: ("old", "base"), 3: ("n3", "official")}


def test_total_order_does_not_depend_on_input(spark, rows):
    data = [(20, 1, 3, "a"), (20, 1, 3, "b"), (20, 1, 3, "c"), (20, 2, 1, "d"), (10, 1, 1, "e")]
    want = [r[3] for r in sorted(data)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "s int, b int, x int, p string")
        assert [r[3] for r in rows(pick.total_sort(df, ["s", "b"]))] == want
        assert rows(sets.unique_by(df, ["s", "b"], ["x"], "last").orderBy("s", "b"))[1][3] == "c"


def test_shape(spark, rows):
    df = spark.createDataFrame([("1", None, "7")], "a string, b string, c string")
    assert shape.select_matching(df, ["a", "c"]).columns == ["a", "c"] and shape.drop_matching(df, ["a"]).columns == ["b", "c"]
    assert shape.rename_existing(df, {"a": "x", "zz": "y"}).columns == ["x", "b", "c"]
    assert shape.suffix_pairs(spark.createDataFrame([(1, 2)], "x int, x_ew int")).columns == ["x_ns", "x_ew"]
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("n", T.DoubleType()), T.StructField("f", T.BooleanType())])
    assert rows(shape.align_schema(df, schema)) == [(1, 0.0, False)]
    twins = spark.createDataFrame([("3", 1), ("x", 2)], T.StructType([T.StructField("result", T.StringType()), T.StructField("Result", T.IntegerType())]))
    assert sorted(rows(shape.prefer_raw(twins, [("result", "Result")]))) == [(2,), (3,)]
    assert rows(shape.scale_percent(spark.createDataFrame([(0.5, 50.0), (None, 2.0)], "a double, b double"), ["a", "b"]).orderBy("b")) == [(None, 2.0), (50.0, 50.0)]
    with pytest.raises(Exception, match="unknown value"):
        shape.remap(spark.createDataFrame([("z",)], "a string"), "a", {"x": "y"}).collect()
    assert dict(shape.downcast_floats(spark.createDataFrame([(1.0, 1)], "a double, b int")).dtypes) == {"a": "float", "b": "int"}


def test_row_ids(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(500)], "a int, b int")
    got = shape.with_row_id(df, ["a", "b"], "n", 5).orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(500)) and [(r["a"], r["b"]) for r in got] == sorted((i % 7, i) for i in range(500))


def test_moments_skip_what_is_not_finite(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 3.0), (2, None)], "g int, x double")
    got = {r["g"]: r for r in aggs.moments(df, ["g"], "x").collect()}
    assert (got[1]["n"], got[1]["mean"], got[1]["median"]) == (2, 2.0, 2.0) and got[2]["mean"] is None
    assert rows(aggs.pearson(df, "x", "x"))[0][1] is None  # two pairs only


def test_ranks(spark, rows):
    df = spark.createDataFrame([(1, v) for v in (5, 5, 1, 9)], "g int, v int")
    assert sorted(rows(df.select("v", windows.avg_rank(["g"], "v")))) == [(1, 1.0), (5, 2.5), (5, 2.5), (9, 4.0)]


def test_ranks_of_large_groups(spark):
    df = spark.createDataFrame([(i % 2 or None, float(i * 7 % 30)) for i in range(200)] + [(1, None)], "g int, v double")
    a = {(r["g"], r["v"], r["k"]) for r in windows.ranked(df, ["g"], "v", "k", 5).collect()}
    b = {(r["g"], r["v"], r["k"]) for r in df.filter("v IS NOT NULL").withColumn("k", windows.avg_rank(["g"], "v")).collect()}
    assert a == b | {(1, None, None)}


def test_samples(spark):
    df = spark.range(1000).withColumn("s", F.when(F.col("id") < 900, "big").otherwise("small"))
    got = pick.proportional_sample(df, "s", ["id"], 50, 3).groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got} == {"big": 45, "small": 5}
    a = {r["id"] for r in pick.sample_n(df, ["id"], 10, 1).collect()}
    b = pick.nested_sample(df, ["id"], [10, 40], 1).collect()
    assert len(b) == 40 and {r["id"] for r in b if r["sample"] == 10} == a
    out = pick.capped(df, 5)[0].collect()
    assert len(out) == 5 and all(r["truncated"] for r in out)
    assert not pick.capped(df.limit(3), 5)[0].collect()[0]["truncated"]


def test_sets(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "k int, v string")
    assert sets.same_rows(a, a.orderBy("v")) and not sets.same_rows(a, a.distinct())
    assert sorted(rows(sets.key_diff(a, spark.createDataFrame([(2, "z"), (None, "q")], a.schema), ["k"]))) == [(1, "a"), (2, "b")]
    u = sets.union_relaxed([spark.createDataFrame([("5", True)], "id string, f boolean"), spark.createDataFrame([(7,)], "id int")])
    assert sorted(rows(u)) == [("5", True), ("7", None)]


def test_quality(spark, rows):
    df = spark.createDataFrame([("7", 1), ("+7", 2), (None, 3)], "id string, n int")
    got = rows(quality.check_unique(df, ["id"], numeric=True, nullable=True))[0]
    assert got[1] is False and got[3] == 1 and "7" in got[2]
    tables = {"a": spark.createDataFrame([(1, 1), (2, None)], "doc int, x int"), "b": spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "doc int, y int")}
    kept, bad = quality.reject_documents(tables, {"a": ["x"]}, "doc")
    assert [r[0] for r in rows(bad)] == [2] and sorted(r[0] for r in rows(kept["b"])) == [1, 3]
    with pytest.raises(ValueError):
        quality.reject_documents(tables, {"a": ["nope"]}, "doc")
    assert rows(quality.audit(tables["b"], tables["a"], tables["b"].filter("doc = 3"), "doc")) == [(3, 2, 1, 1, 0)]
    same = {r[0]: r[1] for r in rows(quality.compare(tables["b"], tables["b"], ["doc"]))}
    assert all(same.values()) and set(same) == {"schema", "count", "keys only in a", "keys only in b", "column y"}
    assert sorted(r[0] for r in rows(quality.drop_conflicting(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"), ["k"], ["v"]))) == [2]


def test_fuzzy(spark, rows):
    df = spark.createDataFrame([("Bridge Club of Ghent",), ("Chess House",), ("Brige Klub",)], "name string")
    got = [r[0] for r in rows(fuzzy.fuzzy_lookup(df, "name", "bridge club"))]
    assert got[0] == "Bridge Club of Ghent" and "Chess House" not in got
    assert rows(fuzzy.map_distinct(df.union(df), "name", F.length, "n").agg(F.count("*"))) == [(6,)]


def test_fuzzy_join_leaves_no_frequent_gram_out(spark, rows):
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    names = [f"red {c}{d}e" for c in "abcdefghijklmnopqrstuvwxyz" for d in "abcdefghijklmnopqrstuvwxyz"] + [f"red {c}{d}{e}" for c in "abcdefghij" for d in "abcdefghij" for e in "mnopq"]
    asked = ["red", "red abe", "rad abe", "rex", "zzz"]
    got = {r[0]: r[1:] for r in rows(fuzzy.fuzzy_join(spark.createDataFrame([(x,) for x in asked], "q string"), spark.createDataFrame([(x,) for x in names], "m string"), "q", "m", 0.4))}
    for q in asked:
        score, match = min((-(1 - edits(q, m) / max(len(q), len(m))), m) for m in names)
        if -score >= 0.4:
            assert got[q][0] == match and abs(got[q][1] + score) < 1e-9
        else:
            assert q not in got


def test_exact_quantiles_of_groups_of_any_size(spark):
    import random

    import numpy as np

    from resultlake.operators import windows

    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, float(rng.randint(0, 40)), rng.random()])) for _ in range(800)] + [("one", 5.0), ("none", None)]
    at = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["p"] for r in windows.quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", at).collect()}
    for g in ("a", "b", None, "one"):
        assert np.allclose(got[g], np.quantile([v for k, v in rows if k == g and v is not None], at))
    assert "none" not in got and windows.quantiles(spark.createDataFrame(rows, "g string, v double"), [], "v", [0.5]).count() == 1


def test_sql_over_tables_leaves_the_callers_views_alone(spark):
    import pytest

    from resultlake.plans import serve

    spark.range(3).createOrReplaceTempView("self")
    df = spark.range(7).withColumnRenamed("id", "x")
    assert serve.sql_self(df, "max(x) AS m").collect()[0]["m"] == 6
    assert serve.sql_self(df, "WITH big AS (SELECT * FROM self WHERE x > 4) SELECT count(*) AS n FROM big").collect()[0]["n"] == 2
    assert serve.sql_tables({"a": df, "b": df}, "SELECT a.x FROM a JOIN b ON a.x = b.x + 1 WHERE 'drop' <> ''").count() == 6
    assert spark.table("self").count() == 3
    for bad in ("DROP TABLE self", "WITH q AS (SELECT 1) INSERT INTO t SELECT * FROM q"):
        with pytest.raises(ValueError):
            serve.sql_self(df, bad)
    spark.catalog.dropTempView("self")
