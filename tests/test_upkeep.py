"""Tables that are kept: versions, partition-wise upserts, rebuilt blocks, caches, ratings and search."""

import datetime
import os
import threading

import pytest
from pyspark.sql import functions as F

from resultlake.operators import fuzzy, joins, pick
from resultlake.plans import serve
from resultlake.plans.reports import shrinkage_prior
from resultlake.operators import windows
from resultlake.sources import tables as S
from resultlake.sources import versions as V
from resultlake.streaming import incremental as I
from resultlake.streaming import ratings


def files(where):
    return {os.path.join(d, f) for d, _, names in os.walk(where) for f in names if f.endswith(".parquet")}


# ---- versions


def test_a_reader_never_misses_the_table(spark, tmp_path):
    where = str(tmp_path / "t")
    one = spark.range(10).coalesce(1)
    S.replace_table(one.withColumn("v", F.lit(0)), where)
    seen, stop, wrong = [], threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                rows = S.current_table(spark, where).collect()
                seen.append({r["v"] for r in rows})
                if len(rows) != 10:
                    wrong.append(len(rows))
            except Exception as e:
                wrong.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 21):
        S.replace_table(one.withColumn("v", F.lit(i)), where)
    stop.set()
    reader.join()
    assert not wrong and all(len(s) == 1 for s in seen) and len({min(s) for s in seen}) > 1
    assert S.current_table(spark, where).first()["v"] == 20


@pytest.mark.parametrize("step", ["data", "beside", "link"])
def test_a_writer_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    where = str(tmp_path / "t")
    S.replace_table(spark.range(3), where)

    def die(*a, **b):
        raise KeyboardInterrupt

    if step == "data":
        monkeypatch.setattr(V.PartedTable, "_commit", die)
    elif step == "beside":
        monkeypatch.setattr(V.json, "dumps", die)
    else:  # files as a dead writer leaves them: whole and torn, under names that no version has
        for name, text in ((".000000000002-aa", "{"), (".000000000002-bb", "")):
            (tmp_path / "t" / "versions" / name).write_text(text)
    if step != "link":
        with pytest.raises(KeyboardInterrupt):
            S.replace_table(spark.range(9), where)
        monkeypatch.undo()
    assert S.current_table(spark, where).count() == 3
    assert S.replace_table(spark.range(4), where) == 2 and S.current_table(spark, where).count() == 4


def test_of_two_writers_one_fails(spark, tmp_path):
    table = V.PartedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(4), F.col("id"))
    before = table.entry()
    table.rewrite(spark.range(1), F.col("id"), ["0"], before=before)
    with pytest.raises(V.Conflict):
        table.rewrite(spark.range(1, 2), F.col("id"), ["1"], before=before)
    assert V.publish(spark, "x", str(tmp_path / "p")) and not V.publish(spark, "y", str(tmp_path / "p"))
    assert V.read_text(spark, str(tmp_path / "p")) == "x"


def test_parts(spark, tmp_path):
    table = V.PartedTable(spark, str(tmp_path / "t"))
    assert table.read() is None and table.vacuum() == []
    df = spark.createDataFrame([("a/b", 1), ("c%", 2), (None, 3), ("", 4)], "p string, x int")
    table.replace(df, F.col("p"))
    assert sorted(r["x"] for r in table.read().collect()) == [1, 2, 3, 4] and table.read().columns == ["p", "x"]
    assert [r["x"] for r in table.read(parts=["a/b"]).collect()] == [1] and [r["x"] for r in table.read(parts=["null"]).collect()] == [3]
    table.rewrite(spark.createDataFrame([("c%", 7)], "p string, x int"), F.col("p"), ["c%", "a/b"])
    assert sorted(r["x"] for r in table.read().collect()) == [3, 4, 7] and sorted(r["x"] for r in table.read(1).collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="not rewritten"):
        table.rewrite(df, F.col("p"), ["c%"])
    with pytest.raises(ValueError, match="columns"):
        table.rewrite(df.select("p"), F.col("p"), ["a/b", "c%", "null", ""])
    table.rewrite(df.filter("x = 3"), F.col("p"), ["a/b", "c%", "null", ""])
    assert [r["x"] for r in table.read().collect()] == [3]
    assert table.vacuum(1) and table.versions() == [3] and table.read().count() >= 1


# ---- upserts, blocks, caches


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(400).select(F.col("id").alias("event_id"), F.lit("2026-10-02").alias("d"), F.lit("old").alias("v"))
    I.upsert_batch(rows, target, "event_id", "d", "2026-10-01", 16)
    before = V.PartedTable(spark, target).entry()["parts"]
    had = files(target)
    stamps = {f: os.stat(f).st_mtime_ns for f in had}
    batch = rows.filter("event_id = 7").withColumn("v", F.lit("new"))
    I.upsert_batch(batch, target, "event_id", "d", "2026-10-01")
    after = V.PartedTable(spark, target).entry()["parts"]
    assert len(before) == 16 and sum(before[p] != after[p] for p in before) == 1
    assert all(os.stat(f).st_mtime_ns == t for f, t in stamps.items())
    got = I.upserted(spark, target)
    assert got.count() == 400 and [r["event_id"] for r in got.filter("v = 'new'").collect()] == [7]
    assert I.upsert_batch(batch, target, "event_id", "d", "2026-10-01") and I.upserted(spark, target).count() == 400
    I.upsert_batch(batch.withColumn("d", F.lit("2026-11-09")), target, "event_id", "d", "2026-11-01")  # a later cutoff takes old rows of all buckets
    assert [r["event_id"] for r in I.upserted(spark, target).collect()] == [7]


def test_upsert_stream(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for i, r in enumerate([(1, "2026-01-02", "a"), (2, "2026-01-03", "b"), (1, "2026-01-04", "c"), (3, None, "d"), (4, "2025-12-31", "e")]):
        spark.createDataFrame([r], "k int, d string, v string").coalesce(1).write.parquet(f"{source}/b{i}")
    stream = spark.readStream.schema("k int, d string, v string").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(source)
    I.upsert_stream(stream, target, "k", "d", str(tmp_path / "cp"), "2026-01-01").awaitTermination(180)
    assert sorted((r["k"], r["v"]) for r in I.upserted(spark, target).collect()) == [(1, "c"), (2, "b"), (3, "d")]


def test_first_of_a_key_within_a_delay(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    t = lambda m: datetime.datetime(2026, 1, 1, 12, m)
    for i, r in enumerate([("a", t(0)), ("a", t(5)), ("b", t(6)), ("a", t(40))]):
        spark.createDataFrame([r], "k string, ts timestamp").coalesce(1).write.parquet(f"{source}/b{i}")
    stream = spark.readStream.schema("k string, ts timestamp").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(source)
    q = I.first_within(stream, "k", "ts", "10 minutes").writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).format("parquet").start(out)
    q.awaitTermination(180)
    got = sorted((r["k"], r["ts"].minute) for r in spark.read.parquet(out).collect())
    assert got[0] == ("a", 0) and ("b", 6) in got and len(got) in (2, 3)  # the state of a is gone once the watermark has passed it


def test_rebuilt_blocks_equal_a_full_run(spark, tmp_path):
    where, calls = str(tmp_path / "t"), []

    def fn(df):
        calls.append(sorted(r[0] for r in df.select("b").distinct().collect()))
        return df.groupBy("b").agg(F.sum("x").alias("s"))

    rows = [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    make = lambda r: spark.createDataFrame(r, "b string, x int")
    first = I.rebuild_blocks(make(rows), "b", where, fn)
    assert set(first.values()) == {"new"} and len(first) == 4
    kept = V.PartedTable(spark, f"{where}/rows").entry()["parts"]["b"]
    now = [("a", 5), ("b", 2), ("e", 6), ("d", 4)]
    assert I.rebuild_blocks(make(now), "b", where, fn) == {"a": "changed", "c": "vanished", "e": "new"}
    table = V.PartedTable(spark, f"{where}/rows")
    assert sorted(map(tuple, table.read().collect())) == [("a", 5), ("b", 2), ("d", 4), ("e", 6)]
    assert table.entry()["parts"]["b"] == kept and calls == [["a", "b", "c", "d"], ["a", "e"]]
    assert I.rebuild_blocks(make(now), "b", where, fn) == {} and len(calls) == 2
    assert set(I.rebuild_blocks(make([]), "b", where, fn).values()) == {"vanished"} and table.read().count() == 0


def test_only_changed_documents_are_parsed(spark, tmp_path):
    folder, cache = tmp_path / "in", str(tmp_path / "cache")
    (folder / "sub").mkdir(parents=True)
    put = lambda name, text: (folder / name).write_text(text)
    for i in range(20):
        put(f"sub/{i}.json", '{"id": %d,\n "xs": [{"x": %d}]}' % (i, i))
    put("torn.json", '{"id": 3, "xs": [')
    schema = "id int, xs array<struct<x:int>>"
    one = S.sync_documents(spark, str(folder), cache, schema, 4)
    assert one.count() == 21 and one.filter("doc.id IS NULL").count() == 1 and one.filter("run = 1").count() == 21
    put("sub/3.json", '{"id": 33, "xs": []}')
    put("sub/new.json", '{"id": 99, "xs": null}')
    os.remove(folder / "sub" / "4.json")
    two = S.sync_documents(spark, str(folder), cache, schema, 4)
    assert sorted(r[0] for r in two.filter("run = 2").select("doc.id").collect()) == [33, 99]
    full = S.sync_documents(spark, str(folder), str(tmp_path / "other"), schema, 4)
    assert sorted(map(str, two.drop("run").collect())) == sorted(map(str, full.drop("run").collect()))
    assert S.sync_documents(spark, str(folder), cache, schema).count() == 21 and V.PartedTable(spark, cache).entry()["version"] == 2


def test_footers_are_read_in_tasks(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for i in range(2000):
        table = pa.table({"id": pa.array([i], pa.int32())} if i % 3 == 0 else {"id": pa.array([str(i)]), "x": [float(i)]} if i % 3 == 1 else {"id": pa.array([i], pa.int64()), "flag": [True]})
        pq.write_table(table, tmp_path / f"{i}.parquet")
    paths = [str(tmp_path / f"{i}.parquet") for i in range(2000)]
    reader = type(spark.read)
    was, given = reader.parquet, []
    monkeypatch.setattr(reader, "parquet", lambda self, *p, **k: given.append(len(p)) or was(self, *p, **k))
    got = S.scan_evolving(spark, paths, ["id", "x", "flag"], ["id"])
    assert sorted(given) == [666, 667, 667]  # a scan for each schema, none for a file's footer
    rows = {r["id"]: (r["x"], r["flag"]) for r in got.collect()}
    assert len(rows) == 2000 and rows["0"] == (None, None) and rows["1"] == (1.0, None) and rows["2"] == (None, True)


def test_bucketed_tables_join_where_they_lie(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets")
    conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(2000).select((F.col("id") % 7).alias("block"), F.col("id").alias("key"), F.lit(1).alias("x"))
        S.write_bucketed(a, "buckets.a", str(tmp_path / "a"), ["block", "key"], 8)
        S.write_bucketed(a.withColumnRenamed("x", "y"), "buckets.b", str(tmp_path / "b"), ["block", "key"], 8)
        joined = joins.block_join(spark.table("buckets.a"), spark.table("buckets.b"), ["key"], "block")
        assert joined.count() == 2000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
        spark.sql("DROP DATABASE buckets CASCADE")


# ---- samples


def test_samples_are_the_first_of_the_seeded_order(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("g"))
    order = [r["id"] for r in df.orderBy(pick.seeded(["id"], 3), "id").collect()]
    for n in (0, 1, 700, 5000):
        assert sorted(r["id"] for r in pick.sample_n(df, ["id"], n, 3).collect()) == sorted(order[:n])
    got = {r["id"]: r["sample"] for r in pick.nested_sample(df, ["id"], [20, 5, 100], 3).collect()}
    assert got == {x: 5 if i < 5 else 20 if i < 20 else 100 for i, x in enumerate(order[:100])}
    take = {r["g"]: r["take"] for r in pick.allocation(df.groupBy("g").agg(F.count("*").alias("n")), "g", 300).collect()}
    some = pick.proportional_sample(df, "g", ["id"], 300, 3).collect()
    group = {r["id"]: r["g"] for r in df.collect()}
    want = {x for g, n in take.items() for x in [y for y in order if group[y] == g][:n]}
    assert {r["id"] for r in some} == want and len(some) == 300
    copies = spark.createDataFrame([(1,)] * 50, "id int")
    assert pick.sample_n(copies, ["id"], 20, 3).count() == 20


def test_no_task_sorts_a_stratum(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 2)
    plan = pick.proportional_sample(df, "g", ["id"], 10, 1)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.split("\n") if "row_number()" in line and "Window" in line]
    assert lines and all("__bucket" in line for line in lines if "windowspecdefinition(g" in line)


def test_medians_and_quartiles(spark):
    rows = [(i % 7, float((i * 37) % 101)) for i in range(400)] + [(None, 2.0), (None, 4.0), (8, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r["g"]: r["m"] for r in windows.partition_median(df, ["g"], "x", "m").collect()}
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    assert got == want
    prior, _ = shrinkage_prior(df.filter("g IS NOT NULL").withColumn("t", F.lit(1)), "g", ["x"], "x", least=2)
    per = df.filter("g IS NOT NULL").groupBy("g").agg(F.max("x").alias("v"), F.count("*").alias("n")).filter("n >= 2")
    row = per.agg(F.median("v").alias("a"), F.percentile("v", 0.25).alias("b"), F.percentile("v", 0.75).alias("c")).first()
    assert (prior.first()["anchor"], prior.first()["p25"], prior.first()["p75"]) == tuple(row)
    empty, _ = shrinkage_prior(df.filter("g = 99"), "g", ["x"], "x")
    assert empty.first()["anchor"] is None and empty.first()["n"] == 0


def test_dependencies(spark):
    from resultlake.operators.quality import check_dependency

    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c")], "k int, v string")
    assert tuple(check_dependency(df, ["k"], ["v"]).first())[1:] == (False, "", 1)
    assert check_dependency(df.filter("k = 1"), ["k"], ["v"]).first()["passed"]


# ---- ratings


def some_games(spark):
    day = lambda i: datetime.date(2026, 1, 1) + datetime.timedelta(days=i)
    rows = [(day(i // 9), f"g{i}", f"p{i % 5}", f"p{(i * 3 + 1) % 7}", (i * 13 % 11) / 10) for i in range(120)]
    return rows + [(day(3), "n1", None, "p1", 0.5), (day(3), "n2", "p1", "p2", None)]


def plain_ratings(rows, k=20.0, init=1500.0, prior=10.0):
    """By dates, all entities at once."""
    import math

    rating, total, out = {}, {}, []
    for date in sorted({r[0] for r in rows}):
        played = [(a, b, s) for d, _, a, b, s in rows if d == date and None not in (a, b, s)]
        sides = played + [(b, a, 1 - s) for a, b, s in played]
        form = {e: (total.get(e, (0, 0))[0] + prior / 2) / (total.get(e, (0, 0))[1] + prior) for e, _, _ in sides}
        new = dict(rating)
        for e in form:
            own = [(o, s) for x, o, s in sides if x == e]
            before = rating.get(e, init)
            new[e] = before + sum(k * (s - 1 / (1 + 10 ** ((init + 400 * math.log10(form[o] / (1 - form[o])) - before) / 400))) for o, s in own)
            out.append((date, e, len(own), round(before, 6), round(new[e], 6)))
        for e, _, s in sides:
            t, n = total.get(e, (0, 0))
            total[e] = (t + s, n + 1)
        rating = new
    return sorted(out)


GAMES = "date date, game_id string, a string, b string, score double"


def rounded(df):
    return sorted((r["date"], r["entity"], r["n_games"], round(r["before"], 6), round(r["after"], 6)) for r in df.collect())


def test_ratings_of_a_batch(spark):
    rows = some_games(spark)
    assert rounded(ratings.rate(spark.createDataFrame(rows, GAMES))) == plain_ratings(rows)
    assert ratings.rate(spark.createDataFrame([], GAMES)).count() == 0


@pytest.mark.parametrize("cut", [9, 5])  # files of whole dates, and files that part dates
def test_ratings_of_a_stream_are_those_of_a_batch(spark, tmp_path, cut):
    rows = some_games(spark)
    source = str(tmp_path / "in")
    for i in range(0, len(rows), cut * 6):
        spark.createDataFrame(rows[i : i + cut * 6], GAMES).coalesce(1).write.mode("append").parquet(source)
        if i == 0:
            stream = spark.readStream.schema(GAMES).option("maxFilesPerTrigger", 1).parquet(source)
            ratings.follow(stream, str(tmp_path / "out"))  # what comes later goes on from its state
    stream = spark.readStream.schema(GAMES).option("maxFilesPerTrigger", 1).parquet(source)
    got = rounded(ratings.follow(stream, str(tmp_path / "out")))
    kept = rows[:120] + [r for r in rows[120:] if None not in r]
    assert got == plain_ratings(kept)


# ---- search and SQL


def test_index_lookup_is_the_full_search(spark, tmp_path):
    names = [f"{a} {b}" for a in ("steel", "Émile", "small", "red") for b in ("widget", "ring", "Müller", "x")]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names * 2)] + [(99, None)], "player_number int, player_name string")
    where = str(tmp_path / "g")
    fuzzy.write_gram_index(df, "player_name", where)
    for q in ("stel widgit", "emile muller", "zzz", "ring"):
        index = spark.read.parquet(where)
        full = fuzzy.fuzzy_lookup(df.select("player_name").dropna().distinct(), "player_name", q)
        assert [tuple(r) for r in fuzzy.index_lookup(index, q).collect()] == [tuple(r) for r in full.collect()]
        found = serve.typo_lookup(df, q, 5, index).collect()
        assert [r["score"] for r in found] == sorted([r["score"] for r in found], reverse=True) and len(found) <= 5


@pytest.fixture
def secrets(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("secret_view")
    spark.range(3).write.mode("overwrite").saveAsTable("secret_table")
    spark.range(3).write.parquet(str(tmp_path / "file"))
    spark.range(3).createOrReplaceGlobalTempView("secret_global")
    yield str(tmp_path / "file")
    spark.catalog.dropTempView("secret_view")
    spark.catalog.dropGlobalTempView("secret_global")
    spark.sql("DROP TABLE secret_table")


def test_sql_reads_the_given_tables_only(spark, secrets):
    t = {"t": spark.range(5), "u": spark.range(2)}
    bad = ["SELECT * FROM secret_view", "SELECT * FROM secret_table", f"SELECT * FROM parquet.`{secrets}`", "SELECT * FROM global_temp.secret_global", "SELECT (SELECT max(id) FROM secret_view) AS x FROM t", "SELECT * FROM t WHERE id IN (SELECT id FROM secret_table)", "WITH a AS (SELECT * FROM secret_view) SELECT * FROM a JOIN t USING (id)", "SELECT * FROM t JOIN LATERAL (SELECT * FROM secret_view)", "SELECT * FROM t UNION ALL SELECT id FROM secret_view"]
    for sql in bad:
        with pytest.raises(serve.Refused):
            serve.sql_tables(t, sql)
    for sql in ("INSERT INTO secret_table SELECT * FROM t", "FROM t INSERT INTO secret_table SELECT *", "DROP TABLE secret_table", "SELECT reflect('java.lang.System', 'exit', 1) FROM t", "SHOW TABLES", "SET a = b"):
        with pytest.raises(Exception):
            serve.sql_tables(t, sql)
    assert spark.table("secret_table").count() == 3
    assert not [v for v in spark.catalog.listTables() if v.name.startswith("v_")]


def test_sql_of_harmless_names(spark):
    df = spark.range(4).selectExpr("id AS `update`", "id AS `set`", "id AS call")
    assert serve.sql_tables({"t": df, "s": df}, "SELECT t.`update`, t.set, s.call FROM t JOIN s ON t.call = s.call WHERE t.set > (SELECT min(call) FROM s)").count() == 3
    assert serve.sql_tables({"t": df}, "WITH w AS (SELECT call FROM t), x AS (SELECT * FROM w) SELECT count(*) AS n FROM x, range(3)").first()["n"] == 12
    assert serve.sql_self(df, "WHERE call = 1").count() == 1
