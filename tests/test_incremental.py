import datetime

import pytest
from pyspark.sql import functions as F

from resultlake.sources import tables as S
from resultlake.sources.versions import PartedTable
from resultlake.streaming import incremental as I


def test_upsert_and_cutoff(spark, tmp_path):
    target = str(tmp_path / "t")
    one = spark.createDataFrame([(99, "2026-10-02", "a"), (99, "2026-10-02", "b")], "event_id int, d string, v string")
    I.upsert_batch(one, target, "event_id", "d", "2026-10-01")
    assert I.upserted(spark, target).count() == 2
    I.upsert_batch(one.limit(1), target, "event_id", "d", "2026-10-01")
    assert I.upserted(spark, target).count() == 1
    late = one.limit(1).withColumn("d", F.lit("2026-09-01"))
    I.upsert_batch(late, target, "event_id", "d", "2026-10-01")
    assert I.upserted(spark, target).count() == 0


def test_stream_of_files(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(1, 1, "old"), (2, 1, "x"), (1, 2, "new")]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "k int, ts int, v string").write.parquet(f"{source}/b{i}")
    stream = spark.readStream.schema("k int, ts int, v string").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(source)
    q = I.stream_unique(stream, "k", "ts", target, str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in PartedTable(spark, target).read().collect()) == [(1, 2, "new"), (2, 1, "x")]


def test_coverage_start(spark):
    df = spark.createDataFrame([("2026-09-09", "hour", "2026-10-03"), ("2026-10-02", "hour", "2026-10-02"), ("2026-10-02", "quarter", "2026-10-02")], "n string, u string, t string")
    d = lambda c: F.col(c).cast("date")
    got = [str(r[0]) for r in df.select(F.when(F.col("u") == "quarter", I.coverage_start(d("n"), "quarter", d("t"))).otherwise(I.coverage_start(d("n"), "hour", d("t")))).collect()]
    assert got == ["2026-09-10", "2026-10-02", "2026-07-01"]


def test_fingerprints(spark):
    df = spark.range(100).withColumn("b", F.col("id") % 4)
    a = I.fingerprints(df, F.col("b"))
    assert I.changed_blocks(I.fingerprints(df.orderBy(F.desc("id")).repartition(3), F.col("b")), a).count() == 0
    now = df.filter("b != 3").union(df.filter("id = 1")).union(df.filter("id = 1").withColumn("b", F.lit(9).cast("long")))
    assert {r["block"]: r["status"] for r in I.changed_blocks(I.fingerprints(now, F.col("b")), a).collect()} == {3: "vanished", 1: "changed", 9: "new"}


def test_cache_and_pending(spark, tmp_path):
    cache = str(tmp_path / "c")
    calls = []

    def fn(df):
        calls.append(df.count())
        return df.withColumn("v", F.length("k"))

    keys = spark.createDataFrame([("a",), ("bb",), ("a",)], "k string")
    assert sorted(r["v"] for r in I.fill_cache(keys, "k", cache, fn).collect()) == [1, 1, 2]
    assert I.fill_cache(keys.union(spark.createDataFrame([("ccc",)], "k string")), "k", cache, fn).count() == 4
    assert calls == [2, 1]
    exp = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    checked = spark.createDataFrame([(3, "2024-01-01", "2024-03-01"), (4, "2024-01-01", "2024-01-05")], "k int, event_date string, checked_date string")
    assert sorted(r["k"] for r in I.pending(exp, exp.limit(1), checked, "k", "2024-03-02").collect()) == [2, 4]


def test_windows_and_manifest(spark, tmp_path):
    where, m = str(tmp_path / "w"), str(tmp_path / "m")
    df = spark.createDataFrame([(1, datetime.date(2024, 1, 5)), (2, datetime.date(2024, 2, 1)), (3, None)], "k int, d date")
    S.write_windows(df, where, "d")
    got = {r["window"]: r["rows"] for r in S.write_manifest(spark, where, m, "d").collect()}
    assert got == {"2024-01-01": 1, "2024-02-01": 1, "unknown": 1}
    kept = str(tmp_path / "k")
    S.replace_table(spark.read.parquet(m), kept)
    S.replace_table(S.current_table(spark, kept).filter("rows > 5"), kept)
    assert S.current_table(spark, kept).count() == 0


def test_evolving_scan(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([("1", 5)], "id string, x int").write.parquet(a)
    spark.createDataFrame([(2, True)], "id int, flag boolean").write.parquet(b)
    got = sorted(tuple(r) for r in S.scan_evolving(spark, [a, b], ["id", "flag"], ["id"]).collect())
    assert got == [("1", None), ("2", True)]
    listed = spark.createDataFrame([("a",)], "path string")
    with pytest.raises(ValueError, match="unlisted"):
        S.resolve_source(spark, str(tmp_path), listed)


def test_members_of_documents(spark):
    doc = '{"sections": [{"name": "A", "players": [{"id": 1}, {"id": 1}, {"id": 2}]}, {"name": "B", "players": [{"id": 1}]}]}'
    df = spark.createDataFrame([(7, doc), (8, None)], "k int, c string").withColumn("d", F.from_json("c", "sections array<struct<name:string,players:array<struct<id:int>>>>"))
    got = S.doc_members(df, ["k"], "d", ["sections", "players"], ["id"], {"section": "name"})
    assert sorted(tuple(r) for r in got.collect()) == [(7, "A", 1), (7, "A", 2), (7, "B", 1)]


def test_html(spark):
    page = '<a href="x?id=1">1</a><table><tr><td>a <b>b</b></td><td>2</td></tr></table><script>var data = [{"id": 4}];</script><i data-page="3">'
    df = spark.createDataFrame([(1, page), (2, None)], "k int, html string")
    assert [tuple(r) for r in S.html_links(df, ["k"], "html").collect()] == [(1, 0, "x?id=1")]
    assert S.html_rows(df, ["k"], "html").first()["cells"] == ["a b", "2"]
    assert df.select(S.html_json_var(df, "html", "data", "array<struct<id:int>>").alias("v")).first()["v"][0]["id"] == 4
    assert [r[0] for r in df.orderBy("k").select(S.max_page("html")).collect()] == [3, 1]
