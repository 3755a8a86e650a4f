"""Queries of tables that are kept, read and searched: each writes what it keeps to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.functions import columns as X
from resultlake.operators import fuzzy, joins, shape
from resultlake.plans import ml, serve
from resultlake.plans import reports as R
from resultlake.plans.game_queries import derived, listed
from resultlake.plans.queries import FACTS, Tables, facts, query, r6
from resultlake.sources import tables as S
from resultlake.sources.versions import PartedTable
from resultlake.streaming import incremental as I
from resultlake.streaming import ratings

# ---- ratings --------------------------------------------------------------------

GAMES = {"date": "CAST(o_orderdate AS DATE)", "game_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)", "a": "'s' || CAST(l_suppkey AS STRING)", "b": "CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'c' || CAST(o_custkey AS STRING) END", "score": "l_discount * 10"}


@query(f"""
WITH RECURSIVE {FACTS}, games AS (SELECT {listed(GAMES)} FROM facts), ok AS (SELECT * FROM games WHERE b IS NOT NULL),
sides AS (SELECT date, a AS entity, b AS other, score FROM ok UNION ALL SELECT date, b, a, 1 - score FROM ok),
days AS (SELECT entity, date, sum(score) AS s, count(*) AS n FROM sides GROUP BY ALL),
forms AS (SELECT entity, date, row_number() OVER w AS nth, n,
  (coalesce(sum(s) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 5) / (coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 10) AS form
  FROM days WINDOW w AS (PARTITION BY entity ORDER BY date)),
met AS (SELECT s.entity, s.date, f.nth, f.n, list({{'r': 1500 + 400 * log10(o.form / (1 - o.form)), 's': s.score}} ORDER BY o.form, s.score) AS games
  FROM sides s JOIN forms f ON s.entity = f.entity AND s.date = f.date JOIN forms o ON s.other = o.entity AND s.date = o.date GROUP BY ALL),
r AS (
  SELECT entity, nth, date, n, 1500::DOUBLE AS before, 1500 + 20 * list_sum(list_transform(games, lambda g: g.s - 1 / (1 + pow(10, (g.r - 1500) / 400)))) AS after FROM met WHERE nth = 1
  UNION ALL
  SELECT m.entity, m.nth, m.date, m.n, r.after, r.after + 20 * list_sum(list_transform(m.games, lambda g: g.s - 1 / (1 + pow(10, (g.r - r.after) / 400)))) FROM r JOIN met m ON m.entity = r.entity AND m.nth = r.nth + 1
)
SELECT date, entity, n AS n_games, round(before, 4) AS before, round(after, 4) AS after FROM r
""")
def rating_states(t: Tables) -> DataFrame:
    """Ratings of suppliers and customers, all games of a date at once, by a state for each."""
    return ratings.rate(derived(facts(t), GAMES)).withColumns({c: r6(c, 4) for c in ("before", "after")})


# ---- tables of parts ---------------------------------------------------------------


@query("""
WITH e AS (SELECT event_id AS row_id, user_id, ts::DATE AS event_date, date_trunc('week', ts)::DATE AS batch FROM events), l AS (SELECT *, max(batch) OVER (PARTITION BY user_id) AS last FROM e)
SELECT row_id, user_id AS event_id, event_date FROM l WHERE batch = last AND event_date > DATE '2024-01-05'
""")
def weekly_upserts(t: Tables) -> DataFrame:
    """Weekly batches into a table of buckets, each in place of its keys' rows, past a cutoff."""
    e = I.stamp(t("events").select(F.col("event_id").alias("row_id"), "user_id", "ts"), F.col("user_id"), F.col("ts"))
    e = e.select("row_id", "event_id", "event_date", F.trunc("event_date", "week").alias("batch"))
    target = shape.scratch(e.sparkSession, "upserts")
    for week in [r[0] for r in e.select("batch").distinct().orderBy("batch").collect()]:  # batches as they arrive
        I.upsert_batch(e.filter(F.col("batch") == F.lit(week)).drop("batch"), target, "event_id", "event_date", "2024-01-05", 8)
    return I.upserted(e.sparkSession, target).select("row_id", "event_id", "event_date")


@query("SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def swapped_table(t: Tables) -> DataFrame:
    """A table replaced twice by what it holds itself."""
    o = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    where = shape.scratch(o.sparkSession, "swapped")
    S.replace_table(o, where)
    S.replace_table(S.current_table(o.sparkSession, where).filter("o_orderstatus <> 'F'"), where)
    S.replace_table(S.current_table(o.sparkSession, where).withColumn("o_totalprice", F.col("o_totalprice") * 2), where)
    return S.current_table(o.sparkSession, where).select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m') AS block, l_returnflag, count(*) AS n, sum(l_orderkey)::BIGINT AS keys
FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' AND (l_shipdate < DATE '1997-01-01' OR l_orderkey % 5 > 0) GROUP BY ALL
""")
def rebuilt_blocks(t: Tables) -> DataFrame:
    """Monthly blocks of a report after the source lost some months and changed others."""
    line = t("lineitem").select("l_orderkey", "l_returnflag", "l_shipdate", F.date_format("l_shipdate", "yyyy-MM").alias("block"))
    count = lambda df: df.groupBy("block", "l_returnflag").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))
    where = shape.scratch(line.sparkSession, "blocks")
    I.rebuild_blocks(line.filter("l_shipdate < '2000-01-01'"), "block", where, count)
    late = F.col("l_shipdate") >= F.lit("1997-01-01").cast("date")
    now = line.filter((F.col("l_shipdate") >= F.lit("1996-01-01").cast("date")) & (~late | (F.col("l_orderkey") % 5 > 0)))
    I.rebuild_blocks(now, "block", where, count)
    return PartedTable(line.sparkSession, f"{where}/rows").read().select("block", "l_returnflag", "n", "keys")


@query("""
SELECT o_orderkey::VARCHAR AS o_id, l_linenumber::VARCHAR AS id, l_partkey::VARCHAR AS part, CASE WHEN o_orderkey % 64 >= 48 THEN 2 ELSE 1 END AS run, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
""")
def synced_documents(t: Tables) -> DataFrame:
    """A folder of JSON documents, parsed once, then again where files have come since."""
    spark = t("orders").sparkSession
    lines = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("id"), F.col("l_partkey").alias("part"))).alias("lines"))
    own = t("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("file", F.col("o_orderkey") % 64)
    # a document holds 8,192 orders at most, whatever the table's size
    docs = own.groupBy("file", F.floor(F.col("o_orderkey") / (64 * 8192)).alias("block")).agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), "lines")).alias("orders"))).alias("doc"))
    folder, cache = shape.scratch(spark, "documents"), shape.scratch(spark, "parsed")
    schema = "orders array<struct<id:bigint,lines:array<struct<id:int,part:bigint>>>>"
    for some in (docs.filter("file < 48"), docs.filter("file >= 48")):
        some.select("doc").repartition(16).write.mode("append").option("maxRecordsPerFile", 1).text(folder)  # a file for each document
        parsed = S.sync_documents(spark, folder, cache, schema, 8)
    out = R.explode_documents(parsed, "doc", None, {"orders": ["orders"], "lines": ["orders", "lines"]}, {"orders": "o_id"}, ["run"])
    return out["lines"].groupBy("o_id", "id", "part", "run").agg(F.count("*").alias("n"))


# ---- shards ------------------------------------------------------------------------


@query("""
SELECT l_orderkey::VARCHAR AS id, l_quantity, NULL::DOUBLE AS l_tax, NULL::VARCHAR AS l_shipmode FROM lineitem WHERE l_linenumber = 1
UNION ALL SELECT l_orderkey::VARCHAR, l_quantity, l_tax, NULL FROM lineitem WHERE l_linenumber = 2
UNION ALL SELECT 'x' || l_orderkey, NULL, l_tax, l_returnflag FROM lineitem WHERE l_linenumber = 3
""")
def evolved_shards(t: Tables) -> DataFrame:
    """Shards whose columns changed over time, checked against their manifest, as one table."""
    line = t("lineitem")
    spark = line.sparkSession
    where = shape.scratch(spark, "shards")
    shards = {
        "2001": line.filter("l_linenumber = 1").select(F.col("l_orderkey").cast("int").alias("id"), "l_quantity"),
        "2002": line.filter("l_linenumber = 2").select(F.col("l_orderkey").alias("id"), "l_quantity", "l_tax"),
        "2003": line.filter("l_linenumber = 3").select(F.concat(F.lit("x"), "l_orderkey").alias("id"), "l_tax", F.col("l_returnflag").alias("l_shipmode")),
    }
    for name, df in shards.items():
        S.write_table(df, f"{where}/{name}", 100_000)
    paths = S.resolve_source(spark, where, spark.createDataFrame([(n,) for n in shards], "path string"))
    return S.scan_evolving(spark, paths, ["id", "l_quantity", "l_tax", "l_shipmode"], ["id"])


@query("""
SELECT coalesce(strftime(date_trunc('month', nullif(o_orderdate, TIMESTAMP '1995-01-01')), '%Y-%m-%d'), 'unknown') AS window_start, o_orderpriority, count(*) AS n, round(avg(m), 4) AS mean
FROM (SELECT *, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS m FROM orders) GROUP BY ALL
""")
def merged_windows(t: Tables) -> DataFrame:
    """Monthly windows with a manifest, merged into one table with columns over all of it."""
    o = t("orders").select("o_orderkey", "o_orderpriority", "o_totalprice", F.expr("nullif(CAST(o_orderdate AS DATE), DATE '1995-01-01')").alias("day"))
    spark = o.sparkSession
    windows, manifest, merged = (shape.scratch(spark, n) for n in ("windows", "manifest", "merged"))
    S.write_windows(o, windows, "day")
    listed_ = S.write_manifest(spark, windows, manifest, "day")
    S.merge_windows(spark, [windows], merged, ["o_orderkey"])
    whole = S.attach_global_columns(spark.read.parquet(merged), "o_orderpriority", {"mean": F.avg("o_totalprice")})
    whole = whole.withColumn("window_start", S.window_column("day")).join(listed_.select(F.col("window").alias("window_start")), "window_start", "left_semi")
    return whole.groupBy("window_start", "o_orderpriority").agg(F.count("*").alias("n"), r6(F.avg("mean"), 4).alias("mean"))


@query("""
SELECT 'full' AS variant, count(*) AS n, sum(p_size)::BIGINT AS size, 9 AS columns FROM part
UNION ALL SELECT 'narrow', count(*), sum(p_size)::BIGINT, 8 FROM part
UNION ALL SELECT 'sample', count(*), sum(p_size)::BIGINT, 9 FROM (SELECT * FROM part ORDER BY md5('5|' || p_partkey), p_partkey LIMIT 300)
""")
def table_variants(t: Tables) -> DataFrame:
    """A table in full, without some columns, and as a seeded sample."""
    part = t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", F.lit(1).alias("x1"), F.lit(2).alias("x2"), F.lit("c").alias("comment"))
    where = shape.scratch(part.sparkSession, "variants")
    S.write_variants(part, where, ["p_partkey"], 300, ["comment"], 5)
    out = []
    for name in ("full", "narrow", "sample"):
        df = part.sparkSession.read.parquet(f"{where}/{name}")
        out.append(df.agg(F.count("*").alias("n"), F.sum("p_size").cast("long").alias("size")).select(F.lit(name).alias("variant"), "n", "size", F.lit(len(df.columns)).alias("columns")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("""
SELECT o_orderpriority, count(*) AS n, count(l_orderkey) AS lines, round(sum(l_quantity), 2) AS quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1
""")
def bucketed_join(t: Tables) -> DataFrame:
    """Facts and dimension dealt by block and key into buckets; their join moves no row."""
    spark = t("orders").sparkSession
    names = {n: f"b_{shape.scratch(spark, n).rsplit('-', 1)[1]}" for n in ("orders", "lineitem")}
    block = (F.col("key") % 16).alias("block")
    S.write_bucketed(t("orders").withColumn("key", F.col("o_orderkey")).select("key", block, "o_orderpriority"), names["orders"], shape.scratch(spark, "bo"), ["block", "key"], 8)
    S.write_bucketed(t("lineitem").withColumn("key", F.col("l_orderkey")).select("key", block, "l_orderkey", "l_quantity"), names["lineitem"], shape.scratch(spark, "bl"), ["block", "key"], 8)
    out = joins.block_join(spark.table(names["orders"]), spark.table(names["lineitem"]), ["key"], "block")
    return out.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count("l_orderkey").alias("lines"), r6(F.sum("l_quantity"), 2).alias("quantity"))


# ---- search --------------------------------------------------------------------------


@query("""
WITH p AS (SELECT DISTINCT p_partkey AS player_number, p_name AS player_name FROM part)
SELECT player_number, player_name, round(1.0 - levenshtein(lower(player_name), 'stell widgat') / greatest(length(player_name), 12), 6) AS score FROM p
WHERE 1.0 - levenshtein(lower(player_name), 'stell widgat') / greatest(length(player_name), 12) >= 0.55
  AND len(list_intersect(list_distinct([substr('  ' || lower(player_name) || '  ', i, 3) for i in range(1, length(player_name) + 3)]), list_distinct([substr('  stell widgat  ', i, 3) for i in range(1, 15)]))) >= 5
ORDER BY score DESC, player_name, player_number LIMIT 20
""")
def typo_search(t: Tables) -> DataFrame:
    """Part names nearest to a misspelt one, through a 3-gram index."""
    part = t("part").select(F.col("p_partkey").alias("player_number"), F.col("p_name").alias("player_name"))
    where = shape.scratch(part.sparkSession, "grams")
    fuzzy.write_gram_index(part, "player_name", where)
    found = serve.typo_lookup(part, "stell widgat", 20, part.sparkSession.read.parquet(where))
    return found.withColumn("score", r6("score"))
