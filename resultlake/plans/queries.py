"""Queries of the library's operators on the star schema, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.functions import columns as X
from resultlake.operators import aggs, fuzzy, joins, pick, quality, sets, shape, windows
from resultlake.plans import reports as R
from resultlake.sources import tables as S
from resultlake.streaming import incremental as I

Tables = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of a table reader under its own name, with the SQL that gives the same rows."""

    def put(fn: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(lambda name: S.read_table(spark, sf_dir, name))
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return put


def facts(t: Tables) -> DataFrame:
    """Lines with their order: the result rows of the star schema."""
    return t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))


FACTS = "facts AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def r6(c, n: int = 6):  # noqa: ANN001, ANN201
    return F.round(c, n)


# ---- evaluation and reports -------------------------------------------------


@query(f"""
WITH {FACTS}
SELECT o_orderpriority, l_suppkey AS pair, round(avg(l_discount), 6) AS actual, count(*) AS boards, 'NS' AS direction
FROM facts GROUP BY ALL HAVING count(*) >= 8
UNION ALL
SELECT o_orderpriority, o_custkey, round(avg(1 - l_discount), 6), count(*), 'EW' FROM facts GROUP BY ALL HAVING count(*) >= 8
""")
def pair_sessions(t: Tables) -> DataFrame:
    """C20 core: means of pairs in both directions."""
    return R.pair_sessions(facts(t), ["o_orderpriority"], "l_suppkey", "o_custkey", "l_discount", []).withColumn("actual", r6("actual"))


@query("""
SELECT r_name, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""")
def join_dims(t: Tables) -> DataFrame:
    """Revenue by region along a chain of dimensions."""
    dims = [(t("orders").withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey"), (t("customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"), (t("nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"), (t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")]
    return joins.join_dims(t("lineitem"), dims).groupBy("r_name").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("""
SELECT a.l_orderkey, a.l_suppkey AS supp_ns, b.l_suppkey AS supp_ew, count(*) AS n, round(sum(a.l_quantity - b.l_quantity), 4) AS diff
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey % 2 = 0 AND b.l_suppkey % 2 = 1 AND a.l_linenumber + 1 = b.l_linenumber
GROUP BY ALL
""")
def crossed_pairs(t: Tables) -> DataFrame:
    """Two views of a table that name each other."""
    line = t("lineitem").withColumns({"own": F.col("l_linenumber"), "other": F.when(F.col("l_suppkey") % 2 == 0, F.col("l_linenumber") + 1).otherwise(F.col("l_linenumber") - 1)})
    both = joins.pair_views(line.select("l_orderkey", "own", "other", "l_suppkey", "l_quantity"), ["l_orderkey"], ("own", "other"))
    both = both.filter((F.col("l_suppkey_ns") % 2 == 0) & (F.col("l_suppkey_ew") % 2 == 1))
    return both.groupBy("l_orderkey", F.col("l_suppkey_ns").alias("supp_ns"), F.col("l_suppkey_ew").alias("supp_ew")).agg(F.count("*").alias("n"), r6(F.sum(F.col("l_quantity_ns") - F.col("l_quantity_ew")), 4).alias("diff"))


@query("""
SELECT nc.n_name AS n_name_customer, ns.n_name AS n_name_supplier, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation nc ON c_nationkey = nc.n_nationkey LEFT JOIN nation ns ON s_nationkey = ns.n_nationkey GROUP BY ALL
""")
def role_lookup(t: Tables) -> DataFrame:
    """One dimension in two roles."""
    f = facts(t).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"), "left").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return joins.join_roles(f, t("nation"), "n_nationkey", {"customer": "c_nationkey", "supplier": "s_nationkey"}, ["n_name"]).groupBy("n_name_customer", "n_name_supplier").agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey AS key, 'part' AS kind FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate >= DATE '2001-01-01')
UNION ALL
SELECT c_custkey, 'customer' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def keep_drop(t: Tables) -> DataFrame:
    """Semi- and anti-joins."""
    late = t("lineitem").filter(F.col("l_shipdate") >= F.lit("2001-01-01").cast("date")).select(F.col("l_partkey").alias("p_partkey"))
    gone = joins.drop_keys(t("part"), late, ["p_partkey"]).select(F.col("p_partkey").alias("key"), F.lit("part").alias("kind"))
    done = t("orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return gone.unionByName(joins.keep_keys(t("customer"), done, ["c_custkey"]).select(F.col("c_custkey").alias("key"), F.lit("customer").alias("kind")))


@query("""
WITH a AS (SELECT l_returnflag, nullif(l_linenumber, 7) AS k, count(*) AS n FROM lineitem GROUP BY ALL),
b AS (SELECT nullif(l_linenumber, 7) AS k, round(avg(l_discount), 6) AS mean FROM lineitem GROUP BY ALL)
SELECT a.l_returnflag, a.k, a.n, b.mean FROM a LEFT JOIN b ON a.k IS NOT DISTINCT FROM b.k
""")
def null_safe(t: Tables) -> DataFrame:
    """A join on which nulls match, after a check that it cannot multiply rows."""
    line = t("lineitem").withColumn("k", F.expr("nullif(l_linenumber, 7)"))
    a = line.groupBy("l_returnflag", "k").agg(F.count("*").alias("n"))
    return joins.null_safe_left(a, line.groupBy("k").agg(r6(F.avg("l_discount")).alias("mean")), ["k"])


@query("""
WITH e AS (SELECT *, event_id % 5000 AS k FROM events), a AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-20'), b AS (SELECT * FROM e WHERE ts >= TIMESTAMP '2024-01-20')
SELECT k, event_id, user_id, event_type FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, event_id, user_id, event_type FROM b
""")
def overlay(t: Tables) -> DataFrame:
    """Recent rows in place of older ones."""
    e = t("events").withColumn("k", F.col("event_id") % 5000).select("k", "event_id", "user_id", "event_type", "ts")
    cut = F.lit("2024-01-20").cast("timestamp")
    return joins.overlay(e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut), "k").drop("ts")


@query("""
WITH a AS (SELECT s_suppkey AS k, s_name AS name, s_acctbal AS bal FROM supplier WHERE s_suppkey % 3 > 0),
b AS (SELECT s_suppkey AS k, upper(s_name) AS name, CASE WHEN s_suppkey % 5 > 0 THEN s_acctbal + 1 END AS bal FROM supplier WHERE s_suppkey % 2 = 0)
SELECT k, coalesce(b.name, a.name) AS name, coalesce(b.bal, a.bal) AS bal,
       CASE WHEN a.name IS NOT NULL AND b.name IS NOT NULL THEN 'both' WHEN b.name IS NOT NULL THEN 'official' ELSE 'base' END AS source
FROM a FULL JOIN b USING (k)
""")
def override_merge(t: Tables) -> DataFrame:
    """Official values first, with their source."""
    s = t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    o = s.filter("k % 2 = 0").select("k", F.upper("name").alias("name"), F.when(F.col("k") % 5 > 0, F.col("bal") + 1).alias("bal"))
    return joins.override_merge(s.filter("k % 3 > 0"), o, ["k"], ["name", "bal"])


@query("""
SELECT event_id, user_id, 0 AS rank FROM events WHERE ts >= TIMESTAMP '2024-01-25'
UNION ALL
SELECT event_id, user_id, 1 FROM events WHERE ts < TIMESTAMP '2024-01-25' AND user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-25' AND event_type = 'click')
AND user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-25')
""")
def fresh_first(t: Tables) -> DataFrame:
    """Fresh rows, then history that they do not cover."""
    e = t("events").select("event_id", "user_id", "ts")
    cut = F.lit("2024-01-25").cast("timestamp")
    return joins.fresh_first(e.filter(F.col("ts") >= cut), e.filter(F.col("ts") < cut), "user_id").drop("ts")


@query("""
SELECT n_name, p_brand, count(*) AS n FROM region JOIN nation ON r_regionkey = n_regionkey JOIN supplier ON n_nationkey = s_nationkey
JOIN lineitem ON s_suppkey = l_suppkey JOIN part ON l_partkey = p_partkey WHERE r_name = 'ASIA' GROUP BY ALL
""")
def path_join(t: Tables) -> DataFrame:
    """A path of inner joins from a filtered root."""
    frames = [t("region"), t("nation"), t("supplier"), t("lineitem"), t("part")]
    out = joins.path_join(frames, [("r_regionkey", "n_regionkey"), ("n_nationkey", "s_nationkey"), ("s_suppkey", "l_suppkey"), ("l_partkey", "p_partkey")], F.col("r_name") == "ASIA")
    return out.groupBy("n_name", "p_brand").agg(F.count("*").alias("n"))


@query("""
SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'EUROPE'))
""")
def cascade(t: Tables) -> DataFrame:
    """Key sets handed from hop to hop."""
    tables = {n: t(n) for n in ("region", "nation", "supplier")}
    out = joins.cascade(tables, tables["region"].filter("r_name = 'EUROPE'"), [("region", "r_regionkey", "nation", "n_regionkey"), ("nation", "n_nationkey", "supplier", "s_nationkey")])
    return out["supplier"].select("s_suppkey", "s_name")


@query("""
SELECT l_suppkey, l_linenumber, count(*) AS n, max(d.first_part) AS first_part FROM lineitem JOIN (SELECT l_suppkey AS k, arg_min(l_partkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS first_part FROM lineitem GROUP BY 1) d ON l_suppkey = d.k GROUP BY 1, 2
""")
def broadcast_lookup(t: Tables) -> DataFrame:
    """A dimension reduced to one row for each key before the join."""
    dim = t("lineitem").select("l_suppkey", F.col("l_partkey").alias("first_part"), F.col("l_shipdate").alias("d"), F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("ln"))
    fact = t("lineitem").select("l_suppkey", "l_linenumber")
    return joins.broadcast_lookup(fact, dim, ["l_suppkey"], ["d", "o", "ln", "first_part"]).groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("n"), F.max("first_part").alias("first_part"))


# ---- aggregations -----------------------------------------------------------


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def latest_attr(t: Tables) -> DataFrame:
    """The last attributes of each entity."""
    return aggs.latest(t("events"), ["user_id"], ["ts", "event_id"], ["event_type", "value"])


@query("""
WITH g AS (SELECT l_suppkey, l_returnflag, count(*) AS n, round(stddev_samp(l_discount), 6) AS stat_std FROM lineitem GROUP BY ALL)
SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1
""")
def modal(t: Tables) -> DataFrame:
    """The most common value of each group."""
    return aggs.modal(t("lineitem"), ["l_suppkey"], "l_returnflag", "l_discount").withColumn("stat_std", r6("stat_std"))


@query("""
SELECT count(*) FILTER (l_discount > 0.08) AS high_discount, count(*) FILTER (l_tax NOT BETWEEN 0 AND 0.05) AS odd_tax, count(*) FILTER (l_quantity < 5) AS few, count(*) FILTER (l_returnflag IS NULL) AS no_flag FROM lineitem
""")
def cond_counts(t: Tables) -> DataFrame:
    """Many conditions in one pass."""
    return aggs.conditional_counts(t("lineitem"), {"high_discount": F.col("l_discount") > 0.08, "odd_tax": ~F.col("l_tax").between(0, 0.05), "few": F.col("l_quantity") < 5, "no_flag": F.col("l_returnflag").isNull()})


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT (l_returnflag, l_linestatus)) AS states FROM lineitem GROUP BY 1")
def distinct_counts(t: Tables) -> DataFrame:
    """Exact distinct counts."""
    return aggs.distinct_counts(t("lineitem"), ["l_suppkey"], {"parts": ["l_partkey"], "states": ["l_returnflag", "l_linestatus"]})


@query("SELECT date_trunc('month', l_shipdate)::DATE AS month, count(*) AS n, max(l_shipdate::DATE) AS last_date FROM lineitem GROUP BY 1")
def window_counts(t: Tables) -> DataFrame:
    """Counts by month."""
    return aggs.window_counts(t("lineitem"), "l_shipdate")


@query("SELECT make_date(year(l_shipdate), ((month(l_shipdate) - 1) // 3 * 3 + 1)::BIGINT, 1) AS month, count(*) AS n, max(l_shipdate::DATE) AS last_date FROM lineitem GROUP BY 1")
def window_counts_quarter(t: Tables) -> DataFrame:
    """Months rolled into windows of three."""
    return aggs.window_counts(t("lineitem"), "l_shipdate", 3)


@query("""
SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std, round(stddev_pop(l_extendedprice), 4) AS std_pop, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY 1
""")
def moments(t: Tables) -> DataFrame:
    """Moments of finite values."""
    return aggs.moments(t("lineitem"), ["l_returnflag"], "l_extendedprice").withColumns({c: r6(c, 4) for c in ("mean", "std", "std_pop", "median")})


@query("""
WITH m AS (SELECT 'l_quantity' AS measure, l_quantity AS v FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem)
SELECT measure, count(v) AS n, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(quantile_cont(v, 0.1), 4) AS p10, round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75, round(quantile_cont(v, 0.9), 4) AS p90 FROM m GROUP BY 1
""")
def distributions(t: Tables) -> DataFrame:
    """Percentiles of several measures."""
    return aggs.distributions(t("lineitem"), ["l_quantity", "l_discount", "l_extendedprice"]).withColumns({c: r6(c, 4) for c in ("mean", "std", "p10", "p25", "p50", "p75", "p90")})


_SLOPES = """
s AS (SELECT l_suppkey, count(*)::DOUBLE AS n, sum(l_quantity) AS s1, sum(l_discount) AS y1, sum(l_quantity * l_discount) AS sy, sum(l_quantity * l_quantity) AS s2, sum(l_discount * l_discount) AS y2 FROM lineitem GROUP BY 1),
b AS (SELECT *, CASE WHEN n >= 8 AND s2 - s1 * s1 / n > 1e-8 THEN (sy - s1 * y1 / n) / (s2 - s1 * s1 / n) END AS slope, s1 / n AS mean_s, y1 / n AS mean_y, s2 - s1 * s1 / n AS sxx, y2 - y1 * y1 / n AS syy FROM s),
g AS (SELECT *, CASE WHEN slope IS NOT NULL THEN sqrt(greatest(0, syy - slope * slope * sxx) / (n - 2) / sxx) END AS se FROM b)
"""


@query(f"WITH {_SLOPES} SELECT l_suppkey, n::BIGINT AS n, round(slope, 8) AS slope, round(se, 8) AS se FROM g")
def suff_slopes(t: Tables) -> DataFrame:
    """Slopes from sufficient statistics."""
    return R.group_slopes(aggs.suff_stats(t("lineitem"), ["l_suppkey"], "l_quantity", "l_discount")).select("l_suppkey", "n", r6("slope", 8).alias("slope"), r6("se", 8).alias("se"))


@query(f"""
WITH {_SLOPES},
v AS (SELECT CASE WHEN count(*) FILTER (n >= 16 AND slope IS NOT NULL) >= 50 THEN var_samp(slope) FILTER (n >= 16) - avg(se * se) FILTER (n >= 16) ELSE var_samp(slope) - avg(se * se) END AS v, count(slope) AS c FROM g),
k AS (SELECT CASE WHEN c >= 2 THEN greatest(0, v) ELSE 0 END AS tau2, (SELECT regr_slope(l_discount, l_quantity) FROM lineitem) AS beta0 FROM v),
w AS (SELECT *, CASE WHEN slope IS NULL THEN 0 WHEN se <= 1e-8 THEN 1 WHEN tau2 > 0 THEN tau2 / (tau2 + se * se) ELSE 0 END AS weight FROM g, k),
p AS (SELECT *, weight * coalesce(slope, 0) + (1 - weight) * beta0 AS published FROM w)
SELECT l_suppkey, round(weight, 6) AS weight, round(published, 8) AS published, round(1 - greatest(0, least(1, mean_y + published * (2 - mean_s))), 6) AS difficulty FROM p
""")
def shrink(t: Tables) -> DataFrame:
    """Slopes drawn to the global one, and difficulty."""
    line = t("lineitem")
    slopes = R.group_slopes(aggs.suff_stats(line, ["l_suppkey"], "l_quantity", "l_discount"))
    out = R.shrink(slopes, R.global_slope(line, "l_quantity", "l_discount"), R.prior_variance(slopes))
    return out.select("l_suppkey", r6("weight").alias("weight"), r6("published", 8).alias("published"), r6("difficulty").alias("difficulty"))


@query("""
WITH c AS (SELECT count(*)::DOUBLE AS n, sum(l_quantity) d, sum(l_tax) f, sum(l_quantity*l_quantity) dd, sum(l_quantity*l_tax) df, sum(l_tax*l_tax) ff, sum(l_extendedprice) y, sum(l_quantity*l_extendedprice) dy, sum(l_tax*l_extendedprice) fy FROM lineitem),
x AS (SELECT *, n*(dd*ff-df*df) - d*(d*ff-df*f) + f*(d*df-dd*f) AS det FROM c)
SELECT round((y*(dd*ff-df*df) - d*(dy*ff-df*fy) + f*(dy*df-dd*fy))/det, 3) AS b0, round((n*(dy*ff-df*fy) - y*(d*ff-df*f) + f*(d*fy-dy*f))/det, 4) AS b1, round((n*(dd*fy-dy*df) - d*(d*fy-dy*f) + y*(d*df-dd*f))/det, 2) AS b2 FROM x
""")
def residualize(t: Tables) -> DataFrame:
    """Partial coefficients by normal equations."""
    b = R.partial_coefficient(t("lineitem"), "l_quantity", "l_tax", "l_extendedprice")
    return b.select(r6("b0", 3).alias("b0"), r6("b1", 4).alias("b1"), r6("b2", 2).alias("b2"))


_RANKED = """
t AS (SELECT c_mktsegment, c_acctbal AS x, sum(o_totalprice) AS y FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment, c_acctbal),
k AS (SELECT *, rank() OVER (PARTITION BY c_mktsegment ORDER BY x) + (count(*) OVER (PARTITION BY c_mktsegment, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY c_mktsegment ORDER BY round(y, 4)) + (count(*) OVER (PARTITION BY c_mktsegment, round(y, 4)) - 1) / 2.0 AS ry FROM t)
"""


@query(f"WITH {_RANKED} SELECT c_mktsegment, count(*) AS n, round(corr(rx, ry), 6) AS spearman FROM k GROUP BY 1")
def spearman(t: Tables) -> DataFrame:
    """Rank correlation by group."""
    y = t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey", "c_mktsegment", "c_acctbal").agg(r6(F.sum("o_totalprice"), 4).alias("y"))
    return aggs.spearman(y, ["c_mktsegment"], "c_acctbal", "y", small_groups=False).withColumn("spearman", r6("spearman"))


@query("SELECT p_brand, round(regr_slope(p_retailprice, p_size), 6) AS slope, round(regr_intercept(p_retailprice, p_size), 4) AS intercept, regr_count(p_retailprice, p_size)::BIGINT AS n FROM part GROUP BY 1")
def simple_line(t: Tables) -> DataFrame:
    """A line for each group."""
    return aggs.simple_line(t("part"), "p_size", "p_retailprice", ["p_brand"]).withColumns({"slope": r6("slope"), "intercept": r6("intercept", 4)})


@query("SELECT l_returnflag, count(*) AS n, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1")
def pearson(t: Tables) -> DataFrame:
    """Correlation with guards."""
    return aggs.pearson(t("lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"]).withColumn("r", r6("r"))


_PRED = "p AS (SELECT o_totalprice AS y, avg(o_totalprice) OVER (PARTITION BY c_mktsegment) AS h, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)"


def _predicted(t: Tables) -> DataFrame:
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return windows.entity_mean(o, "c_mktsegment", "o_totalprice", "h")


@query(f"WITH {_PRED} SELECT c_mktsegment, count(*) AS n, round(avg(abs(h - y)), 4) AS mae, round(sqrt(avg((h - y) ** 2)), 4) AS rmse, round(avg(CASE WHEN abs(y - h) <= 50000 THEN 1.0 ELSE 0.0 END), 6) AS coverage FROM p GROUP BY 1")
def errors(t: Tables) -> DataFrame:
    """Errors of an entity's mean as prediction."""
    p = _predicted(t)
    e = aggs.errors(p, "o_totalprice", "h", ["c_mktsegment"]).select("c_mktsegment", "n", r6("mae", 4).alias("mae"), r6("rmse", 4).alias("rmse"))
    c = aggs.coverage(p, "o_totalprice", "h", F.lit(50000), ["c_mktsegment"])
    return e.join(c.withColumn("coverage", r6("coverage")), "c_mktsegment")


_ACT = "CASE WHEN l_quantity > 25 THEN 'big' ELSE 'small' END"
_PRE = "CASE WHEN l_extendedprice > 40000 THEN 'big' WHEN l_extendedprice > 20000 THEN 'mid' ELSE 'small' END"


@query(f"""
WITH x AS (SELECT {_ACT} AS a, {_PRE} AS b FROM lineitem), c AS (SELECT 'big' AS c UNION ALL SELECT 'mid' UNION ALL SELECT 'small'),
m AS (SELECT c, (SELECT count(*) FROM x WHERE a = c) AS t, (SELECT count(*) FROM x WHERE b = c) AS p, (SELECT count(*) FROM x WHERE a = c AND b = c) AS h FROM c)
SELECT round(sum(h) / sum(t), 6) AS accuracy, round(max(t) / sum(t), 6) AS majority, round(avg(2.0 * h / (t + p)), 6) AS macro_f1, sum(t)::BIGINT AS n FROM m WHERE t + p > 0
""")
def classification(t: Tables) -> DataFrame:
    """Accuracy, majority share and macro F1."""
    x = t("lineitem").select(F.expr(_ACT).alias("a"), F.expr(_PRE).alias("b"))
    return aggs.classification_metrics(x, "a", "b").select(*[r6(c).alias(c) for c in ("accuracy", "majority", "macro_f1")], "n")


@query(f"WITH x AS (SELECT {_ACT} AS actual, {_PRE} AS predicted FROM lineitem) SELECT actual, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY actual), 6) AS share FROM x GROUP BY 1, 2")
def bucket_confusion(t: Tables) -> DataFrame:
    """Shares of predicted buckets."""
    x = t("lineitem").select(F.expr(_ACT).alias("a"), F.expr(_PRE).alias("b"))
    return aggs.bucket_confusion(x, "a", "b", lambda c: c).withColumn("share", r6("share"))


@query("SELECT s_nationkey AS k, min(s_suppkey) AS key_1, CASE WHEN count(*) > 1 THEN max(s_suppkey) END AS key_2 FROM supplier GROUP BY 1")
def two_members(t: Tables) -> DataFrame:
    """The first and last member of a group side by side."""
    s = t("supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("key"))
    return aggs.two_members(s, ["k"], "key", ["key"])


@query("SELECT n_nationkey, n_name, coalesce(c, 0) AS n FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS c FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey")
def class_counts(t: Tables) -> DataFrame:
    """Counts for a list of classes, zeros included."""
    return aggs.class_counts(t("supplier").withColumnRenamed("s_nationkey", "n_nationkey"), "n_nationkey", t("nation").select("n_nationkey", "n_name"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def counts(t: Tables) -> DataFrame:
    """Counts of groups."""
    return aggs.counts(t("events"), ["event_type"])


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 600")
def having(t: Tables) -> DataFrame:
    """Groups of enough rows."""
    return aggs.having(t("lineitem"), ["l_suppkey"], 600)


@query(f"WITH {FACTS} SELECT o_orderpriority, round(avg(CASE WHEN l_suppkey = 7 THEN l_discount ELSE 1 - l_discount END), 6) AS score, count(*) AS boards FROM facts WHERE l_suppkey = 7 OR o_custkey = 7 GROUP BY 1")
def player_scores(t: Tables) -> DataFrame:
    """One player's mean score from either side."""
    return aggs.player_scores(facts(t), F.lit(7), {"l_suppkey": "NS", "o_custkey": "EW"}, "l_discount", "o_orderpriority").withColumn("score", r6("score"))


# ---- windows, picks ---------------------------------------------------------


@query("""
WITH k AS (SELECT *, (rank() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_extendedprice) - 1) + (count(*) OVER (PARTITION BY l_suppkey, l_linenumber, l_extendedprice) - 1) / 2.0 AS mp, count(*) OVER (PARTITION BY l_suppkey, l_linenumber) - 1 AS top FROM lineitem)
SELECT l_suppkey, l_linenumber, l_orderkey, l_partkey, l_extendedprice, mp::DOUBLE AS mp, round(CASE WHEN top > 0 THEN mp / top END, 6) AS pct FROM k
""")
def matchpoints(t: Tables) -> DataFrame:
    """Wins and half of ties within a group."""
    out = R.matchpoints(t("lineitem"), ["l_suppkey", "l_linenumber"], "l_extendedprice")
    return out.select("l_suppkey", "l_linenumber", "l_orderkey", "l_partkey", "l_extendedprice", F.col("mp").cast("double").alias("mp"), r6("pct").alias("pct"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, round(greatest(0, least(1, l_discount - avg(l_discount) OVER (PARTITION BY l_suppkey) + 0.5)), 6) AS centered, round(median(l_discount) OVER (PARTITION BY l_suppkey), 6) AS med FROM lineitem
""")
def center(t: Tables) -> DataFrame:
    """Values around their group's mean, and its median."""
    line = windows.partition_median(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount"), ["l_suppkey"], "l_discount", "med")
    return line.select("l_orderkey", "l_linenumber", "l_partkey", r6(windows.center("l_discount", ["l_suppkey"])).alias("centered"), r6("med").alias("med"))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS seq FROM orders")
def history(t: Tables) -> DataFrame:
    """Numbers in date order from 0."""
    return t("orders").select("o_custkey", "o_orderkey", windows.sequence(["o_custkey"], ["o_orderdate", "o_orderkey"]).cast("long").alias("seq"))


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (d) AS duplicates FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS d FROM lineitem) GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicates(t: Tables) -> DataFrame:
    """Rows whose key repeats."""
    line = t("lineitem").select("l_orderkey", "l_linenumber")
    line = line.repartition(shape.parts_of(line), "l_orderkey", "l_linenumber").withColumn("d", windows.duplicate_flag(["l_orderkey", "l_linenumber"]))
    return line.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.count_if("d").alias("duplicates")).filter("n > 1")


@query("""
WITH n AS (SELECT o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders)
SELECT o_custkey, min(i) AS first, max(i) AS last, count(*) AS n, max(i) - min(i) + 1 = count(*) AS contiguous FROM n GROUP BY 1
""")
def contiguous(t: Tables) -> DataFrame:
    """Rows numbered without one task, and whether a key's rows are adjacent."""
    numbered = shape.with_row_id(t("orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "i", 8)
    return windows.contiguous(numbered, ["o_custkey"], "i")


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders) WHERE i % 7 = 0")
def every_kth(t: Tables) -> DataFrame:
    """Every seventh row of an order."""
    return pick.every_kth(t("orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 7).drop("o_orderdate")


@query("SELECT l_suppkey, rank, round(pct, 6) AS pct FROM (SELECT l_suppkey, (rank() OVER (ORDER BY n) + (count(*) OVER (PARTITION BY n) - 1) / 2.0)::DOUBLE AS rank, (rank() OVER (ORDER BY n) + (count(*) OVER (PARTITION BY n) - 1) / 2.0) / count(*) OVER () AS pct FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1))")
def rank_percentile(t: Tables) -> DataFrame:
    """Mean ranks and their percentile."""
    g = windows.ranked(t("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")), [], "n", "rank")
    return shape.attach(g, g.agg(F.count("*").alias("all"))).select("l_suppkey", "rank", r6(F.col("rank") / F.col("all")).alias("pct"))


@query("SELECT o_orderkey, o_custkey, o_orderdate::DATE AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def recent(t: Tables) -> DataFrame:
    """The last rows of an order."""
    return pick.tail(t("orders"), ["o_orderdate", "o_orderkey"], 50).select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))


@query("""
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1), x AS (SELECT *, sum(n) OVER () AS total FROM c),
b AS (SELECT *, (500 * n) // total AS base, (500 * n) % total AS rest FROM x)
SELECT o_orderpriority, n, (base + CASE WHEN row_number() OVER (ORDER BY rest DESC, o_orderpriority) <= 500 - sum(base) OVER () THEN 1 ELSE 0 END)::BIGINT AS take FROM b
""")
def stratified(t: Tables) -> DataFrame:
    """Allocation by largest remainders."""
    return pick.allocation(t("orders").groupBy("o_orderpriority").agg(F.count("*").alias("n")), "o_orderpriority", 500)


@query("""
WITH c AS (SELECT o_orderpriority, count(*) AS n, least(500, sum(count(*)) OVER ()) AS want, sum(count(*)) OVER () AS total FROM orders GROUP BY o_orderpriority),
b AS (SELECT *, want * n // total AS base, (want * n) % total AS rest FROM c),
k AS (SELECT o_orderpriority, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, o_orderpriority) <= want - sum(base) OVER () THEN 1 ELSE 0 END AS take FROM b),
p AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7|' || o_orderkey), o_orderkey) AS nth FROM orders)
SELECT o_orderkey, o_orderpriority FROM p JOIN k USING (o_orderpriority) WHERE nth <= take
""")
def stratified_rows(t: Tables) -> DataFrame:
    """The rows of a proportional sample."""
    return pick.proportional_sample(t("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"], 500, 7)


@query("""
WITH p AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY md5('3|' || o_orderkey), o_orderkey) AS nth FROM orders)
SELECT o_orderkey, o_totalprice, CASE WHEN nth <= 50 THEN 50 WHEN nth <= 100 THEN 100 ELSE 200 END AS sample FROM p WHERE nth <= 200
""")
def nested_samples(t: Tables) -> DataFrame:
    """Samples of which each is within the next."""
    return pick.nested_sample(t("orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], [50, 100, 200], 3)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, 1, 2 LIMIT 5")
def top_duplicates(t: Tables) -> DataFrame:
    """The five worst collisions of a key."""
    return pick.top_duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT p_partkey, p_name, p_retailprice, TRUE AS truncated FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def capped(t: Tables) -> DataFrame:
    """A capped listing that tells whether there is more."""
    ordered = pick.sort_by(t("part").select("p_partkey", "p_name", "p_retailprice"), [("p_retailprice", True), ("p_partkey", False)])
    return pick.capped(ordered, 25)[0]


# ---- priors, luck -----------------------------------------------------------

_PRIOR = """
e AS (SELECT o_custkey, count(*) AS sessions, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS latest FROM orders GROUP BY 1),
a AS (SELECT median(latest) AS anchor FROM e WHERE sessions >= 10)
"""


@query(f"WITH {_PRIOR} SELECT o_custkey, sessions, latest, round((sessions * latest + 50 * anchor) / (sessions + 50), 4) AS published FROM e, a")
def prior(t: Tables) -> DataFrame:
    """Values drawn to the median of established entities."""
    _, out = R.shrinkage_prior(t("orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice")
    return out.select("o_custkey", "sessions", "latest", r6("published", 4).alias("published"))


@query(f"WITH {_PRIOR} SELECT round(median(latest), 4) AS anchor, round(avg(latest), 4) AS mean, round(stddev_pop(latest), 4) AS std, count(latest) AS n, round(quantile_cont(latest, 0.25), 4) AS p25, round(quantile_cont(latest, 0.75), 4) AS p75 FROM e WHERE sessions >= 10")
def prior_anchor(t: Tables) -> DataFrame:
    """What describes established entities."""
    one, _ = R.shrinkage_prior(t("orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice")
    return one.select(*[r6(c, 4).alias(c) if c != "n" else F.col(c) for c in one.columns])


@query("SELECT round(stddev_pop(o_totalprice), 4) AS o_totalprice, NULL::DOUBLE AS absent FROM orders")
def dispersion(t: Tables) -> DataFrame:
    """C11: deviations, absent columns tolerated."""
    return R.dispersion_seeds(t("orders"), ["o_totalprice", "absent"]).withColumn("o_totalprice", r6("o_totalprice", 4))


_LUCK = f"""
{FACTS}, h AS (SELECT *, avg(l_discount) OVER (PARTITION BY l_partkey) AS pred FROM facts),
g AS (SELECT l_suppkey, o_orderpriority, count(*) AS n_boards, avg(l_discount) AS actual, avg(pred) AS predicted, stddev_samp(l_discount) AS sd, avg(l_quantity) AS skill FROM h GROUP BY 1, 2),
s AS (SELECT *, actual - predicted AS luck, sd / sqrt(n_boards) AS sem FROM g)
"""


@query(f"""
WITH {_LUCK}
SELECT l_suppkey, o_orderpriority, n_boards, round(luck, 6) AS luck, round(sem, 6) AS sem, round(actual - 1.96 * sem, 6) AS ci_lo, round(actual + 1.96 * sem, 6) AS ci_hi, round(CASE WHEN sem > 0 THEN luck / sem END, 4) AS z FROM s
""")
def luck(t: Tables) -> DataFrame:
    """Luck against skill by supplier and priority."""
    f = windows.entity_mean(facts(t), "l_partkey", "l_discount", "pred")
    out = R.luck_report(f, ["l_suppkey", "o_orderpriority"], "l_discount", "pred")
    return out.select("l_suppkey", "o_orderpriority", "n_boards", *[r6(c).alias(c) for c in ("luck", "sem", "ci_lo", "ci_hi")], r6("z", 4).alias("z"))


@query(f"""
WITH {_LUCK}
SELECT l_suppkey, o_orderpriority, round(((rank() OVER (ORDER BY round(skill, 6)) + (count(*) OVER (PARTITION BY round(skill, 6)) - 1) / 2.0)) / count(*) OVER (), 6) AS skill_pct FROM s
""")
def skill_percentile(t: Tables) -> DataFrame:
    """Rank of skill over all groups, without one task for all of them."""
    f = windows.entity_mean(facts(t), "l_partkey", "l_discount", "pred")
    g = f.groupBy("l_suppkey", "o_orderpriority").agg(r6(F.avg("l_quantity")).alias("skill"), F.avg("l_discount").alias("l_discount"), F.avg("pred").alias("pred"))
    out = R.luck_report(g, ["l_suppkey", "o_orderpriority"], "l_discount", "pred", skill="skill")
    return out.select("l_suppkey", "o_orderpriority", r6("skill_pct").alias("skill_pct"))


_PAIRS = """
{facts}, h AS (SELECT *, avg(l_discount) OVER (PARTITION BY l_partkey) AS pred FROM facts),
p AS (SELECT o_orderpriority, l_suppkey AS pair, 'NS' AS direction, avg(l_discount) AS actual, avg(pred) AS pred, count(*) AS boards FROM h GROUP BY ALL HAVING count(*) >= 8
UNION ALL SELECT o_orderpriority, o_custkey, 'EW', avg(1 - l_discount), avg(1 - pred), count(*) FROM h GROUP BY ALL HAVING count(*) >= 8)
""".format(facts=FACTS)


def _pairs(t: Tables) -> tuple[DataFrame, DataFrame]:
    f = windows.entity_mean(facts(t), "l_partkey", "l_discount", "pred")
    p = R.pair_sessions(f, ["o_orderpriority"], "l_suppkey", "o_custkey", "l_discount", ["pred"])
    return f, p


@query(f"""
WITH {_PAIRS}, r AS (SELECT *, rank() OVER (PARTITION BY o_orderpriority, direction ORDER BY round(pred, 9)) + (count(*) OVER (PARTITION BY o_orderpriority, direction, round(pred, 9)) - 1) / 2.0 AS x,
rank() OVER (PARTITION BY o_orderpriority, direction ORDER BY round(actual, 9)) + (count(*) OVER (PARTITION BY o_orderpriority, direction, round(actual, 9)) - 1) / 2.0 AS y FROM p)
SELECT o_orderpriority, direction, count(*) AS n, round(corr(x, y), 6) AS spearman FROM r GROUP BY 1, 2 HAVING count(*) >= 4
""")
def rank_quality(t: Tables) -> DataFrame:
    """C20: rank correlation of predicted and actual means."""
    _, p = _pairs(t)
    p = p.withColumns({"pred": r6("pred", 9), "actual": r6("actual", 9)})
    return R.rank_quality(p, ["o_orderpriority"], "pred").withColumn("spearman", r6("spearman"))


@query(f"""
WITH {_PAIRS}, b AS (SELECT stddev_samp(pred - l_discount) AS sd FROM h), w AS (SELECT sqrt(avg(((pred - actual) * sqrt(boards) / sd) ** 2)) AS wide FROM p, b)
SELECT round(max(sd), 6) AS board_sd, round(max(wide), 6) AS widening, round(avg(CASE WHEN abs(pred - actual) <= 1.96 * sd / sqrt(boards) THEN 1.0 ELSE 0.0 END), 6) AS coverage_plain,
round(avg(CASE WHEN abs(pred - actual) <= 1.96 * wide * sd / sqrt(boards) THEN 1.0 ELSE 0.0 END), 6) AS coverage_widened, count(*) AS pairs FROM p, b, w
""")
def interval(t: Tables) -> DataFrame:
    """Spread, widening and coverage."""
    out = R.interval(*_pairs(t), "l_discount", "pred")
    return out.select(*[r6(c).alias(c) if c != "pairs" else F.col(c) for c in out.columns])


@query("SELECT abs(corr(l_quantity, l_quantity * 3)) >= 1 - 1e-9 AS same, 'l_quantity' AS a, 'triple' AS b FROM lineitem")
def scaled_copies(t: Tables) -> DataFrame:
    """Columns that are scaled copies of others."""
    line = t("lineitem").withColumn("triple", F.col("l_quantity") * 3)
    return R.scaled_copies(line, [("l_quantity", "triple"), ("l_quantity", "l_discount")]).select("a", "b", (F.col("r") >= 1 - 1e-9).alias("same"))


# ---- sets, quality ----------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1
""")
def unique_key(t: Tables) -> DataFrame:
    """The first row of each key by all columns."""
    line = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return sets.unique_by(line, ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query("""
WITH b AS (SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 3 THEN s_name || '!' ELSE s_name END AS s_name, CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 1 ELSE s_nationkey END AS s_nationkey FROM supplier WHERE s_suppkey % 17 > 0)
SELECT 'schema' AS "check", TRUE AS passed, '' AS detail, 0::BIGINT AS n
UNION ALL SELECT 'count', x = y, x || ' ' || y, abs(x - y) FROM (SELECT (SELECT count(*) FROM supplier) AS x, (SELECT count(*) FROM b) AS y)
UNION ALL SELECT 'keys only in a', count(*) = 0, '', count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM b)
UNION ALL SELECT 'keys only in b', count(*) = 0, '', count(*) FROM b WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'column s_name', count(*) FILTER (a.s_name IS DISTINCT FROM b.s_name) = 0, coalesce(min(a.s_suppkey::VARCHAR) FILTER (a.s_name IS DISTINCT FROM b.s_name), ''), count(*) FILTER (a.s_name IS DISTINCT FROM b.s_name) FROM supplier a JOIN b USING (s_suppkey)
UNION ALL SELECT 'column s_nationkey', count(*) FILTER (a.s_nationkey IS DISTINCT FROM b.s_nationkey) = 0, coalesce(min(a.s_suppkey::VARCHAR) FILTER (a.s_nationkey IS DISTINCT FROM b.s_nationkey), ''), count(*) FILTER (a.s_nationkey IS DISTINCT FROM b.s_nationkey) FROM supplier a JOIN b USING (s_suppkey)
""")
def compare_tables(t: Tables) -> DataFrame:
    """Two versions of a table, column by column."""
    a = t("supplier").select("s_suppkey", "s_name", "s_nationkey")
    b = a.filter("s_suppkey % 17 > 0").select("s_suppkey", F.when(F.col("s_suppkey") % 10 == 3, F.concat("s_name", F.lit("!"))).otherwise(F.col("s_name")).alias("s_name"), F.when(F.col("s_suppkey") % 4 == 0, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey")).alias("s_nationkey"))
    return quality.compare(a, b, ["s_suppkey"])


@query("SELECT p_partkey AS k, 'a' AS side FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 2 = 1 UNION ALL SELECT p_partkey, 'b' FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 > 0")
def key_diff(t: Tables) -> DataFrame:
    """Keys on one side only."""
    k = t("part").select(F.col("p_partkey").alias("k"))
    return sets.key_diff(k.filter("k % 3 = 0"), k.filter("k % 2 = 0"), ["k"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def row_multiset(t: Tables) -> DataFrame:
    """Rows with how often each occurs."""
    return sets.row_counts(t("lineitem").select("l_orderkey", "l_linenumber")).filter("__n > 1").withColumnRenamed("__n", "copies")


@query("SELECT s_nationkey, count(DISTINCT s_name) AS n_values FROM supplier GROUP BY 1 HAVING count(DISTINCT s_name) > 1")
def dependency(t: Tables) -> DataFrame:
    """Q03: keys with more than one value."""
    return quality.conflicting(t("supplier"), ["s_nationkey"], ["s_name"])


@query("""
SELECT 'range l_discount' AS "check", count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.08) = 0 AS passed, '' AS detail, count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.08) AS n FROM lineitem
UNION ALL SELECT 'range l_tax', count(*) FILTER (NOT l_tax BETWEEN 0 AND 0.08) = 0, '', count(*) FILTER (NOT l_tax BETWEEN 0 AND 0.08) FROM lineitem
UNION ALL SELECT 'range absent', FALSE, 'missing', 0
""")
def check_ranges(t: Tables) -> DataFrame:
    """Q04: values out of range in one pass, absent columns told."""
    return quality.check_ranges(t("lineitem"), ["l_discount", "l_tax", "absent"], 0.0, 0.08)


@query("""
SELECT 'unique l_orderkey,l_linenumber' AS "check", FALSE AS passed, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS n
""")
def check_unique(t: Tables) -> DataFrame:
    """Q01: whether a key is unique."""
    return quality.check_unique(t("lineitem"), ["l_orderkey", "l_linenumber"], numeric=True).drop("detail")


@query("""
SELECT 'discount rate' AS "check", (a / b) BETWEEN 0.025 AND 0.08 AS passed, a::BIGINT AS n FROM (SELECT count(*) FILTER (l_discount >= 0.1) AS a, count(*)::DOUBLE AS b FROM lineitem WHERE l_returnflag = 'R')
""")
def check_share(t: Tables) -> DataFrame:
    """Q07: a share within limits."""
    return quality.check_share(t("lineitem"), "discount rate", F.col("l_discount") >= 0.1, F.col("l_returnflag") == "R", 0.025, 0.08).drop("detail")


@query("""
SELECT 'price = quantity x unit' AS "check", count(*) FILTER (NOT l_extendedprice >= l_quantity) = 0 AS passed, '' AS detail, count(*) FILTER (NOT l_extendedprice >= l_quantity) AS n FROM lineitem
""")
def check_identity(t: Tables) -> DataFrame:
    """Q06: a relation between columns."""
    return quality.check_identity(t("lineitem"), "price = quantity x unit", F.col("l_extendedprice") >= F.col("l_quantity"))


@query("""
WITH p AS (SELECT CASE WHEN l_suppkey <> l_partkey THEN least(l_suppkey::VARCHAR, l_partkey::VARCHAR) || '-' || greatest(l_suppkey::VARCHAR, l_partkey::VARCHAR) END AS pair, CASE WHEN l_suppkey % 50 = 0 THEN 0 ELSE l_suppkey END AS id FROM lineitem)
SELECT 'zero id' AS "check", count(*) FILTER (id = 0) = 0 AS passed, '' AS detail, count(*) FILTER (id = 0) AS n FROM p
UNION ALL SELECT 'null id', count(*) FILTER (id IS NULL) = 0, '', count(*) FILTER (id IS NULL) FROM p
UNION ALL SELECT 'self pair', TRUE, '', 0 UNION ALL SELECT 'unordered pair', TRUE, '', 0
""")
def check_ids(t: Tables) -> DataFrame:
    """Q08: hygiene of ids and pair keys."""
    p = t("lineitem").select(X.pair_key("l_suppkey", "l_partkey").alias("pair"), F.when(F.col("l_suppkey") % 50 == 0, 0).otherwise(F.col("l_suppkey")).alias("id"))
    return quality.check_ids(p, ["id"], ["pair"])


@query("""
WITH bad AS (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7), o AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM bad))
SELECT 'orders' AS "table", count(*) AS n FROM o UNION ALL SELECT 'lines', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM bad)
""")
def reject_documents(t: Tables) -> DataFrame:
    """Q02: documents of which any row lacks a value are left out whole."""
    lines = t("lineitem").select(F.col("l_orderkey").alias("doc"), F.expr("nullif(l_linenumber, 7)").alias("line"))
    orders = t("orders").select(F.col("o_orderkey").alias("doc"), "o_custkey")
    kept, _ = quality.reject_documents({"orders": orders, "lines": lines}, {"lines": ["line"], "orders": ["o_custkey"]}, "doc")
    return kept["orders"].agg(F.count("*").alias("n")).withColumn("table", F.lit("orders")).unionByName(kept["lines"].agg(F.count("*").alias("n")).withColumn("table", F.lit("lines")))


@query("""
SELECT count(*) AS expected, count(*) FILTER (d) AS complete, count(*) FILTER (NOT d) AS missing, count(*) FILTER (NOT d AND u) AS unavailable, count(*) FILTER (NOT d AND NOT u) AS unresolved
FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders) AS d, c_acctbal < 0 AS u FROM customer)
""")
def audit(t: Tables) -> DataFrame:
    """Q11: what is expected, done, gone and open."""
    c = t("customer")
    return quality.audit(c, t("orders").select(F.col("o_custkey").alias("c_custkey")), c.filter("c_acctbal < 0"), "c_custkey")


@query("SELECT 'aligned bal' AS \"check\", count(*) = 0 AS passed, '' AS detail, count(*) AS n FROM customer WHERE c_custkey % 100 = 1")
def check_aligned(t: Tables) -> DataFrame:
    """Q12: two tables agree on a column, key by key."""
    a = t("customer").select("c_custkey", F.col("c_acctbal").alias("bal"))
    return quality.check_aligned(a, a.withColumn("bal", F.when(F.col("c_custkey") % 100 == 1, F.col("bal") + 1).otherwise(F.col("bal"))), "c_custkey", "bal")


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_discount <= 0.05 AND NOT (l_quantity - 10 < 0 OR l_tax < 0 OR l_quantity - 10 + l_tax = 0) GROUP BY 1")
def sanity_drops(t: Tables) -> DataFrame:
    """Q05, Q10: rows out of range or with impossible scores go."""
    line = t("lineitem").withColumn("q", F.col("l_quantity") - 10)
    return quality.drop_insane(quality.drop_out_of_range(line, ["l_discount"], 0.0, 0.05), "q", "l_tax").groupBy("l_returnflag").agg(F.count("*").alias("n"))


# ---- columns, shape ---------------------------------------------------------


@query("""
SELECT DISTINCT role, CASE WHEN a <> b THEN least(a, b) || '-' || greatest(a, b) END AS pair FROM (
SELECT 'supplier' AS role, l_suppkey::VARCHAR AS a, l_partkey::VARCHAR AS b FROM lineitem UNION ALL SELECT 'order', l_orderkey::VARCHAR, l_partkey::VARCHAR FROM lineitem)
""")
def pair_keys(t: Tables) -> DataFrame:
    """Unordered keys stacked from two roles."""
    keyed = t("lineitem").select(X.pair_key("l_suppkey", "l_partkey").alias("k1"), X.pair_key("l_orderkey", "l_partkey").alias("k2"))
    return sets.stack_roles(keyed, {"supplier": {"pair": "k1"}, "order": {"pair": "k2"}}, []).distinct()


@query("""
SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) < 4 THEN lpad(c_custkey::VARCHAR, 4, '0') ELSE c_custkey::VARCHAR END AS padded, split_part(c_name, '#', 1) AS prefix, substr(c_name, 1, 4) AS block, trim(regexp_replace('Last, ' || c_mktsegment, '^\\s*([^,]*?)\\s*,\\s*(.*?)\\s*$', '\\2 \\1')) AS flipped,
trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS folded FROM customer
""")
def text_funcs(t: Tables) -> DataFrame:
    """Text functions."""
    return t("customer").select("c_custkey", X.zfill(F.col("c_custkey").cast("string"), 4).alias("padded"), X.id_prefix("c_name", "#").alias("prefix"), X.block_key("c_name").alias("block"), X.given_first(F.concat(F.lit("Last, "), "c_mktsegment")).alias("flipped"), X.fold_text("c_name").alias("folded"))


@query("SELECT o_orderpriority, coalesce(try_cast(regexp_extract(o_orderpriority, '^\\s*([+-]?\\d+)', 1) AS INTEGER), 0) AS rank, count(*) AS n FROM orders GROUP BY 1, 2")
def leading_number(t: Tables) -> DataFrame:
    """The number that a text begins with."""
    return t("orders").groupBy("o_orderpriority", X.leading_number("o_orderpriority").alias("rank")).agg(F.count("*").alias("n"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_flatten(t: Tables) -> DataFrame:
    """Scalars of JSON objects, typed."""
    return t("events").select("event_id", X.json_scalars("props", {"k": "int"})["k"].alias("k"))


@query("SELECT o_orderkey::VARCHAR AS o_id, l_linenumber::VARCHAR AS id, l_partkey::VARCHAR AS part, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL")
def order_documents(t: Tables) -> DataFrame:
    """Nested documents back to lines with their parents' keys."""
    parts = shape.parts_of(t("lineitem"))  # of documents, of lines and, far smaller, of orders
    lines = t("lineitem").repartition(parts, "l_orderkey").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("id"), F.col("l_partkey").alias("part"))).alias("lines"))
    docs = t("orders").repartition(parts, "o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(F.to_json(F.struct(F.array(F.struct(F.col("o_orderkey").alias("id"), "lines")).alias("orders"))).alias("doc"))
    out = S.normalize_documents(docs, "doc", "orders array<struct<id:bigint,lines:array<struct<id:int,part:bigint>>>>", {"orders": ["orders"], "lines": ["orders", "lines"]}, {"orders": "o_id"})
    return out["lines"].repartition(parts, "o_id", "id", "part").groupBy("o_id", "id", "part").agg(F.count("*").alias("n"))


@query("""
SELECT page_id, href, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1)) AS href FROM pages) GROUP BY 1, 2
""")
def html_links(t: Tables) -> DataFrame:
    """Links of pages."""
    return S.html_links(t("pages"), ["page_id"], "html").groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query("""
WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT o_custkey || '-' || i AS child_id, i FROM c, unnest(range(1, n + 1)) AS u(i))
SELECT child_id FROM e WHERE i % 2 = 0
""")
def expand(t: Tables) -> DataFrame:
    """Child ids that are expected and not yet done."""
    c = t("orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    expected = S.expand_ids(c, "o_custkey", "n")
    done = expected.filter(F.split_part("child_id", F.lit("-"), F.lit(2)).cast("int") % 2 == 1)
    return joins.drop_keys(expected, done, ["child_id"])


@query("SELECT year(o_orderdate)::BIGINT AS year, o_orderdate::DATE >= DATE '2000-01-01' AS is_test, count(*) AS n, min(o_orderdate::DATE) AS first_date, max(o_orderdate::DATE) AS last_date FROM orders GROUP BY 1, 2")
def split(t: Tables) -> DataFrame:
    """Training and test rows by year."""
    return aggs.split_counts(t("orders"), "o_orderdate", "2000-01-01").withColumn("year", F.col("year").cast("long"))


@query("SELECT o_orderkey, o_orderdate::DATE AS o_orderdate, o_orderdate::DATE < DATE '2000-01-01' AS is_train, o_orderdate::DATE >= DATE '2000-01-01' AS is_test FROM orders")
def add_split(t: Tables) -> DataFrame:
    """Indicator columns of a temporal split."""
    return shape.add_split(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "2000-01-01")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' WHEN 'P' THEN 'pending' END AS o_orderstatus FROM orders")
def remap(t: Tables) -> DataFrame:
    """Values by a dictionary."""
    return shape.remap(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "final", "O": "open", "P": "pending"}, strict=False)


@query("SELECT l_returnflag, round(avg(l_discount * 100), 6) AS pct FROM lineitem GROUP BY 1")
def scale_percent(t: Tables) -> DataFrame:
    """Fractions as percentages where the column's maximum allows."""
    return shape.scale_percent(t("lineitem").select("l_returnflag", "l_discount"), ["l_discount"]).groupBy("l_returnflag").agg(r6(F.avg("l_discount")).alias("pct"))


@query("SELECT count(*) FILTER (p_name IS NULL) AS p_name, count(*) FILTER (p_size IS NULL) AS p_size FROM part")
def null_counts(t: Tables) -> DataFrame:
    """A10: nulls by column."""
    return aggs.null_counts(t("part").select("p_name", "p_size"))


@query("SELECT s_suppkey AS k, s_name AS name, NULL::INTEGER AS size FROM supplier UNION ALL SELECT p_partkey, p_name, p_size FROM part")
def union_relaxed(t: Tables) -> DataFrame:
    """Tables of different columns as one."""
    return sets.union_relaxed([t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), t("part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))])


@query("SELECT l_orderkey, l_linenumber, (((l_linenumber - 1) // 4) + ((l_linenumber - 1) & 3)) & 3 AS vul, count(*) AS n FROM lineitem GROUP BY ALL")
def board_vul(t: Tables) -> DataFrame:
    """Vulnerability by board number."""
    return t("lineitem").groupBy("l_orderkey", "l_linenumber", X.board_vul("l_linenumber").alias("vul")).agg(F.count("*").alias("n"))


# ---- incremental ------------------------------------------------------------


@query("""
WITH a AS (SELECT date_trunc('month', l_shipdate)::DATE AS block, count(*) AS n, sum(l_orderkey * 7 + l_partkey)::BIGINT AS s FROM lineitem GROUP BY 1),
b AS (SELECT date_trunc('month', l_shipdate)::DATE AS block, count(*) AS n, sum(l_orderkey * 7 + CASE WHEN l_orderkey % 1000 = 1 THEN l_partkey + 1 ELSE l_partkey END)::BIGINT AS s FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' GROUP BY 1)
SELECT block, CASE WHEN b.n IS NULL THEN 'vanished' ELSE 'changed' END AS status FROM a LEFT JOIN b USING (block) WHERE b.n IS NULL OR a.n <> b.n OR a.s <> b.s
""")
def fingerprint(t: Tables) -> DataFrame:
    """Blocks whose content has changed or vanished."""
    line = t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    block = F.trunc(F.col("l_shipdate").cast("date"), "month")
    new = line.filter(F.col("l_shipdate") >= F.lit("1996-01-01").cast("date")).withColumn("l_partkey", F.when(F.col("l_orderkey") % 1000 == 1, F.col("l_partkey") + 1).otherwise(F.col("l_partkey")))
    return I.changed_blocks(I.fingerprints(new, block), I.fingerprints(line, block))


@query("""
WITH l AS (SELECT *, max(ts::DATE) OVER (PARTITION BY user_id) AS last FROM events)
SELECT event_id, user_id, ts::DATE AS day FROM l WHERE ts::DATE = last AND ts::DATE > DATE '2024-01-05'
""")
def upsert(t: Tables) -> DataFrame:
    """What upserts of daily batches leave, past a cutoff."""
    e = t("events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    return I.replay(e, "user_id", "day", "day", "2024-01-05")


@query("SELECT window_start AS window, n AS rows, last_date FROM (SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS window_start, count(*) AS n, max(o_orderdate::DATE) AS last_date FROM orders GROUP BY 1) WHERE window_start >= '1999-06-01'")
def stale_windows(t: Tables) -> DataFrame:
    """Windows that a manifest lacks or has with other counts."""
    w = t("orders").groupBy(S.window_column("o_orderdate").alias("window")).agg(F.count("*").alias("rows"), F.max(F.to_date("o_orderdate")).alias("last_date"))
    return I.stale_windows(w, w.filter("window < '1999-06-01'"))


@query("SELECT max(ts::DATE) AS high_water FROM events")
def high_water(t: Tables) -> DataFrame:
    """The newest date."""
    return I.high_water(t("events"), "ts")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate::DATE > DATE '2000-06-01' AND o_orderkey % 3 > 0)")
def backfill(t: Tables) -> DataFrame:
    """What is newer than the target and hangs on rows that it lacks."""
    tables = {"orders": t("orders"), "lines": t("lineitem")}
    target = t("orders").filter("o_orderkey % 3 = 0")
    return I.backfill(tables, target, "orders", "o_orderkey", "o_orderdate", "2000-06-01", [("orders", "o_orderkey", "lines", "l_orderkey")])["lines"].select("l_orderkey", "l_linenumber")


# ---- fuzzy ------------------------------------------------------------------


@query("""
WITH q AS (SELECT split_part(c_name, '#', 1) AS query FROM customer UNION SELECT reverse(p_name) FROM part), m AS (SELECT DISTINCT p_name AS match FROM part),
s AS (SELECT query, match, 1.0::DOUBLE - levenshtein(lower(query), lower(match)) / greatest(length(query), length(match))::DOUBLE AS score FROM q, m)
SELECT query, arg_min(match, (-score, match)) AS match, round(max(score), 6) AS score FROM s WHERE score >= 0.5 GROUP BY query
""")
def fuzzy_names(t: Tables) -> DataFrame:
    """The nearest part name of each name, by 3-grams and edits."""
    out = fuzzy.fuzzy_join(t("customer").select(F.substring_index("c_name", "#", 1).alias("q")).unionByName(t("part").select(F.reverse("p_name").alias("q"))), t("part"), "q", "p_name", 0.5)
    return out.withColumn("score", r6("score"))


@query("SELECT l_orderkey, l_linenumber, upper(l_returnflag) || '!' AS shout, count(*) AS n FROM lineitem GROUP BY ALL")
def map_distinct(t: Tables) -> DataFrame:
    """a function evaluated once for each distinct value."""
    out = fuzzy.map_distinct(t("lineitem"), "l_returnflag", lambda c: F.concat(F.upper(c), F.lit("!")), "shout")
    return out.select("l_orderkey", "l_linenumber", "shout").repartition(shape.parts_of(t("lineitem")), "l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber", "shout").agg(F.count("*").alias("n"))
