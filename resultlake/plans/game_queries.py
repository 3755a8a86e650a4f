"""Queries of the game operators: tables of games are derived from the star schema, in SQL that both engines read.

Texts, pairs, boards and seats of a game are expressions over keys, so they grow with the
tables; each query applies the library's operator and has the SQL that gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.functions import columns as X
from resultlake.operators import joins, pick, sets, shape, windows
from resultlake.plans import ml, serve
from resultlake.plans import reports as R
from resultlake.plans.queries import FACTS, Tables, facts, query, r6


def derived(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def listed(columns: dict[str, str]) -> str:
    """The same columns in a SELECT."""
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


# ---- texts of results --------------------------------------------------------

TEXTS = {
    "contract": "CASE WHEN l_orderkey % 40 = 0 THEN 'pass' WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN 'junk' ELSE CAST(l_linenumber AS STRING) || CASE l_suppkey % 5 WHEN 0 THEN 'c' WHEN 1 THEN 'D' WHEN 2 THEN ' h' WHEN 3 THEN 'S' ELSE 'nt' END || CASE l_partkey % 4 WHEN 0 THEN 'x' WHEN 1 THEN ' XX' ELSE '' END END",
    "declarer": "CASE l_partkey % 5 WHEN 0 THEN 'n' WHEN 1 THEN 'E' WHEN 2 THEN 'S ' WHEN 3 THEN 'w' ELSE 'N' END",
    "lead": "CASE l_suppkey % 6 WHEN 0 THEN '10h' WHEN 1 THEN 'hT' WHEN 2 THEN 's 10' WHEN 3 THEN 'AC' WHEN 4 THEN '1X' ELSE NULL END",
    "result": "CASE l_partkey % 7 WHEN 0 THEN '=' WHEN 1 THEN '+1' WHEN 2 THEN '-2' WHEN 3 THEN '127' WHEN 4 THEN NULL WHEN 5 THEN '' ELSE '3' END",
    "tricks": "CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE CAST(l_partkey % 15 AS STRING) END",
}
READ = r"""
x AS (SELECT *, replace(upper(regexp_replace(contract, '\s+', '', 'g')), 'NT', 'N') AS p, replace(upper(regexp_replace(lead, '\s+', '', 'g')), '10', 'T') AS card,
      CASE WHEN result = '=' THEN 0 ELSE try_cast(nullif(result, '') AS INT) END AS r0, try_cast(nullif(tricks, '') AS INT) AS t0 FROM texts),
y AS (SELECT *, coalesce(try_cast(nullif(regexp_extract(coalesce(p, ''), '^([1-7])([CDHSN])(X{0,2})$', 1), '') AS INT), 0) AS level,
      CASE WHEN regexp_matches(card, '^[2-9TJQKA][CDHS]$') THEN card[2] || card[1] ELSE card END AS turned,
      coalesce(r0 NOT BETWEEN -13 AND 6, false) OR coalesce(t0 NOT BETWEEN 0 AND 13, false) AS wrong FROM x),
z AS (SELECT *, CASE WHEN NOT wrong THEN r0 END AS r, CASE WHEN NOT wrong THEN t0 END AS t FROM y)"""
CONTRACT_SQL = "CASE WHEN p = 'PASS' THEN 'PASS' WHEN regexp_matches(p, '^([1-7])([CDHSN])(X{0,2})$') THEN p || upper(trim(declarer)) END"
LEAD_SQL = "CASE WHEN regexp_matches(turned, '^[CDHS][2-9TJQKA]$') THEN turned END"
RESULT_SQL = "CASE WHEN level = 0 OR r IS NULL OR t IS NULL OR t = level + 6 + r OR t + 6 = level + 6 + r THEN r END"
TRICKS_SQL = "CASE WHEN level = 0 OR r IS NULL OR t IS NULL OR t = level + 6 + r THEN t WHEN t + 6 = level + 6 + r THEN t + 6 END"


@query(f"""
WITH texts AS (SELECT {listed(TEXTS)} FROM lineitem), {READ}
SELECT {CONTRACT_SQL} AS contract, ({CONTRACT_SQL})[1:2] AS class, {LEAD_SQL} AS lead, {RESULT_SQL} AS result, {TRICKS_SQL} AS tricks, count(*) AS n FROM z GROUP BY ALL
""")
def contract_texts(t: Tables) -> DataFrame:
    """Contracts, leads, results and tricks from their texts."""
    df = derived(t("lineitem"), TEXTS)
    res, tri = X.typed_result("result", "tricks")
    df = df.withColumns({"r": res, "tr": tri, "lv": X.contract_level("contract")})
    res, tri = X.total_tricks("lv", "r", "tr")
    out = df.select(X.normalize_contract("contract", "declarer").alias("contract"), X.clean_lead("lead").alias("lead"), res.alias("result"), tri.alias("tricks"))
    return out.withColumn("class", X.level_strain("contract")).groupBy("contract", "class", "lead", "result", "tricks").agg(F.count("*").alias("n"))


@query(f"""
WITH texts AS (SELECT {listed(TEXTS)}, l_orderkey, l_linenumber, l_quantity, l_shipdate, l_suppkey FROM lineitem), {READ}
SELECT l_orderkey % 97 AS session_id, l_linenumber AS board_number, {CONTRACT_SQL} AS contract, level AS bid, {LEAD_SQL} AS lead, CAST(l_shipdate AS DATE) AS day, count(*) AS n, sum({RESULT_SQL}) AS results, sum({TRICKS_SQL}) AS tricks
FROM z WHERE l_suppkey % 10 > 0 AND l_quantity >= 3 GROUP BY ALL
""")
def standardized_results(t: Tables) -> DataFrame:
    """Results in one form; without a session, or with scores below nothing, they go."""
    rows = t("lineitem").selectExpr("*", *[f"{e} AS {n}" for n, e in TEXTS.items()])
    rows = rows.selectExpr("contract", "declarer", "lead AS opening_lead", "result", "tricks AS tricks_taken", "date_format(l_shipdate, 'M/d/yyyy') AS game_date", "CASE WHEN l_suppkey % 10 > 0 THEN l_orderkey % 97 END AS session_id", "l_linenumber AS board_number", "l_quantity - 3 AS ns_match_points", "CAST(50 AS DOUBLE) AS ew_match_points")
    out = R.standardize_results(rows)
    return out.groupBy("session_id", "board_number", F.col("Contract").alias("contract"), F.col("BidLvl").alias("bid"), F.col("Opening_Lead").alias("lead"), F.col("Date").alias("day")).agg(F.count("*").alias("n"), F.sum("Result").alias("results"), F.sum("Tricks").alias("tricks"))


NAMES = {
    "name": "CASE WHEN c_custkey % 3 = 0 THEN c_name || ' (swap names) ' ELSE c_name END",
    "ids": "CASE c_custkey % 4 WHEN 0 THEN '[' || CAST(c_custkey AS STRING) || ', 000]' WHEN 1 THEN '[\"#' || CAST(c_custkey AS STRING) || '\"]' WHEN 2 THEN '[\"Al Ober\"]' ELSE NULL END",
    "people": "CASE c_custkey % 3 WHEN 0 THEN '[\"Al B\", \"Cy\"]' WHEN 1 THEN '[]' ELSE 'Di' END",
    "flag": "CASE c_custkey % 5 WHEN 0 THEN ' TRUE' WHEN 1 THEN '0' WHEN 2 THEN 'f' WHEN 3 THEN 'yes' ELSE '1' END",
}


@query(f"""
WITH n AS (SELECT c_custkey, {listed(NAMES)} FROM customer)
SELECT c_custkey, regexp_replace(name, '\\s*\\(swap names\\)\\s*$', '') AS name,
       CASE WHEN c_custkey = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN CAST(c_custkey AS STRING) WHEN c_custkey % 4 = 1 THEN '#' || CAST(c_custkey AS STRING) END AS first, CAST(NULL AS STRING) AS second,
       CASE c_custkey % 3 WHEN 0 THEN 'Al B|Cy' WHEN 1 THEN '' ELSE 'Di' END AS people,
       CASE c_custkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 4 THEN true END AS flag FROM n
""")
def text_lists(t: Tables) -> DataFrame:
    """Names, lists of ids and names, and flags from texts."""
    df = t("customer").selectExpr("c_custkey", *[f"{e} AS {n}" for n, e in NAMES.items()])
    ids = X.pad2(X.id_list("ids"))
    return df.select("c_custkey", X.strip_suffix("name").alias("name"), X.at(ids, 0).alias("first"), X.at(ids, 1).alias("second"), F.array_join(X.name_list("people"), "|").alias("people"), X.text_bool("flag").alias("flag"))


PAR = "CASE p_size % 5 WHEN 0 THEN 'Par: 0' WHEN 1 THEN 'Par: +140 3H-NS/3S-NS' WHEN 2 THEN 'Par: -100 5S*-NS-1/4H-EW' WHEN 3 THEN 'Par: ?90 1NT-SW' ELSE 'Par: +' || CAST(p_size AS STRING) || ' 1NT-NS/2NT-N' END"


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 0 WHEN 1 THEN 140 WHEN 2 THEN -100 WHEN 4 THEN p_size END AS score, CASE p_size % 5 WHEN 0 THEN 1 WHEN 3 THEN NULL ELSE 2 END AS contracts,
       CASE p_size % 5 WHEN 1 THEN 'H|S' WHEN 2 THEN 'S' WHEN 4 THEN 'N' WHEN 0 THEN '' END AS ns, CASE p_size % 5 WHEN 2 THEN 'H' WHEN 3 THEN NULL ELSE '' END AS ew,
       CASE p_size % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 0 ELSE 1 END AS strains FROM part
""")
def par_texts(t: Tables) -> DataFrame:
    """Par contracts, each side's strains, and how many strains there are."""
    df = t("part").selectExpr("p_partkey", f"{PAR} AS par").withColumn("p", X.parse_par("par"))
    c = F.col("p.contracts")
    side = lambda s: F.array_join(X.par_side("p.contracts", s), "|")
    return df.select("p_partkey", F.col("p.score").alias("score"), F.when(c.isNotNull(), F.size(c)).alias("contracts"), side(1).alias("ns"), side(-1).alias("ew"), X.n_distinct_field("p.contracts", "Strain").alias("strains"))


# ---- deals ---------------------------------------------------------------------

# card i of 52 lies at the place i * a modulo 53, for a multiplier a of the key: a permutation
DEALT = """
dealt AS (SELECT s_suppkey, i, ((i * (s_suppkey % 52 + 1)) % 53 - 1) // 13 AS seat, (i - 1) // 13 AS suit, (i - 1) % 13 AS r FROM supplier, range(1, 53) t(i)),
places AS (SELECT s_suppkey, seat, suit FROM supplier, range(4) a(seat), range(4) b(suit)),
suits AS (SELECT p.s_suppkey, p.seat, p.suit, coalesce(string_agg(substr('AKQJT98765432', r + 1, 1), '' ORDER BY r), '') AS cards, coalesce(sum(CASE WHEN r < 4 THEN 4 - r ELSE 0 END), 0) AS points
          FROM places p LEFT JOIN dealt d ON p.s_suppkey = d.s_suppkey AND p.seat = d.seat AND p.suit = d.suit GROUP BY ALL),
hands AS (SELECT s_suppkey, seat, string_agg(cards, '.' ORDER BY suit) AS hand, sum(points) AS points, string_agg(CAST(length(cards) AS STRING), '-' ORDER BY length(cards) DESC) AS shape FROM suits GROUP BY ALL)"""


def dealt(t: Tables) -> DataFrame:
    """A deal of each supplier as 16 suits of cards in no order."""
    cards = t("supplier").select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(52))).alias("i"))
    seat = F.floor(((F.col("i") * (F.col("s_suppkey") % 52 + 1)) % 53 - 1) / 13)
    suit, rank = F.floor((F.col("i") - 1) / 13), (F.col("i") - 1) % 13
    card = F.substring(F.lit(X.RANKS), (rank + 1).cast("int"), F.lit(1))
    own = [F.concat_ws("", F.collect_list(F.when((seat == a) & (suit == b), F.when(card == "T", "10").otherwise(card)))).alias(f"{x}{y}") for a, x in enumerate("NESW") for b, y in enumerate("SHDC")]
    return cards.groupBy("s_suppkey").agg(*own)


@query(f"""
WITH {DEALT}
SELECT s_suppkey, true AS valid, 'N:' || string_agg(hand, ' ' ORDER BY seat) AS hands, sum(CASE WHEN seat % 2 = 0 THEN points ELSE 0 END) AS hcp_ns, sum(CASE WHEN seat = 3 THEN points ELSE 0 END) AS hcp_w,
       max(CASE WHEN seat = 1 THEN shape END) AS shape_e, max(CASE WHEN seat = 2 THEN shape END) IN ('4-3-3-3', '4-4-3-2', '5-3-3-2') AS balanced_s FROM hands GROUP BY s_suppkey
""")
def deal_hands(t: Tables) -> DataFrame:
    """Deals from suit columns, their canonical hands and their features."""
    df = dealt(t)
    df = df.withColumn("deal", X.build_deal({f"{x}{y}": f"{x}{y}" for x in "NESW" for y in "SHDC"}))
    df = R.deal_features(df.withColumn("hands", X.canonical_deal("deal")))
    return df.select("s_suppkey", X.valid_deal("deal").alias("valid"), "hands", F.col("HCP_NS").alias("hcp_ns"), F.col("HCP_W").alias("hcp_w"), F.col("Shape_E").alias("shape_e"), F.col("Balanced_S").alias("balanced_s"))


@query(f"""
WITH {DEALT}, whole AS (SELECT s_suppkey, 'N:' || string_agg(hand, ' ' ORDER BY seat) AS hands FROM hands GROUP BY s_suppkey)
SELECT s_suppkey % 50 AS hand_record_id, s_suppkey % 36 + 1 AS board, hands, ((s_suppkey % 36) // 4 + (s_suppkey % 36) % 4) % 4 AS vul FROM whole
WHERE s_suppkey % 7 > 0 AND (s_suppkey % 50, s_suppkey % 36 + 1) NOT IN (SELECT s_suppkey % 50, s_suppkey % 36 + 1 FROM whole WHERE s_suppkey % 7 > 0 GROUP BY ALL HAVING count(DISTINCT hands) > 1)
""")
def cleaned_deals(t: Tables) -> DataFrame:
    """Valid deals with vulnerability; a board with two deals, or without solved tricks, goes."""
    df = dealt(t).withColumn("board_record_string", X.build_deal({f"{x}{y}": f"{x}{y}" for x in "NESW" for y in "SHDC"}))
    rows = df.selectExpr("s_suppkey % 50 AS hand_record_id", "CAST(s_suppkey % 36 + 1 AS INT) AS board", "board_record_string", "'NS: 3S 4H D2 1C NT' AS double_dummy_ns", "CASE WHEN s_suppkey % 7 > 0 THEN 'EW: S1 H2 D C NT3' ELSE 'EW: S1 H2' END AS double_dummy_ew", "'Par: 0' AS par")
    return R.clean_deals(rows).select("hand_record_id", "board", "hands", "vul")


# ---- limits and dates ------------------------------------------------------------

LIMIT = "CASE o_custkey % 6 WHEN 0 THEN '0-299' WHEN 1 THEN '<500' WHEN 2 THEN 'NLM 1k' WHEN 3 THEN 'Open' WHEN 4 THEN '2,500 MP' END"


@query("""
SELECT CASE o_custkey % 6 WHEN 0 THEN '0-299' WHEN 1 THEN '0-499' WHEN 2 THEN '0-999' WHEN 4 THEN '0-2499' ELSE 'open' END AS stratum, count(*) AS n, count(DISTINCT o_custkey) AS sessions FROM orders GROUP BY ALL
""")
def session_strata(t: Tables) -> DataFrame:
    """Limits read once for each session and joined back."""
    return R.strata(t("orders").selectExpr("o_custkey", f"{LIMIT} AS mp_limit"), "o_custkey", "mp_limit").groupBy("stratum").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("sessions"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 2 THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_orderkey % 4 = 3 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS stamp FROM orders
WHERE o_orderkey % 4 = 2 OR CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'
""")
def date_texts(t: Tables) -> DataFrame:
    """Dates of several formats within a range, unknown ones kept."""
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.date_format(day, "yyyy-MM-dd")).when(F.col("o_orderkey") % 4 == 1, F.date_format(day, "M/d/yyyy")).when(F.col("o_orderkey") % 4 == 2, "soon").otherwise(F.date_format(day, "yyyy-MM-dd 00:00:00"))
    df = t("orders").select("o_orderkey", text.alias("d")).filter(X.in_range_or_unknown("d", "1997-01-01", "1999-12-31"))
    return df.select("o_orderkey", X.parse_date_any("d").alias("day"), X.parse_ts("d").alias("stamp"))


# ---- shape ---------------------------------------------------------------------


@query("SELECT c_custkey AS id, c_name, c_acctbal, 0 AS points, false AS ok, CAST(NULL AS STRING) AS note, 'web' AS origin FROM customer")
def typed_columns(t: Tables) -> DataFrame:
    """A table read as text, typed, renamed, aligned to a schema."""
    df = shape.restore_types(shape.as_text(t("customer")), ["c_custkey", "c_nationkey"], ["c_acctbal"])
    df = shape.drop_text(shape.rename_existing(df, {"c_custkey": "id", "absent": "x"}), ["c_.*"], ["c_name"])
    schema = T.StructType.fromDDL("id long, c_name string, c_acctbal double, points int, ok boolean, note string")
    return shape.ensure_column(shape.ensure_column(shape.align_schema(df, schema), "note", "n", "string"), "origin", "web", "string")


@query("SELECT l_suppkey, count(*) AS n, max(l_shipdate) AS newest FROM lineitem GROUP BY l_suppkey")
def matching_columns(t: Tables) -> DataFrame:
    """Columns by patterns; the scan reads two."""
    df = shape.drop_matching(shape.select_matching(t("lineitem"), ["l_.*key", "l_ship"]), ["l_partkey", "l_order"])
    return df.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.max("l_shipdate").alias("newest"))


@query("SELECT vec_id, label FROM embeddings")
def flat_columns(t: Tables) -> DataFrame:
    """A table without its nested columns."""
    return shape.drop_types(t("embeddings"))


@query("SELECT p_partkey, round(CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE), 2) AS price FROM part")
def narrow_floats(t: Tables) -> DataFrame:
    """Doubles as floats."""
    return shape.downcast_floats(t("part")).select("p_partkey", F.round(F.col("p_retailprice").cast("double"), 2).alias("price"))


EVENTS = {"event_id": "event_id", "kind": "CASE WHEN event_id % 4 > 0 THEN event_type END", "value": "CASE WHEN event_id % 5 > 0 THEN value END", "raw": "CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(event_id AS STRING) END", "typed": "-event_id", "value_ew": "user_id", "user_id": "user_id"}


@query(f"""
WITH e AS (SELECT {listed(EVENTS)} FROM events)
SELECT event_id, kind, value AS value_ns, coalesce(try_cast(raw AS BIGINT), typed) AS typed, value_ew FROM e
WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND (kind IN ('click', 'view', 'purchase') OR kind IS NULL) AND (value BETWEEN 5 AND 60 OR value IS NULL) AND (event_id % 2 = 0 OR user_id % 2 = 0) AND event_id % 11 > 0 AND user_id % 11 > 0
""")
def filtered_rows(t: Tables) -> DataFrame:
    """Filters that keep nulls, twins of raw and typed values, names of sides."""
    df = shape.require(derived(t("events"), EVENTS), ["event_id", "user_id"])
    df = shape.keep_between(shape.keep_in(df, "kind", ["click", "view", "purchase"], nulls=True), "value", 5, 60, nulls=True)
    df = df.filter(shape.any_of([F.col(c) % 2 == 0 for c in ("event_id", "user_id")]) & shape.all_of([F.col(c) % 11 > 0 for c in ("event_id", "user_id")]))
    return shape.suffix_pairs(shape.prefer_raw(df, [("raw", "typed")])).drop("user_id")


@query("""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) = 1 AS is_first FROM lineitem)
SELECT l_orderkey, l_suppkey, round((l_quantity - 25) / 10, 6) AS scaled, round((l_quantity + l_linenumber) / 2, 6) AS mean, round(abs(l_quantity - l_linenumber) / 2, 6) AS spread, s_name AS supplier_s_name, p_brand AS p_brand_part
FROM f LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey AND l_linenumber = p_size WHERE is_first
""")
def row_functions(t: Tables) -> DataFrame:
    """Scaled values, statistics across columns, first rows of a key, lookups by prefix and by role."""
    line = t("lineitem").withColumn("is_first", windows.first_of(["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])).filter("is_first")
    mean, std = X.row_mean_std(["l_quantity", "l_linenumber"])
    line = line.withColumns({"scaled": r6(X.scaled("l_quantity", 25.0, 10.0)), "mean": r6(mean), "spread": r6(std)})
    line = joins.join_lookup(line, t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey", "supplier_")
    out = joins.join_role(line, t("part").select("p_partkey", "p_size", "p_brand"), {"l_partkey": "p_partkey", "l_linenumber": "p_size"}, "part")
    return out.select("l_orderkey", "l_suppkey", "scaled", "mean", "spread", "supplier_s_name", "p_brand_part")


@query("""
SELECT (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_rows, true AS same, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS same_distinct FROM lineitem
""")
def row_sets(t: Tables) -> DataFrame:
    """Distinct rows, and whether two tables have the same rows as often."""
    line = t("lineitem").select("l_orderkey", "l_linenumber")
    once = sets.distinct_rows(line)
    return once.agg(F.count("*").alias("distinct_rows")).withColumns({"same": F.lit(sets.same_rows(line, line.select("l_linenumber", "l_orderkey"))), "same_distinct": F.lit(sets.same_rows(line, once))})


@query("""
WITH o AS (SELECT n_regionkey, n_nationkey, n_name, row_number() OVER (ORDER BY n_regionkey, n_nationkey, n_name) AS place FROM nation)
SELECT n_regionkey, n_nationkey, place, place AS in_block, CASE WHEN n_nationkey >= 20 THEN 1 ELSE 0 END AS newest FROM o
""")
def sorted_rows(t: Tables) -> DataFrame:
    """Orders of a table, told by the place of each row; a seeded shuffle keeps its newest rows last."""
    nation = t("nation").select("n_regionkey", "n_nationkey", "n_name")
    placed = lambda df, name: df.coalesce(1).withColumn(name, F.monotonically_increasing_id() + 1)
    whole = placed(pick.total_sort(nation, ["n_regionkey"]), "place")
    block = placed(pick.sort_in_blocks(nation, "n_regionkey", ["n_nationkey", "absent"]), "in_block").select("n_nationkey", "in_block")
    tail = placed(pick.shuffle_keep_tail(nation, ["n_nationkey"], F.col("n_nationkey") >= 20, 5), "at").select("n_nationkey", (F.col("at") > 20).cast("int").alias("newest"))
    return whole.join(block, "n_nationkey").join(tail, "n_nationkey").select("n_regionkey", "n_nationkey", "place", "in_block", "newest")


# ---- contracts -------------------------------------------------------------------

BIDS = {"level": "l_linenumber", "strain": "CASE l_suppkey % 5 WHEN 0 THEN 'C' WHEN 1 THEN 'D' WHEN 2 THEN 'H' WHEN 3 THEN 'S' ELSE 'N' END", "doubled": "CASE l_partkey % 3 WHEN 0 THEN 'X' WHEN 1 THEN 'XX' ELSE '' END", "vul": "l_orderkey % 2 = 0", "tricks": "l_partkey % 14"}
SCORE_SQL = """
a AS (SELECT *, CASE doubled WHEN 'X' THEN 2 WHEN 'XX' THEN 4 ELSE 1 END AS f, tricks - level - 6 AS o, CASE WHEN strain IN ('C', 'D') THEN 20 ELSE 30 END AS per FROM bids),
b AS (SELECT *, (per * level + CASE WHEN strain = 'N' THEN 10 ELSE 0 END) * f AS odd FROM a),
scored AS (SELECT *, CASE WHEN o >= 0 THEN odd + CASE WHEN odd < 100 THEN 50 WHEN vul THEN 500 ELSE 300 END + CASE level WHEN 6 THEN CASE WHEN vul THEN 750 ELSE 500 END WHEN 7 THEN CASE WHEN vul THEN 1500 ELSE 1000 END ELSE 0 END
      + CASE f WHEN 1 THEN 0 ELSE 25 * f END + o * CASE WHEN f = 1 THEN per ELSE f * CASE WHEN vul THEN 100 ELSE 50 END END
      WHEN f = 1 THEN o * CASE WHEN vul THEN 100 ELSE 50 END
      ELSE -(f // 2) * CASE WHEN vul THEN -300 * o - 100 WHEN o = -1 THEN 100 WHEN o = -2 THEN 300 ELSE -300 * o - 400 END END AS score FROM b)"""


@query(f"WITH bids AS (SELECT {listed(BIDS)} FROM lineitem), {SCORE_SQL} SELECT level, strain, doubled, vul, tricks, score, count(*) AS n FROM scored GROUP BY ALL")
def contract_scores(t: Tables) -> DataFrame:
    """Scores of contracts."""
    df = derived(t("lineitem"), BIDS)
    return df.withColumn("score", R.contract_score("level", "strain", "doubled", "vul", "tricks")).groupBy("level", "strain", "doubled", "vul", "tricks", "score").agg(F.count("*").alias("n"))


PROBS = {"k": "l_suppkey % 20", "strain": BIDS["strain"], "vul": "l_suppkey % 2 = 0", "tricks": "l_partkey % 14"}


@query(f"""
WITH bids AS (SELECT level, strain, '' AS doubled, vul, tricks FROM range(1, 8) a(level), (VALUES ('C'), ('D'), ('H'), ('S'), ('N')) b(strain), (VALUES (true), (false)) c(vul), range(14) d(tricks)), {SCORE_SQL},
raw AS (SELECT {listed(PROBS)} FROM lineitem), whole AS (SELECT k, strain, count(*) AS total FROM raw GROUP BY ALL),
probs AS (SELECT k, strain, vul, tricks, CAST(count(*) AS DOUBLE) / any_value(total) AS p FROM raw JOIN whole USING (k, strain) GROUP BY ALL),
ev AS (SELECT k, level, strain, round(sum(p * score), 6) AS ev FROM probs JOIN scored USING (strain, vul, tricks) GROUP BY ALL)
SELECT k, max(ev) AS ev_max, arg_max(level || strain, ev) AS best FROM ev GROUP BY k
""")
def expected_scores(t: Tables) -> DataFrame:
    """The contract of the greatest expected score for each key."""
    raw = derived(t("lineitem"), PROBS)
    total = raw.groupBy("k", "strain").agg(F.count("*").alias("total"))
    probs = raw.groupBy("k", "strain", "vul", "tricks").agg(F.count("*").alias("n")).join(total, ["k", "strain"]).withColumn("p", F.col("n") / F.col("total"))
    return R.expected_values(probs, ["k"], R.score_table(raw.sparkSession)).withColumn("ev_max", r6("ev_max"))


SEATS = {"session_id": "o_orderkey % 97", "Date": "CAST(o_orderdate AS DATE)", "Board": "l_linenumber", "section_id": "l_suppkey % 3", "Player_ID_N": "CAST(l_suppkey % 30 AS STRING)", "Player_ID_E": "CAST(l_partkey % 30 AS STRING)", "Player_ID_S": "CASE WHEN o_custkey % 9 > 0 THEN CAST(o_custkey % 30 AS STRING) END", "Player_ID_W": "CAST((l_suppkey + l_partkey) % 30 AS STRING)", "Pair_Number_NS": "l_suppkey % 30", "Pair_Number_EW": "l_partkey % 30", "Declarer": "CASE l_orderkey % 5 WHEN 0 THEN 'N' WHEN 1 THEN 'E' WHEN 2 THEN 'S' WHEN 3 THEN 'W' ELSE '' END", "Pct_NS": "l_discount", "vul": "l_orderkey % 4"}
GAMES = f"{FACTS}, games AS (SELECT {listed(SEATS)} FROM facts)"


def games(t: Tables) -> DataFrame:
    """Result rows with four seats."""
    return derived(facts(t), SEATS)


@query(f"""
WITH {GAMES}
SELECT CASE Declarer WHEN 'N' THEN Player_ID_N WHEN 'E' THEN Player_ID_E WHEN 'S' THEN Player_ID_S WHEN 'W' THEN Player_ID_W END AS declarer_id, CASE Declarer WHEN 'N' THEN Player_ID_E WHEN 'E' THEN Player_ID_S WHEN 'S' THEN Player_ID_W WHEN 'W' THEN Player_ID_N END AS leader_id,
       CASE WHEN Declarer IN ('N', 'S') THEN 'NS' WHEN Declarer IN ('E', 'W') THEN 'EW' END AS side, CASE WHEN Declarer IN ('N', 'S') THEN vul IN (1, 3) WHEN Declarer IN ('E', 'W') THEN vul IN (2, 3) END AS vulnerable,
       count(*) AS n, round(sum(CASE WHEN Declarer IN ('N', 'S') THEN Pct_NS WHEN Declarer IN ('E', 'W') THEN 1 - Pct_NS END), 4) AS pct FROM games GROUP BY ALL
""")
def declarers(t: Tables) -> DataFrame:
    """Results from the declarer's side."""
    d = R.declarer_roles(games(t))
    return d.groupBy(F.col("Declarer_ID").alias("declarer_id"), F.col("OnLead_ID").alias("leader_id"), F.col("Declarer_Pair_Direction").alias("side"), F.col("Vul_Declarer").alias("vulnerable")).agg(F.count("*").alias("n"), F.round(F.sum("Pct_Declarer"), 4).alias("pct"))


@query("""
WITH o AS (SELECT l_partkey % 14 AS tricks, l_suppkey % 14 AS dd, l_orderkey % 700 - 350 AS score, l_partkey % 500 - 250 AS par, CASE l_suppkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'H' ELSE 'N' END AS strain FROM lineitem)
SELECT tricks - dd AS diff, score >= par AS worth, strain IN ('S', 'N') AS in_par, score >= par AND score < 0 AS sacrifice, count(*) AS n FROM o GROUP BY ALL
""")
def outcomes(t: Tables) -> DataFrame:
    """Tricks against double dummy, and contracts against par."""
    df = t("lineitem").selectExpr("l_partkey % 14 AS Tricks", "l_suppkey % 14 AS DD_Tricks", "l_orderkey % 700 - 350 AS DD_Score_Declarer", "l_partkey % 500 - 250 AS Par_Declarer", "CASE l_suppkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'H' ELSE 'N' END AS BidSuit", "array(named_struct('Strain', 'S'), named_struct('Strain', 'N')) AS par_contracts")
    return R.outcome_flags(df).groupBy(F.col("DD_Tricks_Diff").alias("diff"), F.col("Is_Par_Contract").alias("worth"), F.col("Is_Par_Strain").alias("in_par"), F.col("Is_Sacrifice").alias("sacrifice")).agg(F.count("*").alias("n"))


# ---- histories and features --------------------------------------------------------


@query(f"""
WITH {GAMES}, seats AS (SELECT session_id, Date, Player_ID_N AS p FROM games UNION ALL SELECT session_id, Date, Player_ID_E FROM games UNION ALL SELECT session_id, Date, Player_ID_S FROM games UNION ALL SELECT session_id, Date, Player_ID_W FROM games),
one AS (SELECT p, session_id, min(Date) AS Date FROM seats WHERE p IS NOT NULL GROUP BY ALL)
SELECT p AS player_id, session_id, Date AS day, row_number() OVER (PARTITION BY p ORDER BY Date, session_id) - 1 AS nth FROM one
""")
def player_histories(t: Tables) -> DataFrame:
    """A row for each player and session, numbered in date order."""
    return R.player_history(games(t), columns=("Player_ID",)).select(F.col("Player_ID").alias("player_id"), "session_id", F.col("Date").alias("day"), F.col("Elo_N").alias("nth"))


@query(f"""
WITH {GAMES}, pairs AS (SELECT session_id, Date, 'EW' AS role, Player_ID_E AS a, Player_ID_W AS b FROM games UNION ALL SELECT session_id, Date, 'NS', Player_ID_N, Player_ID_S FROM games),
keyed AS (SELECT session_id, Date, least(a, b) || '-' || greatest(a, b) AS pair FROM pairs WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b), one AS (SELECT pair, session_id, min(Date) AS Date FROM keyed GROUP BY ALL)
SELECT pair, session_id, Date AS day, row_number() OVER (PARTITION BY pair ORDER BY Date, session_id) - 1 AS nth FROM one
""")
def pair_histories(t: Tables) -> DataFrame:
    """A row for each pair and session."""
    return R.pair_history(games(t)).select(F.col("Pair_IDs").alias("pair"), "session_id", F.col("Date").alias("day"), F.col("Elo_N").alias("nth"))


SKILLS = {f"{a}_{s}": e for s, x in zip("NESW", ("l_suppkey", "l_partkey", "l_orderkey", "o_custkey")) for a, e in (("Elo", f"CASE WHEN {x} % 7 > 0 THEN CAST({x} % 100 AS DOUBLE) END"), ("MasterPoints", f"CAST({x} % 50 AS DOUBLE)"))}


@query(f"""
WITH {FACTS}, s AS (SELECT l_orderkey, {listed(SKILLS)} FROM facts),
d AS (SELECT l_orderkey, (coalesce(Elo_N, 0) + coalesce(Elo_S, 0)) / 2 - (coalesce(Elo_E, 0) + coalesce(Elo_W, 0)) / 2 AS e, (ln(1 + MasterPoints_N) + ln(1 + MasterPoints_S)) / 2 - (ln(1 + MasterPoints_E) + ln(1 + MasterPoints_W)) / 2 AS m FROM s)
SELECT l_orderkey, count(*) AS n, round(sum(e), 4) AS elo_diff, round(sum(m), 4) AS log_mp_diff, round(sum(e * m), 3) AS elo_x_mp FROM d GROUP BY ALL
""")
def skill_sums(t: Tables) -> DataFrame:
    """Differences of the sides' skills and points."""
    df = R.skill_features(facts(t).selectExpr("l_orderkey", *[f"{e} AS {n}" for n, e in SKILLS.items()]))
    return df.groupBy("l_orderkey").agg(F.count("*").alias("n"), r6(F.sum("elo_diff"), 4).alias("elo_diff"), r6(F.sum("log_mp_diff"), 4).alias("log_mp_diff"), r6(F.sum("elo_x_mp"), 3).alias("elo_x_mp"))


@query("SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 2) AS quantity, round(sum(l_discount), 4) AS y FROM lineitem GROUP BY l_suppkey")
def target_frames(t: Tables) -> DataFrame:
    """The features of one target, without the other targets and what leaks it."""
    df = R.target_frame(t("lineitem"), "l_discount", ["l_discount", "l_tax"], {"l_discount": ["l_ext.*", "l_discount_.*"]})
    if {"l_tax", "l_extendedprice"} & set(df.columns):
        raise AssertionError(df.columns)
    return df.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_discount"), 4).alias("y"))


@query("""
WITH f AS (SELECT *, l_suppkey % 10 AS block FROM lineitem)
SELECT block, l_returnflag, count(*) AS n, count(s_name) AS found, round(avg(m), 6) AS rating FROM (SELECT f.*, s_name, avg(l_quantity) OVER (PARTITION BY l_partkey) AS m FROM f LEFT JOIN supplier ON f.l_suppkey = s_suppkey AND s_suppkey % 4 > 0) GROUP BY ALL
""")
def enriched(t: Tables) -> DataFrame:
    """Facts joined by block and key, with an entity's mean over all blocks."""
    line = t("lineitem").withColumn("block", F.col("l_suppkey") % 10)
    dim = t("supplier").filter("s_suppkey % 4 > 0").select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_suppkey") % 10).alias("block"), "s_name")
    out = R.enrich(line, dim, ["l_suppkey"], "block", ("l_partkey", "l_quantity", "rating"))
    return out.groupBy("block", "l_returnflag").agg(F.count("*").alias("n"), F.count("s_name").alias("found"), r6(F.avg("rating")).alias("rating"))


@query("""
WITH d AS (SELECT p_partkey % 500 AS k, p_brand, p_size, row_number() OVER (PARTITION BY p_partkey % 500 ORDER BY p_size, p_brand, p_name, p_type, p_retailprice, p_partkey) AS nth FROM part)
SELECT p_brand, count(*) AS n, round(sum(CAST(CAST(l_tax AS FLOAT) AS DOUBLE)), 3) AS tax FROM lineitem LEFT JOIN d ON l_partkey % 500 = k AND nth = 1 GROUP BY ALL
""")
def model_rows(t: Tables) -> DataFrame:
    """Facts with one deal for each key, projected, with floats."""
    line = t("lineitem").withColumn("k", F.col("l_partkey") % 500)
    deals = t("part").selectExpr("p_partkey % 500 AS k", "p_size", "p_brand", "p_name", "p_type", "p_retailprice", "p_partkey")
    out = R.model_table(line, deals, ["k"], ["k", "p_brand", "l_tax"], ["p_size", "p_brand", "p_name", "p_type", "p_retailprice", "p_partkey"])
    return out.groupBy("p_brand").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_tax").cast("double")), 3).alias("tax"))


@query(f"""
WITH {GAMES}, r AS (SELECT CAST(c_custkey % 30 AS STRING) AS Player_ID, c_custkey % 97 AS session_id, max(c_acctbal) AS rating FROM customer GROUP BY ALL),
k AS (SELECT least(Player_ID_N, Player_ID_S) || '-' || greatest(Player_ID_N, Player_ID_S) AS pair, session_id, max(vul) + 1 AS pair_rating FROM games WHERE Player_ID_N <> Player_ID_S AND vul < 3 GROUP BY ALL)
SELECT session_id, count(*) AS n, count(a.rating) AS known_n, round(sum(b.rating), 2) AS rating_w, count_if(Date < DATE '1998-01-01') AS train, count_if(Date >= DATE '1998-01-01') AS test, sum(c.pair_rating)::BIGINT AS pairs_ns, count(d.pair_rating) AS known_ew
FROM games LEFT JOIN r a USING (session_id) LEFT JOIN r b USING (session_id)
LEFT JOIN k c ON c.session_id = games.session_id AND Player_ID_N <> Player_ID_S AND c.pair = least(Player_ID_N, Player_ID_S) || '-' || greatest(Player_ID_N, Player_ID_S)
LEFT JOIN k d ON d.session_id = games.session_id AND Player_ID_E <> Player_ID_W AND d.pair = least(Player_ID_E, Player_ID_W) || '-' || greatest(Player_ID_E, Player_ID_W)
WHERE a.Player_ID = Player_ID_N AND b.Player_ID = Player_ID_W GROUP BY ALL
""")
def prediction_rows(t: Tables) -> DataFrame:
    """Model rows with ratings of seats and pairs, split by a cutoff."""
    players = t("customer").groupBy(F.expr("CAST(c_custkey % 30 AS STRING)").alias("Player_ID"), F.expr("c_custkey % 97").alias("session_id")).agg(F.max("c_acctbal").alias("rating"))
    own = games(t).filter("vul < 3").select(X.pair_key("Player_ID_N", "Player_ID_S").alias("Pair_IDs"), "session_id", "vul").dropna()
    pairs = own.groupBy("Pair_IDs", "session_id").agg((F.max("vul") + 1).alias("pair_rating"))
    out = R.prediction_table(games(t), players, pairs, "1998-01-01", [])
    out = out.filter("rating_N IS NOT NULL AND rating_W IS NOT NULL")
    return out.groupBy("session_id").agg(F.count("*").alias("n"), F.count("rating_N").alias("known_n"), F.round(F.sum("rating_W"), 2).alias("rating_w"), F.count_if("is_train").alias("train"), F.count_if("is_test").alias("test"), F.sum("pair_rating_NS").cast("long").alias("pairs_ns"), F.count("pair_rating_EW").alias("known_ew"))


# ---- questions -------------------------------------------------------------------

CLUBS = {"event_id": "o_orderkey", "club_id": "o_custkey % 40", "club_name": "o_orderpriority", "date": "CAST(o_orderdate AS DATE)"}


@query(f"WITH e AS (SELECT {listed(CLUBS)} FROM orders) SELECT club_id, arg_max(club_name, (date, event_id)) AS club_name, count(DISTINCT event_id) AS events FROM e GROUP BY club_id")
def clubs(t: Tables) -> DataFrame:
    """Clubs with their last name and number of events."""
    return serve.club_list(derived(t("orders"), CLUBS))


@query(f"""
WITH e AS (SELECT {listed(CLUBS)} FROM orders), c AS (SELECT club_id, arg_max(club_name, (date, event_id)) AS club_name, count(DISTINCT event_id) AS events FROM e GROUP BY club_id),
f AS (SELECT *, trim(regexp_replace(lower(club_name), '[^a-z0-9]+', ' ', 'g')) AS t, string_split(trim(regexp_replace(lower(club_name), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM c),
p AS (SELECT *, list_append(list_transform(range(1, greatest(len(w) - 1, 1) + 1), lambda i: array_to_string(w[i:i + 1], ' ')), t) AS parts FROM f),
s AS (SELECT club_id, club_name, events, list_max(list_transform(parts, lambda x: 1.0::DOUBLE - levenshtein(x, 'not specifed') / greatest(length(x), 12)::DOUBLE)) AS score FROM p)
SELECT club_id, club_name, events, round(score, 6) AS score FROM s WHERE score >= 0.55
""")
def clubs_named(t: Tables) -> DataFrame:
    """Clubs by a name that is nearly the one asked for."""
    return serve.club_list(derived(t("orders"), CLUBS), "Not specifed").withColumn("score", r6("score"))


@query(f"WITH e AS (SELECT {listed(CLUBS)} FROM orders) SELECT * FROM e WHERE club_id = 7 AND date BETWEEN DATE '1996-01-01' AND DATE '1999-06-30'")
def games_of_club(t: Tables) -> DataFrame:
    """Games of a club within dates."""
    return serve.club_games(derived(t("orders"), CLUBS), 7, "1996-01-01", "1999-06-30")


@query(f"""
WITH {GAMES}, s AS (SELECT session_id, avg(CASE WHEN Player_ID_N = '5' THEN Pct_NS WHEN Player_ID_E = '5' THEN 1 - Pct_NS WHEN Player_ID_S = '5' THEN Pct_NS ELSE 1 - Pct_NS END) AS score, count(*) AS n FROM games WHERE Player_ID_N = '5' OR Player_ID_E = '5' OR Player_ID_S = '5' OR Player_ID_W = '5' GROUP BY session_id),
d AS (SELECT session_id, max(Date) AS Date FROM games GROUP BY session_id)
SELECT session_id, round(score, 6) AS score, Date FROM s JOIN d USING (session_id) ORDER BY Date DESC, session_id DESC LIMIT 200
""")
def sessions_of_player(t: Tables) -> DataFrame:
    """A player's sessions with the mean score, the latest first."""
    out = serve.player_sessions(games(t), "5")
    return out.select("session_id", r6([c for c in out.columns if c not in ("session_id", "Date", "n", "boards")][0]).alias("score"), "Date")


@query("""
WITH a AS (SELECT s_suppkey AS player_id, s_name AS name, s_acctbal AS mp_total FROM supplier WHERE s_suppkey % 3 > 0), b AS (SELECT s_suppkey AS player_id, lower(s_name) AS name, CASE WHEN s_suppkey % 4 > 0 THEN s_acctbal * 2 END AS mp_total FROM supplier WHERE s_suppkey % 2 = 0)
SELECT player_id, coalesce(b.name, a.name) AS name, coalesce(b.mp_total, a.mp_total) AS mp_total FROM a FULL JOIN b USING (player_id)
""")
def listed_players(t: Tables) -> DataFrame:
    """Players with official values first."""
    s = t("supplier").selectExpr("s_suppkey AS player_id", "s_name AS name", "s_acctbal AS mp_total")
    official = s.filter("player_id % 2 = 0").selectExpr("player_id", "lower(name) AS name", "CASE WHEN player_id % 4 > 0 THEN mp_total * 2 END AS mp_total")
    return serve.player_listing(s.filter("player_id % 3 > 0"), official).select("player_id", "name", "mp_total")


@query(f"""
WITH {GAMES}, own AS (SELECT * FROM games WHERE session_id = 11)
SELECT section_id, 'NS' AS direction, Pair_Number_NS AS pair_number, round(avg(Pct_NS), 6) AS percentage, count(*) AS boards FROM own GROUP BY ALL UNION ALL SELECT section_id, 'EW', Pair_Number_EW, round(avg(1 - Pct_NS), 6), count(*) FROM own GROUP BY ALL
""")
def session_pairs(t: Tables) -> DataFrame:
    """The pairs of one session from the wide table."""
    return serve.session_views(games(t), 11)["pair_summaries"].withColumn("percentage", r6("percentage"))


NORMAL = {
    "events": "SELECT r_regionkey AS event_id, r_name AS event_name FROM region",
    "sessions": "SELECT n_nationkey AS session_id, n_regionkey AS event_id, n_name AS game_date FROM nation",
    "sections": "SELECT c_custkey AS section_id, c_nationkey AS session_id, c_mktsegment AS section_name FROM customer",
    "boards": "SELECT o_orderkey AS board_id, o_custkey AS section_id, o_orderkey % 36 + 1 AS board_number FROM orders",
    "board_results": "SELECT l_orderkey AS board_id, l_suppkey % 5 AS ns_pair, l_partkey % 5 AS ew_pair, l_quantity AS ns_match_points, CASE WHEN l_linenumber = 7 THEN -l_quantity ELSE 50 - l_quantity END AS ew_match_points FROM lineitem",
    "pair_summaries": "SELECT c_custkey * 10 + k AS pair_summary_id, c_custkey AS section_id, k % 5 AS pair_number, CASE WHEN k < 5 THEN 'NS' ELSE 'ew' END AS direction, c_acctbal AS percentage FROM customer, ks",
    "players": "SELECT p.pair_summary_id * 2 + m AS player_id, p.pair_summary_id, CASE WHEN (p.pair_summary_id * 2 + m) % 13 > 0 THEN CAST((p.pair_summary_id * 2 + m) % 1000 AS STRING) END AS player_number, 'P' || CAST(p.pair_summary_id % 17 AS STRING) || ' (swap names)' AS player_name FROM pair_summaries p, ms WHERE m = 0 OR p.pair_summary_id % 5 > 0",
}
NORMAL_SQL = "ks AS (SELECT k FROM range(10) t(k)), ms AS (SELECT m FROM range(2) t(m)), " + ", ".join(f"{n} AS ({s})" for n, s in NORMAL.items())


def normal(t: Tables) -> dict[str, DataFrame]:
    """The normalized tables of a game, by the column expressions of ``NORMAL``.

    Rows are multiplied by a join with numbers, as in the SQL: its estimated size is the product
    of both. An exploded array would leave the tables as small as customers in Spark's
    estimate, and they would be broadcast at any size. Customers, a small file, are dealt
    before they are multiplied, else one task would hold all that they become.
    """
    out = {}
    numbers = lambda n, name: t("customer").sparkSession.range(n).withColumnRenamed("id", name)
    for name, sql in NORMAL.items():
        head, source = sql.split(" FROM ", 1)
        if name == "pair_summaries":
            df = t("customer").repartition(shape.ranges(t("customer")), "c_custkey").crossJoin(numbers(10, "k"))
        elif name == "players":
            df = out["pair_summaries"].crossJoin(numbers(2, "m")).filter("m = 0 OR pair_summary_id % 5 > 0")
            head = head.replace("p.", "")
        else:
            df = t(source)
        out[name] = df.selectExpr(*_split(head.removeprefix("SELECT ")))
    return out


def _split(columns: str) -> list[str]:
    """The columns of a SELECT: commas inside brackets do not part them."""
    out, depth = [""], 0
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [c.strip() for c in out]


MEMBERS = "two AS (SELECT pair_summary_id, arg_min(player_name, player_id) AS name_1, arg_min({{'v': player_number}}, player_id).v AS number_1, CASE WHEN max(player_id) > min(player_id) THEN arg_max({{'v': player_number}}, player_id).v END AS number_2 FROM players {} GROUP BY ALL)"


@query(f"""
WITH {NORMAL_SQL}, {MEMBERS.format("WHERE player_number IS NOT NULL")}, pairs AS (SELECT section_id, pair_number, upper(direction) AS d, number_1, number_2, name_1 FROM pair_summaries LEFT JOIN two USING (pair_summary_id)),
f AS (SELECT r.*, b.board_number, e.event_name, n.number_1 AS a, n.name_1, w.number_2 AS b2, ns_match_points / nullif(ns_match_points + ew_match_points, 0) AS pct FROM board_results r LEFT JOIN boards b USING (board_id) LEFT JOIN sections c USING (section_id) LEFT JOIN sessions s USING (session_id) LEFT JOIN events e USING (event_id)
      LEFT JOIN pairs n ON n.d = 'NS' AND n.section_id = b.section_id AND n.pair_number = ns_pair LEFT JOIN pairs w ON w.d = 'EW' AND w.section_id = b.section_id AND w.pair_number = ew_pair)
SELECT event_name, board_number, count(*) AS n, count(a) AS known_ns, count(b2) AS second_ew, round(sum(pct), 4) AS pct, max(regexp_replace(name_1, '\\s*\\(swap names\\)\\s*$', '')) AS name FROM f GROUP BY ALL
""")
def cleaned_results(t: Tables) -> DataFrame:
    """Club results with their dimensions, both pairs' players and valid scores."""
    out = R.clean_results(normal(t))
    return out.groupBy("event_name", "board_number").agg(F.count("*").alias("n"), F.count("player_number_1_ns").alias("known_ns"), F.count("player_number_2_ew").alias("second_ew"), r6(F.sum("Pct_NS"), 4).alias("pct"), F.max("player_name_1_ns").alias("name"))


@query(f"WITH {NORMAL_SQL}, {MEMBERS.format('')} SELECT pair_summary_id, section_id, direction, percentage, number_1, number_2 FROM pair_summaries LEFT JOIN two USING (pair_summary_id)")
def pair_standings(t: Tables) -> DataFrame:
    """Pairs with both players."""
    return serve.standings(normal(t)).select("pair_summary_id", "section_id", "direction", "percentage", F.col("player_number_1").alias("number_1"), F.col("player_number_2").alias("number_2"))


@query(f"WITH {NORMAL_SQL} SELECT event_id, event_name, arg_min(session_id, (game_date, session_id)) AS session_id FROM players JOIN pair_summaries USING (pair_summary_id) JOIN sections USING (section_id) JOIN sessions USING (session_id) JOIN events USING (event_id) WHERE player_number = '42' GROUP BY ALL")
def events_of_player(t: Tables) -> DataFrame:
    """The events that a player took part in."""
    return serve.player_games(normal(t), "42").select("event_id", "event_name", "session_id")


@query(f"WITH {NORMAL_SQL}, s AS (SELECT section_id FROM sections WHERE session_id = 3) SELECT 'sections' AS name, count(*) AS n FROM s UNION ALL SELECT 'boards', count(*) FROM boards WHERE section_id IN (FROM s) UNION ALL SELECT 'players', count(*) FROM players WHERE pair_summary_id IN (SELECT pair_summary_id FROM pair_summaries WHERE section_id IN (FROM s)) UNION ALL SELECT 'events', 1")
def tables_of_session(t: Tables) -> DataFrame:
    """The tables of one session and their sizes."""
    own = serve.session_tables(normal(t), 3)
    return serve.inventory({n: own[n] for n in ("sections", "boards", "players", "events")}).select(F.col("table").alias("name"), F.col("rows").alias("n"))


@query("""
SELECT 'orders' AS name, true AS available, count(*) AS n, CAST(max(o_orderdate) AS DATE) AS newest FROM orders UNION ALL SELECT 'nation', true, count(*), NULL FROM nation
""")
def datasets(t: Tables) -> DataFrame:
    """Tables with their rows and newest date."""
    return serve.dataset_info({"orders": serve.table({"orders": t("orders")}, "orders", ["o_orderdate"]), "nation": t("nation")}, {"orders": "o_orderdate"}).withColumnsRenamed({"table": "name", "rows": "n"})


PEOPLE = {"player_number": "c_custkey % 300", "player_name": "c_name || ' ' || c_mktsegment", "club_id": "c_nationkey", "date": "c_custkey", "city": "c_mktsegment", "state": "c_nationkey"}


@query(f"""
WITH p AS (SELECT {listed(PEOPLE)} FROM customer WHERE c_nationkey = 4)
SELECT player_number, arg_max(player_name, (date, player_name, city, state)) AS player_name, arg_max(city, (date, player_name, city, state)) AS city FROM p WHERE contains(lower(player_name), 'customer') AND contains(lower(player_name), 'machinery') GROUP BY player_number
""")
def found_players(t: Tables) -> DataFrame:
    """Players of a club by all words of a name, with their latest attributes."""
    return serve.player_lookup(derived(t("customer"), PEOPLE), "machinery Customer", "4").select("player_number", "player_name", "city")


@query(f"""
WITH {GAMES}, me AS (SELECT 1 AS one, min(Board) AS b FROM games WHERE session_id = 11 AND '5' IN (Player_ID_N, Player_ID_E, Player_ID_S, Player_ID_W))
SELECT s_nationkey, count(*) AS n, round(avg(s_acctbal), 4) AS mean FROM supplier, me GROUP BY ALL ORDER BY n DESC, s_nationkey LIMIT 200
""")
def asked_in_sql(t: Tables) -> DataFrame:
    """SQL over one table named self, and over named tables."""
    one = serve.sql_self(t("supplier"), "s_nationkey, count(*) AS {count}, round(avg(s_acctbal), 4) AS mean GROUP BY s_nationkey ORDER BY n DESC, s_nationkey", {"count": "n"})
    return serve.sql_tables({"counts": one, "nations": t("nation")}, "SELECT counts.* FROM counts JOIN nations ON s_nationkey = n_nationkey")


@query(f"""
WITH {GAMES}, own AS (SELECT * FROM games WHERE session_id = 11), mine AS (SELECT *, CASE WHEN Player_ID_N = '5' THEN 'N' WHEN Player_ID_E = '5' THEN 'E' WHEN Player_ID_S = '5' THEN 'S' ELSE 'W' END AS seat FROM own WHERE '5' IN (Player_ID_N, Player_ID_E, Player_ID_S, Player_ID_W))
SELECT count(*) AS n, (SELECT count(*) > 0 FROM mine) AS played FROM own
""")
def personal_rows(t: Tables) -> DataFrame:
    """A session from one player's side."""
    rows = serve.personalize(serve.session_rows(games(t), 11), "5")
    shown, missing = serve.boards(rows, ["Board", "Boards_I_Played", "absent"], limit=2000)
    if missing != ["absent"]:
        raise AssertionError(missing)
    return rows.agg(F.count("*").alias("n"), (F.count_if("My_Section") > 0).alias("played"))


# ---- models ----------------------------------------------------------------------


@query("""
WITH l AS (SELECT 'l_quantity' AS name, CASE WHEN l_linenumber < 7 THEN l_quantity END AS v FROM lineitem UNION ALL SELECT 'l_tax', l_tax FROM lineitem)
SELECT name, count(v) AS n, count_if(v IS NULL) AS missing, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM l GROUP BY name
""")
def scalers(t: Tables) -> DataFrame:
    """Mean and deviation of columns, what is missing apart."""
    df = t("lineitem").withColumn("l_quantity", F.expr("CASE WHEN l_linenumber < 7 THEN l_quantity WHEN l_suppkey % 2 = 0 THEN double('NaN') END"))
    return ml.fit_scaler(df, ["l_quantity", "l_tax"]).select(F.col("column").alias("name"), "n", "missing", r6("mean").alias("mean"), r6("std").alias("std"))


@query("SELECT round(regr_slope(l_extendedprice, l_quantity), 2) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, abs(round(avg(l_extendedprice - regr), 2)) AS rest FROM (SELECT *, regr_intercept(l_extendedprice, l_quantity) OVER () + l_quantity * regr_slope(l_extendedprice, l_quantity) OVER () AS regr FROM lineitem)")
def line_model(t: Tables) -> DataFrame:
    """A line by Spark ML with hardly any penalty, and what it leaves."""
    line = t("lineitem").select("l_quantity", "l_extendedprice")
    w = ml.ridge_line(line, ["l_quantity"], "l_extendedprice", 0.0)
    left = ml.residual(line.withColumn("base", ml.line_prediction(w)), "l_extendedprice", "base")
    rest = left.agg(F.abs(F.round(F.avg("residual"), 2)).alias("rest"))
    return rest.select(F.lit(round(w["l_quantity"], 2)).alias("slope"), F.lit(round(w["intercept"], 2)).alias("intercept"), "rest")


@query("SELECT p_partkey, round((p_size + p_retailprice) / 2, 6) AS prediction, round(abs(p_size - p_retailprice) / 2, 6) AS sigma FROM part")
def ensembles(t: Tables) -> DataFrame:
    """Mean and deviation of two models' predictions."""
    part = t("part")
    preds = [part.select("p_partkey", F.col(c).cast("double").alias("prediction")) for c in ("p_size", "p_retailprice")]
    return ml.ensemble(preds, "p_partkey").select("p_partkey", r6("prediction").alias("prediction"), r6("sigma").alias("sigma"))


@query("""
WITH c AS (SELECT l_returnflag AS y, count(*) AS n FROM lineitem GROUP BY ALL), w AS (SELECT *, sqrt(sum(n) OVER () / CAST(n AS DOUBLE)) AS w FROM c)
SELECT y, n, round(w / (sum(w * n) OVER () / sum(n) OVER ()), 6) AS weight FROM w
""")
def weights_of_classes(t: Tables) -> DataFrame:
    """Weights of classes by the root of their inverse share."""
    counts = t("lineitem").groupBy(F.col("l_returnflag").alias("y")).agg(F.count("*").alias("n"))
    return ml.class_weights(counts, "sqrt").withColumn("weight", r6("weight"))
