"""Composite jobs: clean facts, histories, slopes and shrinkage, evaluation and luck reports."""

from __future__ import annotations

import re
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.functions import columns as X
from resultlake.operators import aggs, joins, sets, shape, windows
from resultlake.operators.quality import drop_conflicting, drop_insane, drop_out_of_range
from resultlake.streaming import ratings

#: Fixed values of the board report: tables of a board, of a large field, large fields needed,
#: skill spread of a flat field, reference skill, and what counts as no spread or no error.
MIN_TABLES, LARGE_FIELD, MIN_LARGE_FIELDS = 8, 16, 50
MIN_SPREAD, REFERENCE, SXX_MIN, SE_ZERO = 15.0, 2.0, 1e-8, 1e-8
Z95 = 1.96


# ---- clean facts -----------------------------------------------------------


def clean_results(t: dict[str, DataFrame]) -> DataFrame:
    """Club results with board, section, session and event, both pairs' two players, and valid scores."""
    players = aggs.two_members(t["players"].filter(F.col("player_number").isNotNull()), ["pair_summary_id"], "player_id", ["player_number", "player_name"])
    pairs = t["pair_summaries"].join(players, "pair_summary_id", "left")
    facts = joins.join_dims(t["board_results"], [(t["boards"], "board_id"), (t["sections"], "section_id"), (t["sessions"], "session_id"), (t["events"], "event_id")])
    for role in ("ns", "ew"):
        own = pairs.filter(F.upper("direction") == role.upper()).drop("direction", "pair_summary_id")
        facts = joins.join_role(facts, own, {"section_id": "section_id", f"{role}_pair": "pair_number"}, role)
    names = ["player_name_1_ns", "player_name_2_ns", "player_name_1_ew", "player_name_2_ew"]
    facts = facts.withColumns({n: X.strip_suffix(n) for n in names})
    top = F.col("ns_match_points") + F.col("ew_match_points")
    facts = facts.withColumns({"Pct_NS": F.try_divide("ns_match_points", top), "Pct_EW": F.try_divide("ew_match_points", top)})
    return shape.require(drop_out_of_range(facts, ["Pct_NS", "Pct_EW"]), ["session_id", "board_number"])


#: What a pair's row and that of its opponents have in common.
BOARD_OF_PAIRS = ["session_id", "section_id", "board_number"]


def _paired_rows(rows: DataFrame, newest: DataFrame) -> DataFrame:
    """A pair's rows with its two players, and the attributes of both."""
    listed = rows.withColumn("__ids", X.pad2(X.id_list("pair_acbl")))
    own = listed.select(*BOARD_OF_PAIRS, "orientation", "pair_number", "opponent_pair_number", "contract", "declarer", "score", "percentage", X.at("__ids", 0).alias("player_1"), X.at("__ids", 1).alias("player_2"))
    return joins.join_roles(own, newest, "player_number", {"1": "player_1", "2": "player_2"}, ["player_name", "mp_total"])


def clean_paired_results(rows: DataFrame, sessions: DataFrame, history: DataFrame) -> DataFrame:
    """Tournament results, a row for each pair, as one row for both, with players' latest attributes.

    ``rows``: session_id, section_id, board_number, orientation, pair_number, opponent_pair_number, pair_acbl, contract, declarer, score, percentage.
    """
    # what is looked up goes to the rows before they are paired, as a board's pairs grow with the square of its rows
    newest = aggs.latest(history, ["player_number"], ["date", "session_id"], ["player_name", "mp_total"])
    own = _paired_rows(rows, newest)
    more = [c for c in sessions.columns if c != "session_id"]
    of = sessions.select(F.col("session_id").alias("__session"), F.struct(F.lit(True).alias("__known"), *more).alias("__s"))
    own = own.join(of, (F.col("session_id") == F.col("__session")) & (F.col("orientation") == "N-S"), "left").drop("__session")
    both = joins.pair_views(own, BOARD_OF_PAIRS, ("pair_number", "opponent_pair_number")).filter("orientation_ns = 'N-S' AND orientation_ew = 'E-W'")
    both = both.withColumns({"event_id": X.id_prefix("session_id")} | {c: F.col(f"__s_ns.{c}") for c in more})
    return both.drop("__s_ns", "__s_ew")


def paired_totals(rows: DataFrame, sessions: DataFrame, history: DataFrame, by: list[str], counts: dict[str, str], sums: dict[str, str], tops: dict[str, str]) -> DataFrame:
    """Totals of :func:`clean_paired_results` by event, session or the session's columns, without making its rows.

    ``counts``, ``sums`` and ``tops`` (maxima) give a name to a column of those rows; ``n`` counts them.
    Names go by their place in the order of names, a number: Spark would sort all rows to find
    the last text of each group. Players are written down, so Spark sees how few they are
    before it plans, and needs no shuffle of the rows to look them up.
    """
    spark = rows.sparkSession
    newest = shape.with_row_id(aggs.latest(history, ["player_number"], ["date", "session_id"], ["player_name", "mp_total"]), ["player_name"], "place")
    folder = shape.scratch(spark, "players")
    newest.write.parquet(folder)
    newest = spark.read.schema(newest.schema).parquet(folder)
    own = _paired_rows(rows, newest.withColumn("player_name", F.when(F.col("player_name").isNotNull(), F.col("place"))))
    met = joins.pair_totals(own, BOARD_OF_PAIRS, ("pair_number", "opponent_pair_number"), ("orientation", "N-S", "E-W"), counts, sums, tops)
    total = [F.sum(n).alias(n) for n in ("n", *counts, *sums)] + [F.max(n).alias(n) for n in tops]
    of = met.groupBy("session_id").agg(*total).join(sessions, "session_id", "left").withColumn("event_id", X.id_prefix("session_id"))
    out = of.groupBy(*by).agg(*total)
    for name in (n for n, c in tops.items() if c.startswith("player_name_")):
        named = newest.select(F.col("place").alias("__place"), F.col("player_name").alias("__name"))
        out = out.join(named, F.col(name) == F.col("__place"), "left").withColumn(name, F.col("__name")).drop("__place", "__name")
    return out


def clean_deals(df: DataFrame) -> DataFrame:
    """Deals with canonical hands, vulnerability and par; a deal that a session numbers twice with different hands goes.

    A whole canonical deal is valid, so its text is read once. The typed rows are written
    down before anything filters or compares them: else each filter and both readers of
    the conflict check would compute the hands again.
    """
    body = F.upper(F.regexp_replace("board_record_string", r"\s+", ""))
    solved = X.valid_dd("double_dummy_ns", "NS") & X.valid_dd("double_dummy_ew", "EW")
    typed = df.filter(solved).withColumns({"hands": X.canonical_deal(body), "vul": X.board_vul("board"), "par_parsed": X.parse_par("par")})
    typed = shape.require(shape.checkpointed(typed), ["hands"]).distinct()
    return shape.require(drop_conflicting(typed, ["hand_record_id", "board"], ["hands"]), ["hand_record_id", "board"])


def standardize_results(df: DataFrame) -> DataFrame:
    """Contract, lead, result and tricks in one form; impossible scores go.

    Rows that go are left out first, and a contract is read once for all that is told of it.
    """
    some = drop_insane(shape.require(df, ["session_id", "board_number"]), "ns_match_points", "ew_match_points")
    res, tri = X.typed_result("result", "tricks_taken")
    typed = some.withColumns({"__c": X.contract_parts("contract"), "__r": res, "__t": tri})
    level = F.coalesce(F.col("__c.level"), F.lit(0))
    res, tri = X.total_tricks(level, "__r", "__t")
    out = {"Contract": X.contract_text("__c", "declarer"), "BidLvl": level, "BidSuit": F.col("__c.strain"), "Dbl": F.col("__c.doubled"), "Opening_Lead": X.clean_lead("opening_lead"), "Result": res, "Tricks": tri, "Date": X.parse_date_any("game_date")}
    return typed.withColumns(out).drop("__c", "__r", "__t")


def enrich(facts: DataFrame, deals: DataFrame, keys: list[str], block: str, rating: tuple[str, str, str] | None = None) -> DataFrame:
    """Facts with their deal, joined by block and keys, and with an entity's mean over all blocks."""
    out = joins.block_join(facts, deals, keys, block)
    return windows.entity_mean(out, *rating) if rating else out


def matchpoints(df: DataFrame, by: list[str], score: str) -> DataFrame:
    """Wins and half of ties among the rows of a group, its top, and the share of the top."""
    group, peers = Window.partitionBy(*by), Window.partitionBy(*by, score)
    n, tied = F.count(score).over(group), F.count("*").over(peers)
    below = F.rank().over(group.orderBy(F.col(score).asc_nulls_last())) - 1
    mp = F.when(F.col(score).isNotNull(), below + (tied - 1) / F.lit(2.0))
    out = df.withColumns({"mp": mp, "top": n - 1})
    return out.withColumn("pct", F.when(F.col("top") > 0, F.col("mp") / F.col("top")))


def strata(df: DataFrame, session: str, limit: str, grammar: str = "club") -> DataFrame:
    """The limit bucket of each session, read once for each and joined back."""
    one = df.groupBy(session).agg(F.max(limit).alias("__limit")).select(session, X.limit_bucket("__limit", grammar).alias("stratum"))
    return df.join(one, session, "left")


# ---- histories and priors --------------------------------------------------


def player_history(df: DataFrame, seats: str = "NESW", session: str = "session_id", date: str = "Date", columns: tuple[str, ...] = ("Player_ID", "Player_Name", "MasterPoints")) -> DataFrame:
    """One row for each player and session in date order, numbered from 0 as ``Elo_N``."""
    roles = {s: {c: f"{c}_{s}" for c in columns} for s in seats}
    long = sets.stack_roles(df, roles, [date, session]).filter(F.col(columns[0]).isNotNull())
    one = sets.unique_by(long, [columns[0], session], [date])
    return one.withColumn("Elo_N", windows.sequence([columns[0]], [date, session]))


def pair_history(df: DataFrame, session: str = "session_id", date: str = "Date") -> DataFrame:
    """One row for each pair and session, both directions, with the unordered key."""
    ns, ew = X.pair_key("Player_ID_N", "Player_ID_S"), X.pair_key("Player_ID_E", "Player_ID_W")
    keyed = df.withColumns({"Pair_IDs_NS": ns, "Pair_IDs_EW": ew})
    long = sets.stack_roles(keyed, {"NS": {"Pair_IDs": "Pair_IDs_NS"}, "EW": {"Pair_IDs": "Pair_IDs_EW"}}, [date, session]).filter("Pair_IDs IS NOT NULL")
    one = sets.unique_by(long, ["Pair_IDs", session], [date, "role"])
    return one.withColumn("Elo_N", windows.sequence(["Pair_IDs"], [date, session]))


def established(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Latest value and number of rows of each entity."""
    return df.groupBy(key).agg(F.max_by(X.finite(value), F.struct(*order)).alias("latest"), F.count("*").alias("sessions"))


def shrinkage_prior(df: DataFrame, key: str, order: list[str], value: str, least: int = 10, weight: int = 50) -> tuple[DataFrame, DataFrame]:
    """(prior, published): one row that describes entities with ``least`` rows, and every entity's value drawn to its median.

    The median and quartiles are exact, found without one task for all entities.
    """
    per = established(df, key, order, value)
    known = per.filter(F.col("sessions") >= least)
    whole = known.agg(F.avg("latest").alias("mean"), F.stddev_pop("latest").alias("std"), F.count("latest").alias("n"))
    cuts = windows.quantiles(known.select(F.lit(0).alias("all"), "latest"), ["all"], "latest", [0.5, 0.25, 0.75], "cuts").select("cuts")
    both = shape.attach(whole, cuts)
    prior = both.select(F.get("cuts", F.lit(0)).alias("anchor"), "mean", "std", "n", F.get("cuts", F.lit(1)).alias("p25"), F.get("cuts", F.lit(2)).alias("p75"))
    published = (F.col("sessions") * F.col("latest") + weight * F.col("anchor")) / (F.col("sessions") + weight)
    return prior, shape.attach(per, prior.select("anchor")).withColumn("published", published)


def dispersion_seeds(df: DataFrame, columns: list[str]) -> DataFrame:
    """Population deviation of the columns that are there, finite values only; absent ones are null (C11)."""
    return df.agg(*[(F.stddev_pop(X.finite(c)) if c in df.columns else F.lit(None).cast("double")).alias(c) for c in columns])


def rate(spark: SparkSession, games: DataFrame, k: float = ratings.K, init: float = ratings.INIT) -> DataFrame:
    """Ratings in which all games of a date count at once (C12): :func:`resultlake.streaming.ratings.rate`."""
    return ratings.rate(games, k, init)


# ---- slopes ----------------------------------------------------------------


def group_slopes(stats: DataFrame, least: int = MIN_TABLES) -> DataFrame:
    """Slope and its error of each group from sufficient statistics (C13); null with few rows or no spread."""
    n = F.col("n")
    sxx = F.col("s2") - F.col("s1") * F.col("s1") / n
    syy = F.col("y2") - F.col("y1") * F.col("y1") / n
    sxy = F.col("sy") - F.col("s1") * F.col("y1") / n
    ok = (n >= least) & (n > 2) & (sxx > SXX_MIN)
    beta = F.when(ok, sxy / sxx)
    out = stats.withColumns({"slope": beta, "mean_s": F.col("s1") / n, "mean_y": F.col("y1") / n, "__sxx": F.when(ok, sxx), "__syy": syy})
    sse = F.greatest(F.lit(0.0), F.col("__syy") - F.col("slope") * F.col("slope") * F.col("__sxx"))
    return out.withColumn("se", F.when(F.col("slope").isNotNull(), F.sqrt(sse / (n - 2) / F.col("__sxx")))).drop("__sxx", "__syy")


def global_slope(df: DataFrame, s: str, y: str) -> DataFrame:
    """One row with the slope over all rows, 0 with few or no spread (C14)."""
    return group_slopes(aggs.suff_stats(df, [], s, y), 3).select(F.coalesce(F.when(F.col("n") >= MIN_TABLES, F.col("slope")), F.lit(0.0)).alias("beta0"))


def prior_variance(slopes: DataFrame) -> DataFrame:
    """One row with the variance of true slopes: of large groups, or of all where those are few."""
    v = lambda cond: F.var_samp(F.when(cond, F.col("slope"))) - F.avg(F.when(cond, F.col("se") * F.col("se")))
    known = F.col("slope").isNotNull() & F.col("se").isNotNull()
    large, any_ = known & (F.col("n") >= LARGE_FIELD), known & (F.col("n") >= MIN_TABLES)
    one = slopes.agg(F.count_if(large).alias("n_large"), F.count_if(any_).alias("n_any"), v(large).alias("v_large"), v(any_).alias("v_any"))
    enough = F.col("n_large") >= MIN_LARGE_FIELDS
    used, n = F.when(enough, F.col("v_large")).otherwise(F.col("v_any")), F.when(enough, F.col("n_large")).otherwise(F.col("n_any"))
    return one.select(F.when(n >= 2, F.greatest(F.lit(0.0), used)).otherwise(0.0).alias("tau2"))


def shrink(slopes: DataFrame, beta0: DataFrame, tau2: DataFrame, kind: str = "miss", reference: float = REFERENCE) -> DataFrame:
    """Each slope drawn to the global one by its precision, and the difficulty at the reference skill.

    ``miss``: one minus the predicted rate within [0, 1]; ``tricks``: minus the prediction.
    """
    j = shape.attach(shape.attach(slopes, beta0), tau2)
    se = F.col("se")
    w = F.when(F.col("slope").isNull() | se.isNull(), 0.0).when(se <= SE_ZERO, 1.0).when(F.col("tau2") > 0, F.col("tau2") / (F.col("tau2") + se * se)).otherwise(0.0)
    j = j.withColumn("weight", w)
    j = j.withColumn("published", F.col("weight") * F.coalesce("slope", F.lit(0.0)) + (1 - F.col("weight")) * F.col("beta0"))
    pred = F.col("mean_y") + F.col("published") * (reference - F.col("mean_s"))
    return j.withColumn("difficulty", 1 - X.clip(pred, 0.0, 1.0) if kind == "miss" else -pred)


def flat_guard(slopes: DataFrame, spread: str, least: float = MIN_SPREAD) -> DataFrame:
    """No slope for groups whose skills hardly differ."""
    ok = F.coalesce(F.col(spread) >= least, F.lit(False))
    return slopes.withColumns({"slope": F.when(ok, F.col("slope")), "se": F.when(ok, F.col("se"))})


def partial_coefficient(df: DataFrame, d: str, f: str, y: str) -> DataFrame:
    """One row with the coefficients of y on 1, d and f: 3 x 3 normal equations by Cramer's rule (C17)."""
    e = aggs.normal_equations(df, [d, f], y)
    m = [["x0x0", "x0x1", "x0x2"], ["x0x1", "x1x1", "x1x2"], ["x0x2", "x1x2", "x2x2"]]
    r = ["x0y", "x1y", "x2y"]
    c = lambda name: F.col(name).cast("double")

    def det(a: list[list[str]]) -> Column:
        return c(a[0][0]) * (c(a[1][1]) * c(a[2][2]) - c(a[1][2]) * c(a[2][1])) - c(a[0][1]) * (c(a[1][0]) * c(a[2][2]) - c(a[1][2]) * c(a[2][0])) + c(a[0][2]) * (c(a[1][0]) * c(a[2][1]) - c(a[1][1]) * c(a[2][0]))

    with_rhs = lambda k: [[r[i] if j == k else m[i][j] for j in range(3)] for i in range(3)]
    return e.select(*[F.coalesce(F.when(F.col("n") >= MIN_TABLES, F.try_divide(det(with_rhs(k)), det(m))), F.lit(0.0)).alias(f"b{k}") for k in range(3)])


def residualize(df: DataFrame, d: str, f: str, y: str, name: str = "residual") -> DataFrame:
    """y without what the partial coefficient of f explains (C17)."""
    b = partial_coefficient(df, d, f, y).select(F.col("b2").alias("__b"))
    return shape.attach(df, b).withColumn(name, F.col(y) - F.col("__b") * F.col(f)).drop("__b")


def board_difficulty(df: DataFrame, keys: list[str], s: str, y: str, kind: str = "miss", contract: str | None = None) -> DataFrame:
    """Shrunk slope and difficulty of each board with its contract spread."""
    slopes = group_slopes(aggs.suff_stats(df, keys, s, y))
    spread = df.groupBy(*keys).agg((F.max(X.finite(s)) - F.min(X.finite(s))).alias("skill_spread"))
    slopes = flat_guard(slopes.join(spread, keys).withColumn("__spread", F.col("skill_spread") * 100), "__spread").drop("__spread")
    out = shrink(slopes, global_slope(df, s, y), prior_variance(slopes), kind)
    if contract:
        n = df.groupBy(*keys).agg(F.count_distinct(contract).alias("n_contracts"), F.count_if(F.col(contract).isNull()).alias("n_contract_null"))
        top = aggs.modal(df, keys, contract, y).select(*keys, F.when(F.col("n") >= 2, F.col("stat_std")).alias("trick_spread"))
        out = out.join(n, keys, "left").join(top, keys, "left")
    return out


def sanity(boards: DataFrame, columns: list[str], x: str, y: str) -> tuple[DataFrame, DataFrame]:
    """Distributions of the report's measures, and the correlation of two."""
    return aggs.distributions(boards, columns), aggs.pearson(boards, x, y)


# ---- evaluation ------------------------------------------------------------


def pair_sessions(df: DataFrame, section: list[str], ns: str, ew: str, actual: str, preds: list[str], least: int = 8) -> DataFrame:
    """Means of a pair's boards in a section, both directions (EW is 1 - x), of pairs with enough boards (C20)."""
    def side(pair: str, direction: str) -> DataFrame:
        v = (lambda c: 1 - F.col(c)) if direction == "EW" else F.col
        g = df.groupBy(*section, F.col(pair).alias("pair")).agg(F.avg(v(actual)).alias("actual"), *[F.avg(v(p)).alias(p) for p in preds], F.count("*").alias("boards"))
        return g.filter(F.col("boards") >= least).withColumn("direction", F.lit(direction))

    return side(ns, "NS").unionByName(side(ew, "EW"))


def rank_quality(pairs: DataFrame, section: list[str], pred: str, least: int = 4) -> DataFrame:
    """Rank correlation of predicted and actual means in each section and direction with enough pairs (C20)."""
    by = [*section, "direction"]
    pairs = shape.checkpointed(pairs)  # means are computed once
    big = pairs.join(aggs.having(pairs, by, least).drop("n"), by, "left_semi")
    return aggs.spearman(big, by, pred, "actual", small_groups=False)


def interval(df: DataFrame, pairs: DataFrame, actual: str, pred: str) -> DataFrame:
    """One row: deviation of a board, the widening that pairs need, and coverage with and without it."""
    sd = df.agg(F.stddev_samp(F.col(pred) - F.col(actual)).alias("board_sd"))
    e = shape.attach(pairs.withColumns({"error": F.col(pred) - F.col("actual"), "root": F.sqrt("boards")}), sd)
    wide = e.agg(F.sqrt(F.avg(F.pow(F.col("error") * F.col("root") / F.col("board_sd"), F.lit(2.0)))).alias("widening"))
    e = shape.attach(e, wide)
    within = lambda f: F.avg((F.abs("error") <= Z95 * f * F.col("board_sd") / F.col("root")).cast("double"))
    return e.agg(F.max("board_sd").alias("board_sd"), F.max("widening").alias("widening"), within(F.lit(1.0)).alias("coverage_plain"), within(F.col("widening")).alias("coverage_widened"), F.count("*").alias("pairs"))


def luck_report(df: DataFrame, keys: list[str], actual: str, pred: str, sigma: str | None = None, skill: str | None = None) -> DataFrame:
    """Actual against predicted mean of each group, with error, interval, z and significance."""
    measures = [F.count("*").alias("n_boards"), F.avg(actual).alias("actual"), F.avg(pred).alias("predicted"), F.stddev_samp(actual).alias("actual_std")]
    measures += [F.avg(sigma).alias("__sigma")] if sigma else []
    measures += [F.avg(skill).alias("skill")] if skill else []
    g = df.groupBy(*keys).agg(*measures)
    g = g.withColumns({"luck": F.col("actual") - F.col("predicted"), "sem": F.col("actual_std") / F.sqrt("n_boards")})
    model = F.col("__sigma") / F.sqrt("n_boards") if sigma else F.lit(0.0)
    g = g.withColumn("total_sigma", F.sqrt(F.col("sem") * F.col("sem") + model * model))
    g = g.withColumns({"ci_lo": F.col("actual") - Z95 * F.col("total_sigma"), "ci_hi": F.col("actual") + Z95 * F.col("total_sigma"), "z": F.try_divide("luck", "total_sigma")})
    g = g.withColumn("significant", F.abs("z") > Z95).drop("__sigma")
    if not skill:
        return g
    # ranks over all groups, numbered in ranges; ties share their mean
    total = g.agg(F.count("skill").alias("__all"))
    return shape.attach(windows.ranked(g, [], "skill", "__r"), total).withColumn("skill_pct", F.col("__r") / F.col("__all")).drop("__r", "__all")


def skill_features(df: DataFrame, rating: str = "Elo", points: str = "MasterPoints") -> DataFrame:
    """Differences of seat means, logarithms of points and their products; what is missing counts as 0."""
    z = lambda c: F.coalesce(X.finite(c), F.lit(0.0))
    mean = lambda p, a, b: (z(f"{p}_{a}") + z(f"{p}_{b}")) / 2
    log = lambda a, b: (F.log1p(z(f"{points}_{a}")) + F.log1p(z(f"{points}_{b}"))) / 2
    out = df.withColumns({"elo_ns": mean(rating, "N", "S"), "elo_ew": mean(rating, "E", "W"), "log_mp_ns": log("N", "S"), "log_mp_ew": log("E", "W")})
    out = out.withColumns({"elo_diff": F.col("elo_ns") - F.col("elo_ew"), "log_mp_diff": F.col("log_mp_ns") - F.col("log_mp_ew")})
    return out.withColumn("elo_x_mp", F.col("elo_diff") * F.col("log_mp_diff"))


# ---- catalogs and model tables ---------------------------------------------


def feature_catalog(spark: SparkSession, columns: list[str], rules: list[tuple[str, str, str, str]]) -> DataFrame:
    """(column, dtype, state, group) by rules (regex, dtype, state, group); no or several matches are errors."""
    rows = []
    for c in columns:
        hit = [r for r in rules if re.fullmatch(r[0], c)]
        if len(hit) != 1:
            raise ValueError(f"{c} is matched by {len(hit)} rules")
        rows.append((c, *hit[0][1:]))
    return spark.createDataFrame(rows, "column string, dtype string, state string, group string")


def columns_of_states(catalog: DataFrame, states: list[str]) -> list[str]:
    """Columns whose lifecycle state is one of some."""
    return [r["column"] for r in catalog.filter(F.col("state").isin(*states)).orderBy("column").collect()]


def model_table(facts: DataFrame, deals: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """Facts with one deal for each key, projected and with floats (C25); written by ``write_windows``."""
    repeated = [c for c in deals.columns if c in facts.columns and c not in keys]
    if repeated:
        raise ValueError(f"both sides have {', '.join(repeated)}")
    return shape.downcast_floats(joins.broadcast_lookup(facts, deals, keys, order).select(*columns))


def prediction_table(source: DataFrame, players: DataFrame, pairs: DataFrame, cutoff: str, keep_text: list[str]) -> DataFrame:
    """Model rows with ratings of four seats and two pairs, split by a fixed cutoff."""
    out = source.withColumns({"Pair_IDs_NS": X.pair_key("Player_ID_N", "Player_ID_S"), "Pair_IDs_EW": X.pair_key("Player_ID_E", "Player_ID_W")})
    for frame, key, roles in ((players, "Player_ID", {s: f"Player_ID_{s}" for s in "NESW"}), (pairs, "Pair_IDs", {"NS": "Pair_IDs_NS", "EW": "Pair_IDs_EW"})):
        payload = [c for c in frame.columns if c not in (key, "session_id", "Date")]
        for role, column in roles.items():
            side = frame.select(F.col(key).cast("string").alias("__k"), F.col("session_id").cast("string").alias("__s"), *[F.col(c).alias(f"{c}_{role}") for c in payload])
            out = out.join(side, (out[column].cast("string") == side["__k"]) & (out["session_id"].cast("string") == side["__s"]), "left").drop("__k", "__s")
    out = shape.add_split(out, "Date", cutoff)
    return shape.drop_text(out, [".*"], keep_text)


def target_frame(df: DataFrame, y: str, targets: list[str], noisy: dict[str, list[str]]) -> DataFrame:
    """Features of one target: the other targets and the families that leak it are dropped."""
    out = df.select(*[c for c in df.columns if c == y or c not in targets])
    return shape.drop_matching(out, [p for p in noisy.get(y, []) if not re.match(p, y)])


def scaled_copies(df: DataFrame, pairs: list[tuple[str, str]], tolerance: float = 1e-9) -> DataFrame:
    """(a, b, r) of candidate pairs in which one column is a scaled copy of the other, in one pass."""
    one = df.agg(*[F.abs(F.corr(F.col(a).cast("double"), F.col(b).cast("double"))).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    items = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return one.select(F.explode(F.array(*items)).alias("p")).select("p.*").filter(F.col("r") >= 1 - tolerance)


# ---- deals and contracts ---------------------------------------------------

#: Points of honours.
POINTS = {"A": 4, "K": 3, "Q": 2, "J": 1}


def deal_features(df: DataFrame, hands: str = "hands") -> DataFrame:
    """Suit lengths, high-card points, shape and balance of each hand, and points of each pair."""
    text = F.split(F.substring(F.col(hands), 3, 100), " ")
    out = {}
    for i, seat in enumerate("NESW"):
        suits = F.split(F.get(text, i), r"\.")
        size = [F.length(F.get(suits, j)) for j in range(4)]
        hand = F.get(text, i)
        out |= {f"SL_{seat}_{s}": size[j] for j, s in enumerate(X.SUITS)}
        out[f"HCP_{seat}"] = reduce(lambda a, b: a + b, [p * (F.length(hand) - F.length(F.replace(hand, F.lit(c), F.lit("")))) for c, p in POINTS.items()])
        ordered = F.sort_array(F.array(*size), asc=False)
        out[f"Shape_{seat}"] = F.array_join(F.transform(ordered, lambda x: x.cast("string")), "-")
        out[f"Balanced_{seat}"] = F.array_join(F.transform(ordered, lambda x: x.cast("string")), "-").isin("4-3-3-3", "4-4-3-2", "5-3-3-2")
    df = df.withColumns(out)
    return df.withColumns({"HCP_NS": F.col("HCP_N") + F.col("HCP_S"), "HCP_EW": F.col("HCP_E") + F.col("HCP_W")})


def contract_score(level: X.Col, strain: X.Col, doubled: X.Col, vul: X.Col, tricks: X.Col) -> Column:
    """Score of a contract for its declarer by the laws of duplicate scoring (C30); 0 for level 0.

    ``doubled``: '', X or XX; ``vul``: whether the declarer is vulnerable; ``tricks``: taken.
    """
    lv, st, db, vu, tr = (F.col(c) if isinstance(c, str) else c for c in (level, strain, doubled, vul, tricks))
    factor = F.when(db == "XX", 4).when(db == "X", 2).otherwise(1)
    over = tr - lv - 6
    per = F.when(st.isin("C", "D"), 20).otherwise(30)
    odd = (per * lv + F.when(st == "N", 10).otherwise(0)) * factor
    bonus = F.when(odd >= 100, F.when(vu, 500).otherwise(300)).otherwise(50)
    slam = F.when(lv == 7, F.when(vu, 1500).otherwise(1000)).when(lv == 6, F.when(vu, 750).otherwise(500)).otherwise(0)
    insult = F.when(db == "XX", 100).when(db == "X", 50).otherwise(0)
    extra = over * F.when(factor == 1, per).otherwise(F.when(vu, 100).otherwise(50) * factor)
    made = odd + bonus + slam + insult + extra
    down = -over
    plain = down * F.when(vu, 100).otherwise(50)
    free = F.when(down == 1, 100).when(down == 2, 300).otherwise(300 * down - 400)
    taxed = F.when(vu, 300 * down - 100).otherwise(free)
    lost = F.when(factor == 1, plain).otherwise(taxed * F.when(db == "XX", 2).otherwise(1))
    return F.when(lv == 0, 0).otherwise(F.when(over >= 0, made).otherwise(-lost)).cast("int")


def score_table(spark: SparkSession) -> DataFrame:
    """Scores of every undoubled contract, vulnerability and number of tricks: a table of fixed size."""
    rows = [(lv, st, vu, tr) for lv, st, vu, tr in product(range(1, 8), "CDHSN", (False, True), range(14))]
    df = spark.createDataFrame(rows, "level int, strain string, vul boolean, tricks int")
    return df.withColumn("score", contract_score("level", "strain", F.lit(""), "vul", "tricks"))


def expected_values(probs: DataFrame, keys: list[str], scores: DataFrame) -> DataFrame:
    """Expected score of each contract of a side from probabilities of tricks, and the best one.

    ``probs``: keys, strain, vul, tricks, p; ``scores`` is of fixed size and is broadcast.
    """
    ev = probs.join(F.broadcast(scores), ["strain", "vul", "tricks"]).groupBy(*keys, "level", "strain").agg(F.sum(F.col("p") * F.col("score")).alias("ev"))
    best = ev.groupBy(*keys).agg(F.max("ev").alias("ev_max"), F.max_by(F.concat(F.col("level").cast("string"), "strain"), F.struct("ev", -F.col("level"), "strain")).alias("best"))
    return best


def declarer_roles(df: DataFrame, declarer: str = "Declarer", player: str = "Player_ID") -> DataFrame:
    """Ids of declarer, leader, dummy and the leader's partner, and the declaring pair."""
    around = {"N": "NESW", "E": "ESWN", "S": "SWNE", "W": "WNES"}
    pick = lambda k: reduce(lambda acc, d: acc.when(F.col(declarer) == d, F.col(f"{player}_{around[d][k]}")), "NESW", F.when(F.lit(False), F.lit(None).cast("string")))
    pair = F.when(F.col(declarer).isin("N", "S"), "NS").when(F.col(declarer).isin("E", "W"), "EW")
    vul = F.when(pair == "NS", F.col("vul").isin(1, 3)).when(pair == "EW", F.col("vul").isin(2, 3))
    pct = F.when(pair == "NS", F.col("Pct_NS")).when(pair == "EW", 1 - F.col("Pct_NS"))
    return df.withColumns({"Declarer_ID": pick(0), "OnLead_ID": pick(1), "Dummy_ID": pick(2), "NotOnLead_ID": pick(3), "Declarer_Pair_Direction": pair, "Vul_Declarer": vul, "Pct_Declarer": pct})


def outcome_flags(df: DataFrame, tricks: str = "Tricks", dd: str = "DD_Tricks", strain: str = "BidSuit", score: str = "DD_Score_Declarer", par: str = "Par_Declarer", contracts: str = "par_contracts") -> DataFrame:
    """Tricks against double dummy, whether the contract is worth par, is in a par strain, and is a sacrifice."""
    own = F.exists(F.col(contracts), lambda c: c["Strain"] == F.col(strain))
    worth = F.col(score) >= F.col(par)
    return df.withColumns({"DD_Tricks_Diff": F.col(tricks) - F.col(dd), "Is_Par_Contract": worth, "Is_Par_Strain": F.coalesce(own, F.lit(False)), "Is_Sacrifice": worth & (F.col(score) < 0)})


def explode_documents(df: DataFrame, column: str, schema: str | T.DataType | None, paths: dict[str, list[str]], keys: dict[str, str], carry: list[str] = ()) -> dict[str, DataFrame]:
    """Documents as many tables (F05); without a schema the column is parsed already."""
    from resultlake.sources.tables import normalize_documents

    return normalize_documents(df, column, schema, paths, keys, carry)
