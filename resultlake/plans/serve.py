"""Questions about clubs, players and sessions, answered as tables."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.functions.columns import in_range_or_unknown
from resultlake.operators import aggs, joins, pick, sets, shape
from resultlake.operators.fuzzy import fuzzy_lookup, index_lookup, fuzzy_score


def club_list(events: DataFrame, query: str | None = None, least: float = 0.55) -> DataFrame:
    """Clubs with their last name and number of events; by a name that is nearly the query's."""
    per = events.groupBy("club_id").agg(F.max_by("club_name", F.struct("date", "event_id")).alias("club_name"), F.count_distinct("event_id").alias("events"))
    if query is None:
        return per.orderBy(F.desc("events"), "club_id")
    return per.withColumn("score", fuzzy_score(F.col("club_name"), query)).filter(F.col("score") >= least).orderBy(F.desc("score"), "club_id")


def club_games(events: DataFrame, club, lo: str | None = None, hi: str | None = None) -> DataFrame:  # noqa: ANN001
    """Games of a club within dates, the newest id first; unknown dates are kept."""
    return events.filter((F.col("club_id") == typed(events, "club_id", club)) & in_range_or_unknown("date", lo, hi)).orderBy(F.desc("event_id"))


def player_games(t: dict[str, DataFrame], player) -> DataFrame:  # noqa: ANN001
    """Events that a player took part in, one row each, along players, pairs, sections, sessions, events."""
    path = [t["players"], t["pair_summaries"], t["sections"], t["sessions"], t["events"]]
    links = [("pair_summary_id", "pair_summary_id"), ("section_id", "section_id"), ("session_id", "session_id"), ("event_id", "event_id")]
    out = joins.path_join(path, links, F.col("player_number") == typed(t["players"], "player_number", player))
    return sets.unique_by(out.select("event_id", "game_date", "event_name", "session_id", "section_id"), ["event_id"], ["game_date", "session_id"]).orderBy(F.desc("event_id"))


def player_sessions(facts: DataFrame, player, limit: int = 200) -> DataFrame:  # noqa: ANN001
    """Sessions of a player with the mean score, the latest first."""
    seats = {f"Player_ID_{s}": "NS" if s in "NS" else "EW" for s in "NESW"}
    score = aggs.player_scores(facts, F.lit(player), seats, "Pct_NS", "session_id")
    dates = facts.groupBy("session_id").agg(F.max("Date").alias("Date"))
    return score.join(dates, "session_id").orderBy(F.desc("Date"), F.desc("session_id")).limit(limit)


def player_listing(facts: DataFrame, official: DataFrame, query: str | None = None, least: float = 0.55) -> DataFrame:
    """Players with official values in place of our own where there are any, by name if asked."""
    merged = joins.override_merge(facts, official, ["player_id"], ["name", "mp_total"])
    if query is None:
        return merged
    return merged.withColumn("score", fuzzy_score(F.col("name"), query)).filter(F.col("score") >= least).orderBy(F.desc("score"), "player_id")


def typed(df: DataFrame, column: str, value):  # noqa: ANN001, ANN201
    """A literal of the column's type: a cast of the column itself would keep the filter from the scan."""
    return F.lit(str(value)).cast(df.schema[column].dataType) if not isinstance(df.schema[column].dataType, T.StringType) else F.lit(str(value))


def session_rows(facts: DataFrame, session, column: str = "session_id") -> DataFrame:  # noqa: ANN001
    """Rows of one session, by a filter that reaches the scan."""
    return facts.filter(F.col(column) == typed(facts, column, session))


def session_tables(t: dict[str, DataFrame], session) -> dict[str, DataFrame]:  # noqa: ANN001
    """The normalized tables of one session, filtered hop by hop."""
    root = session_rows(t["sessions"], session)
    links = [("sessions", "session_id", "sections", "session_id"), ("sections", "section_id", "boards", "section_id"), ("boards", "board_id", "board_results", "board_id"), ("sections", "section_id", "pair_summaries", "section_id"), ("pair_summaries", "pair_summary_id", "players", "pair_summary_id"), ("sessions", "event_id", "events", "event_id")]
    return joins.cascade(t, root, links)


def session_views(facts: DataFrame, session) -> dict[str, DataFrame]:  # noqa: ANN001
    """Tables of one session from the wide fact: sections, boards, pairs with their mean, results."""
    own = session_rows(facts, session)
    sides = [own.groupBy("section_id", F.col(f"Pair_Number_{s}").alias("pair_number")).agg(F.avg(F.col("Pct_NS") if s == "NS" else 1 - F.col("Pct_NS")).alias("percentage"), F.count("*").alias("boards")).withColumn("direction", F.lit(s)) for s in ("NS", "EW")]
    return {"sections": own.select("session_id", "section_id").distinct(), "boards": own.select("section_id", "Board").distinct(), "pair_summaries": sides[0].unionByName(sides[1]), "board_results": own}


def standings(t: dict[str, DataFrame]) -> DataFrame:
    """Pairs with the names and numbers of both players."""
    two = aggs.two_members(t["players"], ["pair_summary_id"], "player_id", ["player_number", "player_name"])
    return t["pair_summaries"].join(two, "pair_summary_id", "left").orderBy("section_id", "direction", F.desc_nulls_last("percentage"), "pair_summary_id")


def personalize(df: DataFrame, player) -> DataFrame:  # noqa: ANN001
    """Each row with flags from one player's side: own section, pair, and who declared."""
    seat = F.coalesce(*[F.when(F.col(f"Player_ID_{s}") == F.lit(player), F.lit(s)) for s in "NESW"])
    mine = df.withColumn("__seat", seat).filter("__seat IS NOT NULL")
    partner = {"N": "S", "S": "N", "E": "W", "W": "E"}
    pair = F.when(F.col("__seat").isin("N", "S"), F.col("Pair_Number_NS")).otherwise(F.col("Pair_Number_EW"))
    own = F.struct(F.col("__seat").alias("seat"), F.col("section_id").alias("section"), pair.alias("pair"))
    context = mine.agg(F.min_by(own, F.struct("Board", own)).alias("me"))  # of the first board
    out = shape.attach(df, context)
    side = F.when(F.col("me.seat").isin("N", "S"), "NS").otherwise("EW")
    pair = F.when(side == "NS", F.col("Pair_Number_NS")).otherwise(F.col("Pair_Number_EW"))
    played = (F.col("section_id") == F.col("me.section")) & (pair == F.col("me.pair"))
    swap = F.create_map(*[F.lit(x) for kv in partner.items() for x in kv])
    declared = F.col("Declarer")
    flags = {"My_Section": F.col("section_id") == F.col("me.section"), "Boards_I_Played": played, "Boards_I_Declared": played & (declared == F.col("me.seat")), "Boards_Partner_Declared": played & (declared == swap[F.col("me.seat")])}
    flags["Boards_Opponent_Declared"] = played & ~declared.isin("") & ~(declared == F.col("me.seat")) & ~(declared == swap[F.col("me.seat")])
    return out.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}).drop("me")


def boards(df: DataFrame, columns: list[str], own_only: bool = False, limit: int | None = 200) -> tuple[DataFrame, list[str]]:
    """(rows, missing): chosen columns, fractions as percentages, capped with a flag; names that are not columns are told.

    Without a limit all rows are returned, and the flag is false.
    """
    missing = [c for c in columns if c not in df.columns]
    some = df.filter("Boards_I_Played") if own_only else df
    out = some.select(*[c for c in columns if c in df.columns])
    percent = [c for c in out.columns if c.lower().startswith("pct")]
    out = shape.scale_percent(out, percent) if percent else out
    return (out.withColumn("truncated", F.lit(False)) if limit is None else pick.capped(out, limit)[0]), missing


def sql_self(df: DataFrame, sql: str, context: dict[str, str] | None = None, limit: int = 200) -> DataFrame:
    """SQL over one table named ``self``: ``{name}`` is replaced from the context, a fragment gets its FROM.

    The table goes by a name of its own, and ``self`` is a name of the query alone, so views
    of the caller are neither hidden nor lost. Only queries run.
    """
    for name, value in (context or {}).items():
        sql = sql.replace("{" + name + "}", value)
    sql = sql.strip().rstrip(";")
    if not re.match(r"(?i)\s*(select|with|from|values)\b", sql):
        sql = f"SELECT * FROM self {sql}" if re.match(r"(?i)\s*(where|order|limit|group)\b", sql) else f"FROM self SELECT {sql}"
    elif re.match(r"(?i)\s*select\b", sql) and not re.search(r"(?i)\bfrom\b", sql):
        sql = f"FROM self {sql}"
    return _isolated({"self": df}, sql, limit)


def sql_tables(t: dict[str, DataFrame], sql: str, limit: int = 200) -> DataFrame:
    """SQL over named tables."""
    return _isolated(t, sql, limit)


class Refused(ValueError):
    """SQL that is no query of the given tables."""


#: Functions that run code outside of the query.
OUTSIDE = r"(?i)\b(reflect|try_reflect|java_method)\s*\("


def _isolated(t: dict[str, DataFrame], sql: str, limit: int) -> DataFrame:
    """A query that reads the given tables and nothing else.

    The tables are common table expressions over views of unique names, which are dropped at
    once. The text is parsed before it is run, so that no command is, and the analysed plan
    is walked down to those views: a plan that reaches any other table, view, file or
    source is refused. Constants and ``range`` are allowed.
    """
    session = next(iter(t.values())).sparkSession
    views = {name: f"v_{uuid.uuid4().hex}" for name in t}
    named = ", ".join(f"`{name}` AS (SELECT * FROM {view})" for name, view in views.items())
    own = re.match(r"(?is)\s*with\s+(?!recursive\b)", sql)
    text = f"WITH {named}, {sql[own.end():]}" if own else f"WITH {named} {sql}"
    bare = re.sub(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S)
    if re.search(OUTSIDE, bare):
        raise Refused("the query calls code outside of it")
    jvm = session.sparkContext._jvm
    kinds = [jvm.java.lang.Class.forName(f"org.apache.spark.sql.catalyst.plans.logical.{k}") for k in ("Command", "ParsedStatement")]
    try:
        parsed = session._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException as e:
        raise Refused(f"not a query: {str(e).splitlines()[0]}") from e
    if any(k.isInstance(node) for node in _nodes(parsed, set()) for k in kinds):
        raise Refused("only queries are run")
    for name, df in t.items():
        df.createOrReplaceTempView(views[name])
    try:
        out = session.sql(text)
        for node in _nodes(out._jdf.queryExecution().analyzed(), set(views.values())):
            if node.children().isEmpty() and node.nodeName() not in ("OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "View"):
                raise Refused(f"the query reads something else than {', '.join(t)}")
            if node.nodeName().startswith("View") and not any(v in node.simpleString(25) for v in views.values()):
                raise Refused(f"the query reads a view that is none of {', '.join(t)}")
        return out.limit(limit)
    finally:
        for view in views.values():
            session.catalog.dropTempView(view)


def _nodes(plan, views: set[str]):  # noqa: ANN001, ANN202
    """A plan's nodes and those of its subqueries, but not what lies below the views named."""
    todo = [plan]
    while todo:
        node = todo.pop()
        yield node
        if node.nodeName().startswith("View") and any(v in node.simpleString(25) for v in views):
            continue
        for some in (node.children(), node.subqueries()):
            todo += [some.apply(i) for i in range(some.size())]


def inventory(t: dict[str, DataFrame]) -> DataFrame:
    """Tables with their rows and columns."""
    from functools import reduce

    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"), F.lit(",".join(df.columns)).alias("names")) for name, df in t.items()]
    return reduce(DataFrame.unionByName, parts)


def table(t: dict[str, DataFrame], name: str, columns: list[str] | None = None) -> DataFrame:
    """One table, some columns; unknown names are errors."""
    if name not in t:
        raise KeyError(f"no table {name}")
    unknown = [c for c in columns or [] if c not in t[name].columns]
    if unknown:
        raise KeyError(f"{name} has no column {', '.join(unknown)}")
    return t[name].select(*columns) if columns else t[name]


def player_lookup(players: DataFrame, query: str, club: str | None = None) -> DataFrame:
    """Players by number, or by all words of a name, with their latest attributes; in one club if asked."""
    some = players if club is None else players.filter(F.col("club_id") == typed(players, "club_id", club))
    if query.strip().isdigit():
        some = some.filter(F.col("player_number") == typed(players, "player_number", query.strip()))
    else:
        some = some.filter(shape.all_of([F.contains(F.lower("player_name"), F.lit(w)) for w in query.lower().split()] or [F.lit(False)]))
    return aggs.latest(some, ["player_number"], ["date"], ["player_name", "city", "state"]).orderBy("player_number")


def typo_lookup(players: DataFrame, query: str, k: int = 20, index: DataFrame | None = None) -> DataFrame:
    """(player_number, player_name, score): players whose name is nearly the query.

    With a 3-gram ``index`` of the names (:func:`~resultlake.operators.fuzzy.write_gram_index`)
    only names that share enough 3-grams are looked at; the ``k`` names are joined back.
    """
    known = players.select("player_number", "player_name").distinct()
    if index is None:
        return fuzzy_lookup(known, "player_name", query, k=k)
    names = index_lookup(index, query, k=k).withColumnRenamed("text", "player_name")
    found = known.join(F.broadcast(names), "player_name").select("player_number", "player_name", "score")  # k rows
    return found.orderBy(F.desc("score"), "player_name", "player_number").limit(k)


def dataset_info(t: dict[str, DataFrame], dates: dict[str, str]) -> DataFrame:
    """Rows and newest date of each table."""
    from functools import reduce

    parts = [df.agg(F.count("*").alias("rows"), (F.max(F.col(dates[n]).cast("date")) if n in dates else F.lit(None).cast("date")).alias("newest")).select(F.lit(n).alias("table"), (F.col("rows") > 0).alias("available"), "rows", "newest") for n, df in t.items()]
    return reduce(DataFrame.unionByName, parts)
