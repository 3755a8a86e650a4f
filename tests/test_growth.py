"""What grows with the tables: broadcasts, cuts, shuffles and the memory of a task."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from resultlake.operators import shape, windows
from resultlake.plans import game_queries, serve, study_queries, upkeep_queries  # noqa: F401  register their queries
from resultlake.plans import reports as R
from resultlake.plans.queries import QUERIES
from resultlake.sources import tables as tables_of
from resultlake.sources.tables import read_table
from resultlake.streaming import ratings

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark):
    return lambda name: read_table(spark, SF, name)


def plan_of(df):
    """The plan as it is before a run."""
    return df._jdf.queryExecution().sparkPlan().toString()


def bytes_of(df):
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@pytest.mark.parametrize("make", [serve.standings, R.clean_results])
def test_multiplied_tables_are_not_broadcast(spark, tables, make):
    """Customers fit a broadcast here, what they are multiplied to does not."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * bytes_of(tables("customer"))))
    try:
        plan = plan_of(make(game_queries.normal(tables)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "SortMergeJoin" in plan and not re.findall(r"BroadcastHashJoin \[[^\]]*(?:pair_summary_id|_pair)#", plan)



def test_all_boards_without_a_limit(spark):
    df = spark.range(2500).select(F.lit(True).alias("Boards_I_Played"), F.col("id").alias("Board"), (F.col("id") / 2500).alias("Pct_NS"))
    rows, _ = serve.boards(df, ["Board", "Pct_NS"], own_only=True, limit=None)
    assert rows.agg(F.count("*"), F.count_if("truncated"), F.count_distinct("Board")).first()[:] == (2500, 0, 2500)


def test_ranks_of_values_that_differ_when_computed_again(spark):
    drawn = F.udf(lambda i: random.random(), "double").asNondeterministic()
    df = spark.range(200).select((F.col("id") % 2).alias("g"), drawn("id").alias("v"))
    ranks = windows.ranked(df, ["g"], "v", "r").collect()
    assert sorted(r["r"] for r in ranks) == sorted(2 * [i + 1.0 for i in range(100)])


def test_paired_results_are_not_shuffled(spark):
    """Nothing but the rows themselves goes through an exchange: no join lies above that of the pairs."""
    rows = spark.createDataFrame([("e-1", "A", 1, "N-S", 1, 2, "[1, 2]", "3N", "N", "400", 0.5), ("e-1", "A", 1, "E-W", 2, 1, "[3]", "3N", "N", "400", 0.5)], "session_id string, section_id string, board_number int, orientation string, pair_number int, opponent_pair_number int, pair_acbl string, contract string, declarer string, score string, percentage double")
    sessions = spark.createDataFrame([("e-1", "x")], "session_id string, kind string")
    people = spark.createDataFrame([("1", "2024-01-01", "s", "Ann", 5.0), ("3", "2024-01-01", "s", "Bob", 6.0)], "player_number string, date string, session_id string, player_name string, mp_total double")
    out = R.clean_paired_results(rows, sessions, people)
    assert out.select("event_id", "kind", "player_name_1_ns", "player_name_2_ns", "player_name_1_ew", "mp_total_1_ew").collect()[0][:] == ("e", "x", "Ann", None, "Bob", 6.0)
    joins = [line for line in plan_of(out).splitlines() if "Join" in line]
    assert "Inner" in joins[0]


def test_totals_of_tournament_results_make_no_pairs(spark, tables):
    """A board's pairs grow with the square of its rows: sides are grouped, not joined, and players looked up where the rows are."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(bytes_of(tables("orders"))))
    try:
        plan = plan_of(QUERIES["tournament_results"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "Inner" not in plan and len(re.findall(r"BroadcastHashJoin \[player_[12]#", plan)) == 2


@pytest.mark.parametrize("players", [[("1", "Ann", 5.0), ("1", "Zoe", 4.0), ("2", "Bob", None), ("4", None, 7.0), (None, "Eve", 9.0)], []])
def test_totals_are_those_of_the_pairs(spark, players):
    """Also with nulls in every column, a session that is listed twice and one that is not, and players without a name."""
    rng = random.Random(5)
    some = lambda *v: rng.choice([*v, None])
    rows = [(some("e-1", "e-2", "f-1"), rng.choice("AAB"), some(1, 1, 2), some("N-S", "E-W", "N-S", "E-W", "x"), some(1, 2), some(1, 2), some("[1, 2]", "[#3, 4]", "[0, 1]", "[]", "[2, 1, 4]"), "3N", "N", "400", some(0.25, 0.5, 1.0)) for _ in range(600)]
    rows = spark.createDataFrame(rows, "session_id string, section_id string, board_number int, orientation string, pair_number int, opponent_pair_number int, pair_acbl string, contract string, declarer string, score string, percentage double")
    sessions = spark.createDataFrame([("e-1", "x"), ("e-1", "y"), ("f-1", "x")], "session_id string, kind string")
    people = spark.createDataFrame([(p, f"2024-01-{d:02}", "s", n, m) for d, (p, n, m) in enumerate(players, 1)], "player_number string, date string, session_id string, player_name string, mp_total double")
    counts, sums, tops = {"a": "player_name_1_ns", "b": "player_2_ew"}, {"c": "percentage_ns", "d": "percentage_ew"}, {"e": "player_name_1_ew", "f": "player_name_2_ns", "g": "mp_total_2_ew", "h": "percentage_ns"}
    pairs = R.clean_paired_results(rows, sessions, people).groupBy("event_id", "kind")
    want = pairs.agg(F.count("*").alias("n"), *[f(c).alias(n) for f, m in ((F.count, counts), (F.sum, sums), (F.max, tops)) for n, c in m.items()]).orderBy("event_id", "kind")
    got = R.paired_totals(rows, sessions, people, ["event_id", "kind"], counts, sums, tops).select(*want.columns).orderBy("event_id", "kind")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()] and len(want.collect()) == 4
    assert R.paired_totals(rows.limit(0), sessions, people, ["event_id"], counts, sums, tops).count() == 0



def test_documents_of_a_bounded_number_of_orders(spark, monkeypatch):
    """Orders of one remainder that are far apart do not meet in one document."""
    orders = spark.range(0, 3).select((F.col("id") * 64 * 8192).alias("o_orderkey"))
    lines = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(7).cast("long").alias("l_partkey"))
    seen = []
    sync = upkeep_queries.S.sync_documents
    monkeypatch.setattr(upkeep_queries.S, "sync_documents", lambda *a: seen.append(sync(*a)) or seen[-1])
    query = next(q for n, q in QUERIES.items() if n == "synced_documents")
    monkeypatch.setattr(tables_of, "read_table", lambda s, d, name: {"orders": orders, "lineitem": lines}[name])
    assert query(spark, "").count() == 3 and seen[-1].count() == 3


@pytest.mark.parametrize("name", ["map_distinct", "duplicates", "order_documents"])
def test_parts_grow_with_the_rows(spark, monkeypatch, name):
    """Rows are dealt by their number before they are grouped, and counted nowhere before that."""
    monkeypatch.setattr(shape, "ROWS_OF_TASK", 500)
    dealt = re.findall(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", plan_of(QUERIES[name](spark, SF)))
    assert dealt and all(int(n) >= 12 for n in dealt)


def test_entities_of_a_stretch_move_at_once():
    """Ratings are those of one date after another, wherever the rows are cut."""
    rng = np.random.default_rng(3)
    rows = [(f"e{e}", d, float(f), float(rng.random()), int(rng.integers(1, 4))) for e in range(40) for d in range(rng.integers(1, 9)) for f in sorted(rng.uniform(0.2, 0.8, rng.integers(1, 5)))]
    want, rating = [], {}
    for (entity, date), some in itertools.groupby(rows, lambda r: r[:2]):
        form, score, n = (np.array(c) for c in list(zip(*some))[2:])
        before = rating.get(entity, ratings.INIT)
        rating[entity] = ratings._moved(before, form, score, n, ratings.K, ratings.INIT)
        want.append((date, entity, n.sum(), before, rating[entity]))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["entity", "date", "form", "score", "n"])
    for step in (1, 7, len(rows)):
        got, held, last, now = [], [], None, ratings.INIT
        for at in range(0, len(rows), step):
            out, rest, last, now = ratings._folded([*held, batch.slice(at, step)], last, now, False, ratings.K, ratings.INIT)
            got, held = got + out.to_pylist(), [rest]
        got += ratings._folded(held, last, now, True, ratings.K, ratings.INIT)[0].to_pylist()
        assert [tuple(r.values()) for r in got] == [(*w[:3], *(pytest.approx(x, abs=1e-9) for x in w[3:])) for w in want]
