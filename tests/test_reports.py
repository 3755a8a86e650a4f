import datetime

import pytest
from pyspark.sql import functions as F

from resultlake.operators import aggs
from resultlake.plans import ml, serve
from resultlake.plans import reports as R


def line(slope, n=20, group=1, noise=0.0):
    return [(group, float(i), 0.1 + slope * i + noise * (-1) ** i) for i in range(n)]


def test_slopes(spark):
    df = spark.createDataFrame(line(0.2) + [(2, float(i), 0.5) for i in range(10)] + line(1.0, 4, 3), "g int, s double, y double")
    got = {r["g"]: r for r in R.group_slopes(aggs.suff_stats(df, ["g"], "s", "y")).collect()}
    assert got[1]["slope"] == pytest.approx(0.2) and got[1]["se"] == pytest.approx(0, abs=1e-6)
    assert got[2]["slope"] == pytest.approx(0) and got[3]["slope"] is None


def test_shrink_edges(spark):
    s = spark.createDataFrame([(1, 20, 0.4, 0.0, 1.0, 0.5), (2, 20, 0.4, 0.1, 1.0, 0.5), (3, 4, None, None, 1.0, 0.5)], "g int, n int, slope double, se double, mean_s double, mean_y double")
    b0 = spark.createDataFrame([(0.1,)], "beta0 double")
    zero = {r["g"]: r for r in R.shrink(s, b0, spark.createDataFrame([(0.0,)], "tau2 double")).collect()}
    assert [zero[g]["weight"] for g in (1, 2, 3)] == [1, 0, 0] and zero[3]["published"] == pytest.approx(0.1)
    some = {r["g"]: r for r in R.shrink(s, b0, spark.createDataFrame([(0.01,)], "tau2 double")).collect()}
    assert some[2]["weight"] == pytest.approx(0.5) and some[2]["published"] == pytest.approx(0.25)
    assert some[2]["difficulty"] == pytest.approx(1 - (0.5 + 0.25))


def test_prior_variance(spark):
    s = spark.createDataFrame([(20, v, 0.1) for v in (0.0, 0.2, 0.4, 0.6)], "n int, slope double, se double")
    assert R.prior_variance(s).first()[0] == pytest.approx(0.2 / 3 - 0.01)
    assert R.prior_variance(s.limit(1)).first()[0] == 0


def test_partial_coefficient(spark):
    df = spark.createDataFrame([(float(i % 5), float(i % 7), 1 + 0.3 * (i % 5) - 0.5 * (i % 7)) for i in range(70)], "d double, f double, y double")
    b = R.partial_coefficient(df, "d", "f", "y").first()
    assert (b["b0"], b["b1"], b["b2"]) == pytest.approx((1, 0.3, -0.5))
    assert R.residualize(df, "d", "f", "y").agg(F.max(F.abs(F.col("residual") - 1 - 0.3 * F.col("d")))).first()[0] == pytest.approx(0, abs=1e-9)


def test_rank_evaluation(spark):
    rows = [("s", b, t, 100 + t, 0.25 + 0.1 * t, 0.35 + 0.1 * t) for b in range(8) for t in range(4)]
    df = spark.createDataFrame(rows, "sec string, Board int, ns int, ew int, y double, p double")
    pairs = R.pair_sessions(df, ["sec"], "ns", "ew", "y", ["p"])
    q = {r["direction"]: r["spearman"] for r in R.rank_quality(pairs, ["sec"], "p").collect()}
    assert q == {"NS": pytest.approx(1), "EW": pytest.approx(1)}
    assert aggs.errors(pairs, "actual", "p").first()["mae"] == pytest.approx(0.1)
    assert R.pair_sessions(df.filter("Board < 7"), ["sec"], "ns", "ew", "y", ["p"]).count() == 0


def test_matchpoints(spark):
    df = spark.createDataFrame([(1, "a", 100), (1, "b", 50), (1, "c", 50), (1, "d", None), (2, "e", 7)], "g int, k string, s int")
    got = {r["k"]: (r["mp"], r["pct"]) for r in R.matchpoints(df, ["g"], "s").collect()}
    assert got == {"a": (2.0, 1.0), "b": (0.5, 0.25), "c": (0.5, 0.25), "d": (None, None), "e": (0.0, None)}


def test_contract_scores(spark):
    cases = [(3, "N", "", False, 9, 400), (4, "S", "", True, 10, 620), (6, "H", "", False, 12, 980), (7, "N", "XX", True, 13, 2980), (1, "C", "X", False, 7, 140), (2, "S", "", False, 6, -100), (4, "H", "X", True, 8, -500), (3, "D", "XX", False, 5, -1600), (0, None, None, False, 0, 0), (1, "N", "X", True, 9, 580)]
    df = spark.createDataFrame([c for c in cases], "l int, st string, d string, v boolean, t int, want int")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", R.contract_score("l", "st", "d", "v", "t")).collect())
    scores = R.score_table(spark)
    assert scores.count() == 7 * 5 * 2 * 14
    probs = spark.createDataFrame([(1, "N", False, t, p) for t, p in ((8, 0.5), (9, 0.5))], "b int, strain string, vul boolean, tricks int, p double")
    assert R.expected_values(probs, ["b"], scores).first()["best"] == "3N"


def test_histories(spark):
    df = spark.createDataFrame([("2024-01-02", "s2", "1", "2", "3", "4"), ("2024-01-01", "s1", "1", "5", "2", None)], "Date string, session_id string, Player_ID_N string, Player_ID_E string, Player_ID_S string, Player_ID_W string")
    h = R.player_history(df, columns=("Player_ID",))
    assert {(r["Player_ID"], r["session_id"]): r["Elo_N"] for r in h.collect()} == {("1", "s1"): 0, ("1", "s2"): 1, ("2", "s1"): 0, ("2", "s2"): 1, ("3", "s2"): 0, ("4", "s2"): 0, ("5", "s1"): 0}
    assert {r["Pair_IDs"] for r in R.pair_history(df).collect()} == {"1-3", "2-4", "1-2"}


def test_rating_of_a_date_is_simultaneous(spark):
    games = spark.createDataFrame([("d1", 1, "a", "b", 1.0), ("d1", 2, "a", "c", 1.0), ("d2", 3, "a", "b", 0.0), ("d2", 4, "a", None, 1.0)], "date string, game_id int, a string, b string, score double")
    got = {(r["date"], r["entity"]): r for r in R.rate(spark, games).collect()}
    assert got["d1", "a"]["before"] == 1500 and got["d1", "a"]["after"] == pytest.approx(1520)
    assert got["d1", "b"]["after"] == pytest.approx(1490) and got["d2", "a"]["before"] == pytest.approx(1520)
    assert ("d2", None) not in got and got["d2", "a"]["n_games"] == 1


def test_luck(spark):
    df = spark.createDataFrame([("p", 0.6), ("p", 0.8), ("q", 0.4)], "k string, y double").withColumns({"h": F.lit(0.5), "s": F.when(F.col("k") == "p", 10.0).otherwise(1.0)})
    got = {r["k"]: r for r in R.luck_report(df, ["k"], "y", "h", skill="s").collect()}
    assert got["p"]["luck"] == pytest.approx(0.2) and got["p"]["sem"] == pytest.approx(0.1) and got["p"]["significant"]
    assert (got["p"]["skill_pct"], got["q"]["skill_pct"]) == (1.0, 0.5)


def test_catalog_and_leaks(spark):
    rules = [("Elo_.*", "float", "pre", "skill"), ("Pct_.*", "float", "target", "result")]
    cat = R.feature_catalog(spark, ["Elo_N", "Pct_NS"], rules)
    assert R.columns_of_states(cat, ["pre"]) == ["Elo_N"]
    for bad in (["x"],):
        with pytest.raises(ValueError):
            R.feature_catalog(spark, bad, rules)
    df = spark.createDataFrame([(1, 2, 3)], "Elo_N int, Pct_NS int, Tricks int")
    assert R.target_frame(df, "Pct_NS", ["Pct_NS", "Tricks"], {}).columns == ["Elo_N", "Pct_NS"]


def test_deal_features_and_roles(spark):
    deal = "N:AKQJT98765432... .AKQJT98765432.. ..AKQJT98765432. ...AKQJT98765432"
    r = R.deal_features(spark.createDataFrame([(deal,)], "hands string")).first()
    assert (r["SL_N_S"], r["HCP_N"], r["HCP_NS"], r["Shape_E"], r["Balanced_N"]) == (13, 10, 20, "13-0-0-0", False)
    df = spark.createDataFrame([("E", "1", "2", "3", "4", 2, 0.3)], "Declarer string, Player_ID_N string, Player_ID_E string, Player_ID_S string, Player_ID_W string, vul int, Pct_NS double")
    r = R.declarer_roles(df).first()
    assert (r["Declarer_ID"], r["OnLead_ID"], r["Dummy_ID"], r["NotOnLead_ID"], r["Declarer_Pair_Direction"], r["Vul_Declarer"], r["Pct_Declarer"]) == ("2", "3", "4", "1", "EW", True, 0.7)


def club(spark):
    return {
        "board_results": spark.createDataFrame([(1, 1, 1, 2, 3.0, 1.0), (2, 1, 1, 2, 0.0, 0.0)], "board_result_id int, board_id int, ns_pair int, ew_pair int, ns_match_points double, ew_match_points double"),
        "boards": spark.createDataFrame([(1, 1, 7)], "board_id int, section_id int, board_number int"),
        "sections": spark.createDataFrame([(1, 5, "A")], "section_id int, session_id int, section_name string"),
        "sessions": spark.createDataFrame([(5, 9, "2024-01-01")], "session_id int, event_id int, game_date string"),
        "events": spark.createDataFrame([(9, "Open")], "event_id int, event_name string"),
        "pair_summaries": spark.createDataFrame([(11, 1, 1, "NS", 60.0), (12, 1, 2, "EW", 40.0)], "pair_summary_id int, section_id int, pair_number int, direction string, percentage double"),
        "players": spark.createDataFrame([(1, 11, "77", "Ann (swap names)"), (2, 11, "78", "Bob"), (3, 12, "79", "Cy")], "player_id int, pair_summary_id int, player_number string, player_name string"),
    }


def test_club_results(spark):
    got = R.clean_results(club(spark)).orderBy("board_result_id").collect()
    assert got[0]["Pct_NS"] == 0.75 and got[0]["player_name_1_ns"] == "Ann" and got[0]["player_number_2_ew"] is None
    assert got[1]["Pct_NS"] is None and got[0]["event_name"] == "Open"


def test_tournament_results(spark):
    rows = [("1-2-1", "A", 1, "N-S", 1, 2, "[7, 8]", "3N", "N", "400", 0.6), ("1-2-1", "A", 1, "E-W", 2, 1, "[9]", "3N", "N", "400", 0.4)]
    df = spark.createDataFrame(rows, "session_id string, section_id string, board_number int, orientation string, pair_number int, opponent_pair_number int, pair_acbl string, contract string, declarer string, score string, percentage double")
    hist = spark.createDataFrame([("7", "2024-01-01", "s1", "Old", 1.0), ("7", "2024-02-01", "s2", "New", 2.0)], "player_number string, date string, session_id string, player_name string, mp_total double")
    got = R.clean_paired_results(df, spark.createDataFrame([("1-2-1", "x")], "session_id string, kind string"), hist).collect()
    assert len(got) == 1 and got[0]["player_name_1_ns"] == "New" and got[0]["player_2_ew"] is None and got[0]["event_id"] == "1"


def test_deals_and_results(spark):
    deal = "".join("".join(s + ("AKQJT98765432" if s == "SHDC"[i] else "") for s in "SHDC") for i in range(4))
    df = spark.createDataFrame([("h", 1, deal, "NS: 7NT 7S 7H 7D 7C", "EW: NT S H D C", "Par: 0"), ("h", 2, "junk", "x", "y", None)], "hand_record_id string, board int, board_record_string string, double_dummy_ns string, double_dummy_ew string, par string")
    got = R.clean_deals(df).collect()
    assert len(got) == 1 and got[0]["vul"] == 0 and got[0]["par_parsed"].score == 0
    df = spark.createDataFrame([("s", 1, "3 NT", "N", "10 S", "=", "9", "1/2/2024", 3.0, 1.0), ("s", 2, "PASS", None, None, None, None, None, 0.0, 0.0)], "session_id string, board_number int, contract string, declarer string, opening_lead string, result string, tricks_taken string, game_date string, ns_match_points double, ew_match_points double")
    got = R.standardize_results(df).collect()
    assert len(got) == 1 and (got[0]["Contract"], got[0]["Opening_Lead"], got[0]["Tricks"], str(got[0]["Date"])) == ("3NN", "ST", 9, "2024-01-02")


def test_serving(spark):
    t = club(spark)
    assert [r["event_id"] for r in serve.player_games(t, 77).collect()] == [9]
    assert {k: v.count() for k, v in serve.session_tables(t, 5).items()} == {"sessions": 1, "sections": 1, "boards": 1, "board_results": 2, "pair_summaries": 2, "players": 3, "events": 1}
    assert [r["player_name_1"] for r in serve.standings(t).collect()] == ["Cy", "Ann (swap names)"]
    assert {r["table"]: r["rows"] for r in serve.inventory(t).collect()}["players"] == 3
    with pytest.raises(KeyError):
        serve.table(t, "players", ["nope"])
    assert serve.sql_self(t["players"], "WHERE player_id > {least}", {"least": "1"}).count() == 2
    assert serve.sql_self(t["players"], "SELECT count(*) AS n").first()["n"] == 3
    assert serve.sql_tables(t, "SELECT * FROM players JOIN pair_summaries USING (pair_summary_id)").count() == 3
    with pytest.raises(ValueError):
        serve.sql_tables(t, "DROP TABLE players")
    info = {r["table"]: r for r in serve.dataset_info(t, {"sessions": "game_date"}).collect()}
    assert info["sessions"]["newest"] == datetime.date(2024, 1, 1) and info["players"]["newest"] is None
    p = t["players"].withColumns({"date": F.lit("2024"), "city": F.lit("x"), "state": F.lit("y"), "club_id": F.lit(1)})
    assert [r["player_number"] for r in serve.player_lookup(p, "ann swap").collect()] == ["77"]
    assert [r["player_number"] for r in serve.player_lookup(p, "78", "1").collect()] == ["78"]
    assert serve.typo_lookup(p, "Bobb").first()["player_number"] == "78"


def test_personal_view(spark):
    df = spark.createDataFrame([("s", "A", 1, "1", "2", "3", "4", 5, 6, "S", 0.5), ("s", "A", 2, "9", "2", "8", "4", 7, 6, "W", 0.25)], "session_id string, section_id string, Board int, Player_ID_N string, Player_ID_E string, Player_ID_S string, Player_ID_W string, Pair_Number_NS int, Pair_Number_EW int, Declarer string, Pct_NS double")
    me = serve.personalize(df, "1").orderBy("Board").collect()
    assert [r["Boards_I_Played"] for r in me] == [True, False] and me[0]["Boards_Partner_Declared"]
    rows, missing = serve.boards(serve.personalize(df, "1"), ["Board", "Pct_NS", "zz"], own_only=True)
    assert missing == ["zz"] and rows.first()["Pct_NS"] == 50 and not rows.first()["truncated"]
    dated = df.withColumn("Date", F.lit("2024-01-01").cast("date"))
    assert serve.player_sessions(dated, "2").first()["score"] == pytest.approx(0.625)
    assert {k: v.count() for k, v in serve.session_views(df, "s").items()} == {"sections": 1, "boards": 2, "pair_summaries": 3, "board_results": 2}


def test_models(spark):
    df = spark.range(200).select("id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z")).withColumn("y", 2 + 3 * F.col("x") - F.col("z"))
    w = ml.ridge_line(df, ["x", "z"], "y", 0.0)
    assert (w["x"], w["z"], w["intercept"]) == pytest.approx((3, -1, 2), abs=1e-6)
    assert df.select(F.max(F.abs(ml.line_prediction(w) - F.col("y")))).first()[0] < 1e-5
    scaler = ml.fit_scaler(df.withColumn("x", F.when(F.col("id") == 0, float("nan")).otherwise(F.col("x"))), ["x", "z"])
    assert {r["column"]: r["missing"] for r in scaler.collect()} == {"x": 1, "z": 0}
    assert ml.apply_scaler(df, scaler).agg(F.avg("z")).first()[0] == pytest.approx(0, abs=1e-9)
    iso = ml.isotonic(df.withColumns({"p": F.col("x") / 10, "t": F.col("x") / 9}), "id", "t", "p", 1)
    assert iso.filter("calibrated < 0 OR calibrated > 1").count() == 0

    def fit(part):
        mean = part.agg(F.avg("y")).first()[0]
        return lambda rows: rows.withColumn("prediction", F.lit(mean))

    oof = ml.out_of_fold(df, "id", fit)
    assert oof.count() == 200 and oof.select("prediction").distinct().count() == 2
    ens = ml.ensemble([df.select("id", F.lit(float(v)).alias("prediction")) for v in (1, 3)], "id").first()
    assert (ens["prediction"], ens["sigma"]) == (2.0, 1.0)
    model = ml.train(df.withColumn("c", F.when(F.col("x") > 4, "hi").otherwise("lo")), "c", ["x", "z"], maxIter=20)
    out = model.transform(df.withColumn("c", F.when(F.col("x") > 4, "hi").otherwise("lo")))
    assert out.filter("prediction = __label").count() >= 190


def test_model_of_each_group(spark):
    df = spark.createDataFrame([(g, float(i), float(g * i)) for g in (1, 2) for i in range(5)], "g int, x double, y double")
    got = {r["g"]: r["slope"] for r in ml.fit_per_group(df, ["g"], lambda p: {"slope": p["x"].cov(p["y"]) / p["x"].var()}, ["slope"]).collect()}
    assert got == {1: pytest.approx(1), 2: pytest.approx(2)}


def test_choices():
    calls = []
    trials = ml.sweep(lambda p: calls.append(p) or (p["a"] - 2) ** 2 + (p["b"] - 1) ** 2, {"a": [0, 1, 2], "b": [3, 1]})
    assert min(t["metric"] for t in trials) == 0 and len(trials) == len(calls) <= 6
    assert ml.plateau([(10, 0.5), (20, 0.31), (40, 0.3)], 0.02) == 20


def test_joint_pick(spark):
    df = spark.sql("SELECT 1 AS k, map('3NN', 0.5D, '3NS', 0.49D) AS p, map('N', 0.1D, 'S', 0.9D) AS d")
    assert ml.joint_pick(df, "k", "p", "d").first()["choice"] == "3NS"
    w = {r["y"]: r["weight"] for r in ml.class_weights(spark.createDataFrame([("a", 9), ("b", 1)], "y string, n int"), "inverse").collect()}
    assert w["b"] == pytest.approx(9 * w["a"]) and 9 * w["a"] + w["b"] == pytest.approx(10)


def test_deals_are_read_once(spark):
    """The plan that reads deals names their text a few times, and what filters them reads what is written."""
    from pyspark.sql import functions as F

    text = "SAKQJT98765432HDC" "SHAKQJT98765432DC" "SHDAKQJT98765432C" "SHDCAKQJT98765432"
    df = spark.createDataFrame([(1, 1, text), (1, 2, text.replace("A", "K", 1)), (2, 1, None)], "hand_record_id int, board int, board_record_string string")
    df = df.withColumns({"double_dummy_ns": F.lit("NS: 3S 4H D2 1C NT"), "double_dummy_ew": F.lit("EW: S1 H2 D C NT3"), "par": F.lit("Par: 0")})
    out = R.clean_deals(df)
    assert [r["hand_record_id"] for r in out.collect()] == [1]
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    from resultlake.functions import columns as X

    plan = df.select(X.canonical_deal("board_record_string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("board_record_string") < 10 and len(plan) < 5_000
