from pyspark.sql import functions as F

from resultlake.functions import columns as X


def col(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def out(df, *cs):
    got = [tuple(r)[1:] for r in df.select("i", *cs).orderBy("i").collect()]
    return [g[0] for g in got] if len(cs) == 1 else got


def test_contract(spark):
    df = spark.createDataFrame(list(enumerate(["5 C x", "4 S xx", "3 NT", "4SX", "2 H ", "PASS"])), "i int, c string").withColumn("d", F.element_at(F.array(*map(F.lit, "SNEWNN")), F.col("i") + 1))
    assert out(df, X.normalize_contract("c", "d")) == ["5CXS", "4SXXN", "3NE", "4SXW", "2HN", "PASS"]
    assert out(df, X.contract_doubled("c")) == ["X", "XX", "", "X", "", None]
    assert out(df, X.contract_level("c")) == [5, 4, 3, 4, 2, 0]


def test_typed_result(spark):
    df = spark.createDataFrame([(0, "=", "10"), (1, "+1", "9"), (2, "-3", "8"), (3, "", ""), (4, None, None)], "i int, r string, t string")
    assert out(df, *X.typed_result("r", "t")) == [(0, 10), (1, 9), (-3, 8), (None, None), (None, None)]
    res = ["127", "107", "+6", None, "300", "-13", "+6", "="]
    tri = ["136", "116", "17", "206", "9", "0", "13", "7"]
    df = spark.createDataFrame([(i, r, t) for i, (r, t) in enumerate(zip(res, tri))], "i int, r string, t string")
    got = out(df, *X.typed_result("r", "t"))
    assert got[5:] == [(-13, 0), (6, 13), (0, 7)]
    assert got[:4] == [(None, None)] * 4


def test_total_tricks(spark):
    lv, rs, tr = [3, 3, 1, 3, 4, 0, 2, 2], [0, 0, 1, -1, 1, None, None, 1], [9, 3, 2, 2, 8, None, 8, None]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(zip(lv, rs, tr))], "i int, l int, r int, t int")
    got = out(df, *X.total_tricks("l", "r", "t"))
    assert [t for _, t in got] == [9, 9, 8, 8, None, None, 8, None]
    assert [r for r, _ in got][:5] == [0, 0, 1, -1, None]


def test_id_list(spark):
    df = col(spark, ["[3402819, 4692195]", "[1590227,Al Ober]", '["Linda F","Annette"]', '["#155","7022131"]', "[]", None])
    assert out(df, X.id_list("c")) == [["3402819", "4692195"], ["1590227"], [], ["#155", "7022131"], [], None]
    df = col(spark, ["[0, 4692195]", "[3402819,0]", '["000","7"]'])
    assert out(df, X.id_list("c")) == [[None, "4692195"], ["3402819", None], [None, "7"]]
    assert out(df, X.pad2(X.id_list("c"))) == [[None, "4692195"], ["3402819", None], [None, "7"]]
    assert out(df, X.at(X.id_list("c"), 5)) == [None] * 3


def test_leading_number_and_bool(spark):
    df = col(spark, ["2-NS", "NS", "", "15", None, "3"])
    assert out(df, X.leading_number("c")) == [2, 0, 0, 15, None, 3]
    df = col(spark, ["12.5x", None, "nope"])
    assert out(df, X.leading_number("c", "double")) == [12.5, None, 0.0]
    df = col(spark, ["1", "True", "t", "0", "FALSE", "f", "x", None])
    assert out(df, X.text_bool("c")) == [True] * 3 + [False] * 3 + [None] * 2


def test_par(spark):
    df = col(spark, ["Par: 0", "Par: +140 3H-NS/3S-NS", "Par: ", "Par: ?90 1NT-SW", "Par: -100 5S*-NS-1", None])
    got = out(df, X.parse_par("c"))
    assert got[0].score == 0 and tuple(got[0].contracts[0]) == ("", "", "", "", 0)
    assert got[1].score == 140 and [(p.Level, p.Strain, p.Pair_Direction) for p in got[1].contracts] == [("3", "H", "NS"), ("3", "S", "NS")]
    assert got[2] is None and got[3] is None and got[5] is None
    assert got[4].score == -100 and tuple(got[4].contracts[0]) == ("5", "S", "*", "NS", -1)
    sides = df.withColumn("p", X.parse_par("c"))
    assert out(sides, X.par_side("p.contracts", 1))[1] == ["H", "S"] and out(sides, X.n_distinct_field("p.contracts", "Strain"))[1] == 2


def test_text(spark):
    df = col(spark, ["1502054-2005-1", "2611003-01OP-2", "NABC163-SS02-1", "YNABC21-17Y-2", "ab-1", "x"])
    assert out(df, X.block_key("c", r"^(\d{4}|[A-Z]+\d{2})")) == ["1502", "2611", "NABC16", "YNABC21", "ab-1", "x"]
    df = col(spark, ["5", "123", None])
    assert out(df, X.zfill("c", 2)) == ["05", "123", None]
    df = col(spark, ["Smith, Ann", "Ann Smith", "Émile  Ça-va (swap names)", None])
    assert out(df, X.given_first("c"))[:2] == ["Ann Smith", "Ann Smith"]
    assert out(df, X.strip_suffix("c"))[2] == "Émile  Ça-va"
    assert out(df, X.fold_text("c"))[2] == "emile ca va swap names"
    df = col(spark, ["10 S", "sA", "Z9", "H10", None])
    assert out(df, X.clean_lead("c")) == ["ST", "SA", None, "HT", None]
    df = spark.createDataFrame([(0, "9", "10"), (1, "7", "7"), (2, None, "3")], "i int, a string, b string")
    assert out(df, X.pair_key("a", "b")) == ["10-9", None, None]
    assert out(col(spark, ["['a', \"b\"]", "[]", None]), X.name_list("c")) == [["a", "b"], [], None]


def test_deals(spark):
    suits = ["AKQJT98765432", "", "", ""]
    deal = "".join("".join(s + (suits[0] if s == "SHDC"[i] else "") for s in "SHDC") for i in range(4))
    shuffled = deal.replace("AKQJT98765432", "23456789TJQKA")
    df = col(spark, [shuffled, deal[:-1], "x" * 68, None])
    assert out(df, X.valid_deal("c")) == [True, False, False, False]
    got = out(df, X.canonical_deal("c"))
    assert got[0] == "N:AKQJT98765432... .AKQJT98765432.. ..AKQJT98765432. ...AKQJT98765432" and got[1] is None
    df = col(spark, ["NS: 7NT 7S 7H 7D 7C", "NS: 7NT 7S 7H 7D", None])
    assert out(df, X.valid_dd("c", "NS")) == [True, False, False]
    df = spark.createDataFrame([(i, i) for i in range(1, 17)], "i int, n int")
    assert out(df, X.board_vul("n")) == [0, 1, 2, 3, 1, 2, 3, 0, 2, 3, 0, 1, 3, 0, 1, 2]


def test_limits_and_dates(spark):
    df = col(spark, ["0-299", "NLM 1k", None, "Open", "<=5,000", "9000"])
    assert out(df, X.limit_bucket("c")) == ["0-299", "0-999", "open", "open", "0-4999", "open"]
    assert out(col(spark, ["0-299/300-750", "0-299/Open"]), X.limit_bucket("c", "tournament")) == ["0-749", "open"]
    df = col(spark, ["2026-10-02", "2026-10-02 13:00:00", "10/2/2026", "October 2, 2026", "soon", None])
    assert [str(d) for d in out(df, X.parse_date_any("c"))] == ["2026-10-02"] * 4 + ["None"] * 2
    assert out(df, X.in_range_or_unknown("c", "2026-11-01", None)) == [False] * 4 + [True] * 2
    got = out(col(spark, ["2026-05-20"]), *X.window_of(F.col("c").cast("date"), "month", 3))
    assert [str(d) for d in got[0]] == ["2026-04-01", "2026-07-01"]


def test_numbers(spark):
    df = col(spark, ["7", "256", "-1", "x", None])
    assert out(df, X.tolerant_cast("c", "uint8")) == [7, None, None, None, None]
    df = col(spark, ["true", "+7", "7.0", "x7", "", None])
    assert out(df, X.coerce_key("c", True)) == ["1", "7", "7", "x7", None, None]
    assert out(df, X.coerce_key("c", True, keep_nulls=False))[-2:] == ["", ""]
    df = spark.createDataFrame([(0, 1.5), (1, float("nan")), (2, float("inf")), (3, None)], "i int, c double")
    assert out(df, X.finite("c")) == [1.5, None, None, None]
    assert out(df, X.clip("c", 0.0, 1.0))[0] == 1.0
    assert out(df, X.scaled("c", 1.0, 0.5))[0] == 1.0


def test_documents(spark):
    schema = "array<struct<id:int,m:array<struct<p:string>>>>"
    df = spark.createDataFrame([(0, '[{"id":1,"m":[{"p":"a"}]}]'), (1, "[]"), (2, None)], "i int, c string").withColumn("d", F.from_json("c", schema))
    assert out(df, X.doc_has("d", ["m"], "p", F.lit("a"))) == [True, False, False]
    df = col(spark, ['{"k": 3, "n": {"z": 1}}', '{"k": "x"}', "junk", None])
    assert out(df, X.json_scalars("c", {"k": "int", "n": "string"})["k"]) == [3, None, None, None]


def test_folding_is_compatibility_decomposition(spark):
    import re
    import unicodedata

    texts = ["Dvořák Łukasz", "Ångström ½ straße", "ﬁn ǅ Ñandú", "Cafe\u0301 Ｗｉｄｅ", "ẞ İ", "", None, "日本 x1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string").select("i", X.fold_text("c").alias("f"))
    got = [r["f"] for r in df.orderBy("i").collect()]

    def want(t):
        plain = "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x))
        return re.sub(r"[^a-z0-9]+", " ", plain.casefold()).strip()

    assert got == [None if t is None else want(t) for t in texts]
