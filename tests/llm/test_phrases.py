"""Phrases against counting every run of words."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from resultlake.llm import phrases
from resultlake.llm.queries import ORACLE_SQL, QUERIES


def brute(rows, least, longest=5, top=2000):
    """{lang: [(phrase, a, l, r, n, score, cut)]}."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                inside |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= 100 * f[p[i : i + k]]}
        scored = []
        for p, a in cand.items():
            if p not in inside:
                score, cut = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((" ".join(p), a, f[p[:cut]], f[p[cut:]], total[lang], score, cut))
        scored.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        if scored:
            out[lang] = scored[:top]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, "clash", 7) for lang, text in rows], "lang string, text string, phrase string, n long")


def check(spark, rows, least, **more):
    got = defaultdict(list)
    for r in phrases.collocations(frame(spark, rows), least, **more).orderBy("lang", "rank").collect():
        assert r["rank"] == len(got[r["lang"]]) + 1
        got[r["lang"]].append((r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"], r["cut"]))
    assert dict(got) == brute(rows, least, **more)
    return got


def some_rows(seed, n):
    rng = random.Random(seed)
    words = ["The", "the", "a", "é", "𝒳", "ﬀ", "\x00x", "of it", "x", "y", "zz", *(f"w{i}" for i in range(40))]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[: rng.choice((4, 12, 51))]) + rng.choice((" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b", "; ")) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(("en", "en", "en", "de", None, "a b")), text))
    return rows + [("en", "in the best of all worlds we live in the best of all worlds")] * 30


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_counting(spark, monkeypatch, seed, hot):
    if hot:  # every leading pair of words is dealt over tasks
        monkeypatch.setattr(phrases, "HOT_ROWS", 0)
        monkeypatch.setattr(phrases, "HOT_KEYS", 1 << 40)
    monkeypatch.setattr(phrases, "CHUNK", 50)
    got = check(spark, some_rows(seed, 400), 12)
    assert any(len(p[0].split(" ")) == 5 for p in got["en"])


def test_few_are_returned_and_ties_go_by_bytes(spark):
    rows = [("en", "b c. a b. ﬀ 𝒳. é b")] * 5 + [("en", "b b b b b b b")] * 3
    got = check(spark, rows, 3, top=4)
    assert len(got["en"]) == 4
    check(spark, rows, 3, longest=3)


def test_awkward_rows(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(None, None), ("en", ""), ("en", " .;\n"), ("de", "one")])).count() == 0
    long = "so it goes " * 150_000
    check(spark, [("en", long), ("en", long), (None, "so it goes"), ("en", None), ("en", "so " + "x" * 2_000_000 + " it")], 100)


def test_products_over_64_bits(spark):
    """Scores are exact where 1000 * a * n is not a 64-bit integer."""
    made = spark.createDataFrame([(3_000_000_019, 9_007_199_254_740_993, 5_000_000_029, 4_000_000_007)], "a long, n long, l long, r long")
    cast = made.selectExpr("(1000BD * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(15,0))) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0))) AS score")
    with pytest.raises(Exception):  # n is over 15 digits: an error, never a wrong score
        cast.collect()
    a, n, part, rest = 3_000_000_019, 900_719_925_474_099, 5_000_000_029, 4_000_000_007
    made = spark.createDataFrame([(a, n, part, rest)], "a long, n long, l long, r long")
    cast = made.selectExpr("(1000BD * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(15,0))) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0))) AS score")
    assert cast.first()[0] == 1000 * a * n // (part * rest)


def test_quicksort_abandons_and_counts():
    rng = np.random.default_rng(4)
    keys = rng.integers(-1, 4, (3000, 4)).astype(np.int32)
    for r in keys:  # -1 only at the end
        gone = np.flatnonzero(r == -1)
        if len(gone):
            r[gone[0] :] = -1
    weight = rng.integers(1, 5, 3000)
    want = Counter()
    for r, w in zip(keys.tolist(), weight.tolist()):
        for k in range(1, 5):
            if r[k - 1] >= 0:
                want[tuple(r[:k])] += w
    for least in (1, 60, 10_000):
        got = {tuple(keys[row, :depth].tolist()): n for row, depth, n in phrases.quicksort(keys, weight, least, 2)}
        assert got == {p: n for p, n in want.items() if n >= least and len(p) >= 2}


def test_bitmaps_lose_nothing(spark):
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    made = phrases.bitmap(spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "h long"))
    assert made.holds(keys).all() and made.holds(rng.integers(0, 1 << 64, 5000, dtype=np.uint64)).mean() < 0.1
    assert not phrases.bitmap(spark.createDataFrame([], "h long")).holds(keys).any()


def test_same_as_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op12_phrases"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cur = con.execute(ORACLE_SQL["op12_phrases"])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(got.columns)
    want = cur.fetchall()
    assert len(want) > 50 and sorted(map(tuple, got.select(*columns).collect())) == sorted(want)
