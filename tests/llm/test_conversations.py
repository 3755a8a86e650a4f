"""Repairs against a search through all edits, and against a plain reading of the rules."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from resultlake.llm import conversations as C
from resultlake.llm.queries import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?\Z")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def kinds_of(rows):
    """[(fault, must go)] of (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def search(rows):
    """(cost, audit) of the cheapest edits, trying all; rows are few."""
    faults = kinds_of(rows)
    best = [(4 * len(rows), "D" * len(rows))]

    def go(i, cost, audit, roles):
        if (cost, audit) > best[0] and cost > best[0][0] or len(roles) > 2 * len(rows) + 2:
            return
        if i == len(rows) and LEGAL.match(roles):
            best[0] = min(best[0], (cost, audit))
        for r in "ua":
            go_on = roles + r
            if re.match(r"s?(ua)*u?\Z", go_on):
                go(i, cost + 3, audit + "I", go_on)
        if i == len(rows):
            return
        go(i + 1, cost + 4, audit + "D", roles)
        if faults[i] in ("blank", "duplicate"):
            return
        more = 3 * (faults[i] == "truncated")
        for letter, role, price in (("K", rows[i][0][:1], 0), ("R", "u", 3), ("R", "a", 3)):
            if role and re.match(r"s?(ua)*u?\Z", roles + role):
                go(i + 1, cost + price + more, audit + letter, roles + role)

    go(0, 0, "", "")
    return best[0]


def viterbi(rows):
    """(cost, audit) row by row from the left, for long conversations."""
    def closed(states):
        for _ in range(3):
            for p, (c, a) in list(states.items()):
                for (x, r), q in C.STEPS.items():
                    if x == p and r in "ua" and (q not in states or (c + 3, a + "I") < states[q]):
                        states[q] = (c + 3, a + "I")
        return states

    states = closed({C.START: (0, "")})
    for (role, _), fault in zip(rows, kinds_of(rows)):
        new = {p: (c + 4, a + "D") for p, (c, a) in states.items()}
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            for p, (c, a) in states.items():
                for (x, r), q in C.STEPS.items():
                    for letter, price, able in (("K", 0, r == role[:1]), ("R", 3, r in "ua")):
                        if x == p and able:
                            new[q] = min(new.get(q, (1 << 60, "")), (c + price + more, a + letter))
        states = closed(new)
    return min(states[q] for q in (C.START, C.ASSISTANT) if q in states)


def repaired(rows, audit):
    out, roles, at = [], "", 0
    for e in audit:
        due = "assistant" if roles[-1:] == "u" else "user"
        if e == "I":
            out.append((due, ""))
        else:
            role, text = rows[at]
            at += 1
            if e == "D":
                continue
            out.append((due if e == "R" else role, text))
        roles += out[-1][0][0]
    assert at == len(rows) and LEGAL.match(roles)
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def expected(table, solve):
    """The whole contract, plainly."""
    by = defaultdict(list)
    for conv, turn, role, text in table:
        blank = lambda v: " " if v is None else v
        how = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        row = (turn is not None, turn or 0, "user" if how == 4 else role, text)
        by[conv] += [row] * (0 if how == 0 else 2 if how == 3 else 1)
    out = {}
    for conv, found in by.items():
        found.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        rows = [r[2:] for r in found]
        turns = [r[1] for r in found if r[0]]
        faults = kinds_of(rows)
        cost, audit = solve(tuple(rows))
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, repaired(rows, audit))
    return out


ROW = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "sun", " "]), st.sampled_from(["Yes.", "No", "", "\n", "Why?  "]))


@settings(max_examples=300, deadline=None)
@given(st.lists(ROW, max_size=5), st.integers(1, 4))
def test_cheapest_of_all_edits(rows, block):
    was, C.BLOCK = C.BLOCK, block
    try:
        now = C.Repair()
        for i, ((role, text), fault) in enumerate(zip(rows, kinds_of(rows))):
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            now.add(i, role, text, fault, "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
        got = now.result()
    finally:
        C.BLOCK = was
    assert got[5:7] == search(rows) == viterbi(rows)
    assert got[7] == repaired(rows, got[6])


def table(seed, conversations, longest):
    rng = random.Random(seed)
    out = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.9:
                text = rng.choice(["Right.", "ok", "What?\n", " ", "é!", "No. Yes", "x" * 50 + "."]) + rng.choice(["", "", f" {rng.randint(0, 9)}."])
                out.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), rng.choice([text, text, text, None])))
    return out + [(None, 1, "user", "Hi."), (None, 1, "assistant", "Hi."), (None, None, None, None)]


def run(spark, rows):
    made = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, gone int")
    got = [tuple(r) for r in C.repair(C.damage(made)).collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}, {r[0] for r in rows}


def whole(rows, ids, solve):
    """With conversations of which nothing is left."""
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {i: nothing for i in ids} | expected(rows, solve)


@pytest.mark.parametrize("block", [3, 16])
def test_tables(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = table(1, 120, 12)
    got, ids = run(spark, rows)
    assert got == whole(rows, ids, lru_cache(None)(viterbi))


def test_long_conversations_and_texts(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{rng.randint(0, 500)}.") for t in range(3000)]
    rows += [(2, 1, "user", "long. " * 400_000), (2, 2, "assistant", "word" * 500_000), (2, 3, "user", "a" + " " * 1_000_000)]
    got, ids = run(spark, rows)
    assert got == whole(rows, ids, viterbi)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(5, 0, "user", "Same."), (5, 0, "user", "Same."), (5, 0, "assistant", "Same.")] * 40
    got, ids = run(spark, rows)
    assert got == whole(rows, ids, viterbi)
    assert run(spark, [])[0] == {}


def test_query_on_given_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op13_conversations"](spark, sf).collect()}
    assert got == whole(rows, {r[0] for r in rows}, viterbi)
