"""Language identification against a plain coder, and on texts of the tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from resultlake.llm import batches, language_id
from resultlake.llm.queries import QUERIES
from resultlake.llm.toxicity import held_out


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())


def plain_counts(texts, order):
    """{context: counts of what follows}."""
    out = defaultdict(Counter)
    for t in map(lower, texts):
        for i, b in enumerate(t):
            for k in range(min(order, i) + 1):
                out[t[i - k : i]][b] += 1
    return out


def plain_bits(counts, text, order):
    """PPM with escape method C and exclusion, byte by byte."""
    total, t = 0.0, lower(text)
    for i, b in enumerate(t):
        known = next(k for k in range(min(order, i), -1, -1) if t[i - k : i] in counts)
        out = set()
        for k in range(known, -1, -1):
            left = {x: n for x, n in counts[t[i - k : i]].items() if x not in out}
            whole = sum(left.values()) + len(left)
            if b in left:
                total -= math.log2(left[b] / whole)
                break
            if left:
                total -= math.log2(len(left) / whole)
            out |= set(left)
        else:
            total += math.log2(256 - len(out))
    return total


def model_of(samples, order):
    parts = [language_id.gram_counts(*batches.buffer(pa.array(s)), order) for s in samples]
    keys = np.unique(np.concatenate([k for k, _ in parts]))
    counts = np.zeros((len(keys), len(samples)), np.int64)
    for j, (k, n) in enumerate(parts):
        counts[np.searchsorted(keys, k), j] = n
    return language_id.Model(keys, counts, order)


WORDS = st.text(alphabet=st.sampled_from("abcAB \x00é🙂"), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(WORDS, min_size=1, max_size=4).filter(lambda s: any(s)), min_size=1, max_size=3), st.lists(WORDS, max_size=5), st.integers(1, 5))
def test_code_lengths_are_those_of_a_plain_coder(samples, texts, order):
    got = model_of(samples, order).bits(*batches.buffer(pa.array(texts, pa.string())))
    for j, s in enumerate(samples):
        counts = plain_counts(s, order)
        for i, t in enumerate(texts):
            assert got[i, j] / language_id.UNIT == pytest.approx(plain_bits(counts, t, order), abs=1e-3)


def test_tables_find_every_key_and_no_other():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(1, 1 << 62, 20_000, dtype=np.uint64))
    table = language_id.Table(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(rng.integers(1, 1 << 62, 20_000, dtype=np.uint64), keys)
    assert (table.find(other) == -1).all()


def rows(spark, some):
    return spark.createDataFrame([(*r, "clash", 1.0) for r in some], "doc_id long, text string, lang string, bits string, score double")


def test_awkward_rows(spark):
    some = [(i, "the cat and the dog", "en") for i in range(20)] + [(100 + i, "le chat et le chien", "fr") for i in range(20)]
    some += [(None, "le chat", None), (None, "the dog", "en"), (200, None, "en"), (201, "", "fr"), (202, "12 34!", None), (7, "THE DOG", "xx"), (203, "chien " * 200_000, None)]
    some += [(300, "the chat", None)] * 3
    got = [tuple(r) for r in language_id.identify(rows(spark, some)).collect()]
    assert len(got) == len(some)
    by = defaultdict(list)
    for r in got:
        by[r[0]].append(r)
    assert {r[2] for i in range(20) for r in by[i] if i != 7} == {"en"} and by[100][0][2] == "fr" and by[203][0][2] == "fr"
    assert sorted(r[2] for r in by[None]) == ["en", "fr"] and all(r[1] for r in by[None])
    assert all(by[i][0][2:] == ("und", 0.0, None) for i in (200, 201, 202))
    assert len(set(by[300])) == 1 and len(by[300]) == 3
    assert all(0 <= r[3] <= 1 for r in got)


def test_nothing_to_learn_from(spark):
    assert language_id.identify(rows(spark, [])).count() == 0
    got = language_id.identify(rows(spark, [(1, "a b", None), (None, "a", "en")])).collect()
    assert {r["lang_pred"] for r in got} == {"und"}


def test_the_sample_is_bounded(spark):
    some = [(i, f"{i} words " * (1 + i % 7), "en" if i % 3 else "fr") for i in range(600)] + [(1, "copies", "en")] * 500
    base = rows(spark, some)
    taken = language_id.sample(base, rows=30, size=400).collect()
    by = defaultdict(list)
    for r in taken:
        by[r["lang"]].append(r["text"])
    learnt = {r["text"] for r in base.filter(~held_out(base.doc_id)).collect()}
    assert set(by) == {"en", "fr"}
    for texts in by.values():
        assert len(texts) == len(set(texts)) <= 30 and sum(map(len, texts)) <= 400 and set(texts) <= learnt
    assert [r["text"] for r in language_id.sample(rows(spark, [(1, "long " * 99, "en")]), size=10).collect()] == ["long " * 99]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    got = QUERIES["op11_language_id"](spark, sf).join(truth, "doc_id").filter("held_out AND lang IS NOT NULL AND length(text) > 20").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in got)
    assert len(got) > 100 and right / len(got) > 0.97


def test_values_do_not_depend_on_batches():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randint(0, 60))) for _ in range(50)]
    model = model_of([texts[:10], texts[10:30]], 4)
    whole = model.bits(*batches.buffer(pa.array(texts)))
    for i, t in enumerate(texts):
        assert (model.bits(*batches.buffer(pa.array([t]))) == whole[i]).all()
