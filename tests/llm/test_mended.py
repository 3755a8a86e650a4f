"""Writers that die, repeated ids and huge texts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from resultlake.llm import exact_dedup, toxicity
from resultlake.llm.sharding import ShardedTable


@pytest.mark.parametrize("left", ["", "{", '{"token": "a-x"', '{"token": "a-x", "schema": 1}', "\x00\x03a-x"])
def test_commit_files_of_dead_writers(spark, tmp_path, left):
    """Neither an empty nor a half-written commit file is a version, and none stops what comes after it."""
    table = ShardedTable(spark, str(tmp_path / "t"), unit=1, target=1 << 30)
    rows = spark.createDataFrame([(i, "x") for i in range(10)], "doc_id long, text string").repartition(3)
    assert table.append(rows) == 1
    (tmp_path / "t" / "commits" / "00000002").write_text(left)
    (tmp_path / "t" / "commits" / ".00000003-abc").write_text(left)
    assert table.version() == 1 and table.read().count() == 10 and table.manifest().count() == 3
    assert table.append(rows) == 3 and table.read().count() == 20
    assert table.compact() == 4 and table.read().count() == 20 and table.manifest().count() == 1
    (tmp_path / "t" / "commits" / "00000005").write_text(left)
    table.vacuum()
    assert table.read().count() == 20 and table.read(4).count() == 20


def toxic_rows(spark, copies):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        text = " ".join(rng.choice(["vilest", "grumbol"] if bad and rng.random() < 0.4 else ["calm", "river", "stone", "cloud"]) for _ in range(30))
        docs += [(i, text)] * (copies if i == 6 else 1)
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_copies_of_a_labelled_row_are_learned_once(spark):
    """A labelled id with very many copies neither grows the driver's list nor moves the fit."""
    one = {r["doc_id"]: r["score"] for r in toxicity.toxicity(*toxic_rows(spark, 1)).collect()}
    many = {r["doc_id"]: r["score"] for r in toxicity.toxicity(*toxic_rows(spark, 5_000)).collect()}
    assert one == many


def test_the_cap_on_learned_texts_holds(spark, monkeypatch):
    docs, labels = toxic_rows(spark, 1)
    more = docs.unionByName(spark.createDataFrame([(6, f"another text of one id {i}") for i in range(100)], docs.schema))
    seen = []
    was = toxicity.learn_terms
    monkeypatch.setattr(toxicity, "learn_terms", lambda train: seen.append(train.count()) or was(train))
    toxicity.toxicity(more, labels, max_train=3).collect()
    assert seen == [3]


def test_weights_of_a_fit_are_counts():
    rng = np.random.default_rng(1)
    x, y, n = rng.normal(size=(40, 3)), (rng.random(40) < 0.5).astype(float), rng.integers(1, 6, 40).astype(float)
    long = np.repeat(np.arange(40), n.astype(int))
    assert np.allclose(toxicity.fit(x, y, n), toxicity.fit(x[long], y[long], np.ones(len(long))), atol=1e-6)


def test_huge_texts_take_little_more_than_their_bytes():
    text = np.random.default_rng(2).integers(32, 127, 64 << 20).astype(np.uint8)
    offsets = np.array([0, len(text)])
    tracemalloc.start()
    data, at = exact_dedup.squeezed(text, offsets)
    made = exact_dedup.fingerprints(data, at)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
    cut = len(data) // 3  # the same as from two chunks
    left, right = (exact_dedup.fingerprints(part, np.array([0, len(part)])) for part in (data[:cut], data[cut:]))
    for p, a, b, whole in zip(exact_dedup.PRIMES, left, right, made):
        assert (int(a[0]) * pow(exact_dedup.BASE, len(data) - cut, p) + int(b[0])) % p == whole[0]


def test_a_huge_text_and_its_copies(spark):
    long = "many words of a long text. " * 700_000  # over HUGE_CHARS
    rows = [(1, long), (2, long + " "), (3, long[:-2] + "?"), (4, "short"), (5, long)]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (2, 3), 2: (2, 3), 5: (2, 3), 3: (3, 1), 4: (4, 1)}


def test_flags_are_counted_by_text():
    flags = np.array([1, 0, 1, 1, 0, 1], bool)
    assert exact_dedup.counted(flags, np.array([0, 0, 3, 3, 6, 6])).tolist() == [0, 2, 0, 2, 0]
    assert exact_dedup.counted(np.zeros(0, bool), np.array([0, 0])).tolist() == [0] and len(pa.array([])) == 0


def family(n, seed=1):
    """Texts of one template: 60 common words and 12 of their own, none linked with another."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(60)]
    return [(i, " ".join(common + [f"x{rng.randrange(10**9)}" for _ in range(12)])) for i in range(n)]


def test_a_template_is_no_square_of_its_texts(spark, monkeypatch):
    """Texts of one template are compared only where a rare shingle is common to them."""
    from resultlake.llm import near_dedup

    monkeypatch.setattr(near_dedup, "WORK", 1 << 10)
    compared = []
    was = near_dedup.prefix_cells

    def counted_cells(*a):
        out = was(*a)
        compared.append(out.groupBy("cell").count().filter("count > 1").count())
        return out

    monkeypatch.setattr(near_dedup, "prefix_cells", counted_cells)
    rows = family(400)
    rows += [(1000 + i, t.replace("c3 ", "")) for i, t in rows[:20]]  # linked with the first ones
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - 1000 if i >= 1000 else i for i, _ in rows}
    assert compared and compared[0] < 1_000


@pytest.mark.parametrize("percent", [80, 85])
def test_prefixes_keep_every_link(spark, percent):
    """Sets that are similar enough have a cell in common, whatever they are."""
    from resultlake.llm import near_dedup

    rng = random.Random(percent)
    sets = []
    for _ in range(40):
        base = rng.sample(range(300), rng.randint(1, 60))
        for _ in range(3):
            sets.append(sorted(set(base) - set(rng.sample(base, rng.randint(0, len(base) // 8))) | set(rng.sample(range(300), rng.randint(0, len(base) // 8)))) or [1])
    rows = [(str(i).encode(), str(i).encode(), np.array(x, np.uint64).tobytes()) for i, x in enumerate(sets)]
    df = spark.createDataFrame(rows, "sid binary, comp binary, members binary")
    cells = {}
    for r in near_dedup.prefix_cells(df.select("sid", "comp"), df.select("sid", "members"), percent).collect():
        cells.setdefault(int(bytes(r["sid"])), set()).add(r["cell"])
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            common = len(set(x) & set(y))
            if 100 * common >= percent * (len(x) + len(y) - common):
                assert cells.get(i, set()) & cells.get(j, set())


def test_tags_and_short_notices(spark):
    from resultlake.llm.licenses import license_spans, summary

    texts = ["CC0 1.0 Universal", "// SPDX-License-Identifier: BSD-3-Clause", "Boost Software License, Version 1.0", "Eclipse Public License v2.0", "SPDX-License-Identifier: MIT", "identifier of an spdx license", "a universal cc0"]
    got = {r["doc_id"]: r["labels"] for r in summary(license_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    assert [got[i] for i in range(len(texts))] == ["cc0-1.0", "bsd-3-clause", "bsl-1.0", "epl-2.0", "mit", "", ""]


def test_pairs_just_below_the_threshold_are_no_rows(spark, monkeypatch):
    """Texts of 0.78 with each other pass the signatures, two for two; only links leave their blocks."""
    from resultlake.llm import near_dedup

    common = [f"c{i}" for i in range(88)]
    rows = [(i, " ".join(common + [f"x{i}-{k}" for k in range(12)])) for i in range(150)]
    rows += [(1000 + i, t + " more") for i, t in rows[:20]]  # linked with the first ones
    seen = spark.sparkContext.accumulator(0)
    was = near_dedup._verify

    def counted(percent):
        run = was(percent)

        def each(it):
            for b in it:
                seen.add(b.num_rows)
                yield b

        return lambda it: run(each(it))

    monkeypatch.setattr(near_dedup, "_verify", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block, shingles in ((512, 1 << 20), (40, 1000)):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", shingles, raising=False)
        got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(df).collect()}
        assert got == {i: i - 1000 if i >= 1000 else i for i, _ in rows}
        assert seen.value < 10 * len(rows)


def test_a_batch_is_coded_in_small_steps():
    """What a batch of 4 MB takes is that of a step, not thirty times the batch."""
    import public_tokenizers

    from resultlake.llm import bpe

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        own = bpe.Vocabulary(f.read())
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopé", k=rng.randint(3, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=1000)) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    list(bpe._coded(own, [batch.slice(0, 1)]))
    tracemalloc.start()
    n = sum(sum(b.column("n_tokens").to_pylist()) for b in bpe._coded(own, [batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ids, counts = own.encode(batch.column("text"))
    assert n == len(ids) == counts.sum() and peak < 100 << 20, peak
