"""Brute-force checks of the operators that compare documents with each other, and of the pipeline."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from resultlake.llm import exact_dedup, graph, mixing, near_dedup, scratch, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, sid int"


def docs(spark, rows):
    """(doc_id, text, source) with columns of clashing names."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "k", 1, 2) for i, t, s in rows], DOCS)


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    return sorted(((i, min(groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")])[3], len(groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")])) for i, t, _ in rows), key=str)


ROWS = [(1, "a b", "s"), (2, "ab", "s"), (3, "a  b", "s"), (4, "", "s"), (5, None, "s"), (6, " \n", "s"), (7, "ba", "s"), (8, "é é", None), (9, "éé ", "s"), (9, "éé ", "s"), (None, "ab", "s"), (10, "ab ", "s"), (11, "x" * 9000, "s"), (12, "x" * 4096 + " " + "x" * 4904, "s"), (13, "x" * 8999 + "y", "s")]


def test_exact_dedup(spark):
    got = exact_dedup.exact_dedup(docs(spark, ROWS)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=str) == brute_exact(ROWS)
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


def test_equal_fingerprints_of_different_texts_are_told_apart(spark):
    got = exact_dedup.exact_dedup(docs(spark, ROWS), primes=(2, 2)).collect()
    assert exact_dedup.collisions(docs(spark, ROWS), primes=(2, 2)).count() > 0
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=str) == brute_exact(ROWS)


def test_only_repeated_fingerprints_move(spark, monkeypatch):
    rows = exact_dedup.fingerprint(docs(spark, ROWS))
    several = rows.groupBy("fp1", "fp2", "n_bytes").agg(F.count("*").alias("n")).filter("n > 1")
    bitmap = exact_dedup.repeated(several)
    assert sum(bin(int(w)).count("1") for w in bitmap) == several.count() > 2
    monkeypatch.setattr(exact_dedup, "LEAST_POWER", 5)
    monkeypatch.setattr(exact_dedup, "MOST_POWER", 5)  # every text shares a bit with another
    assert exact_dedup.collisions(docs(spark, ROWS), primes=(2, 2), among=several).count() >= 0
    got = exact_dedup.exact_dedup(docs(spark, ROWS), primes=(2, 2)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=str) == brute_exact(ROWS)


def test_chunks_of_huge_documents_combine(spark, monkeypatch):
    rows = [(i, "".join(random.Random(i % 3).choice("ab é\n") for _ in range(4000)), "s") for i in range(6)] + [(9, "short", "s"), (10, None, "s")]
    whole = sorted(tuple(r) for r in exact_dedup.fingerprint(docs(spark, rows)).collect())
    monkeypatch.setattr(exact_dedup, "HUGE_CHARS", 100)
    monkeypatch.setattr(exact_dedup, "CHUNK_CHARS", 700)
    assert sorted(tuple(r) for r in exact_dedup.fingerprint(docs(spark, rows)).collect()) == whole


def shingle_set(text, width=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_near(rows, percent=80):
    sets = [shingle_set(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    out = []
    for i, r in enumerate(rows):
        own = [x for x in least[find(i)] if x is not None]
        comp = min(own) if own else None
        out.append((r[0], len(sets[i]), comp))
    return sorted(out, key=str)


def varied(seed, base, changes, rng_words):
    rng = random.Random(seed)
    w = list(base)
    for _ in range(changes):
        w[rng.randrange(len(w))] = rng.choice(rng_words) + str(rng.randrange(10**6))
    return " ".join(w)


def near_rows():
    vocab = [f"w{i}" for i in range(400)]
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(60, 200))]
        rows += [(len(rows) + k, varied(g * 100 + k, base, rng.choice([0, 0, 1, 2, 3, 6]), vocab), "s") for k in range(rng.randint(1, 9))]
    big = [rng.choice(vocab) for _ in range(150)]
    start = len(rows)
    rows += [(start + k, varied(9000 + k, big, k % 6, vocab), "s") for k in range(60)]
    rows += [(1000, "", "s"), (1001, None, "s"), (1002, "One two", "s"), (1003, "one  TWO", "s"), (1004, "one two three", "s"), (1005, " \t", "s"), (2, rows[30][1], "s"), (2, rows[2][1], "s"), (None, rows[5][1], "s"), (1006, "a b c d e " * 400, "s")]
    return rows


def test_near_dedup(spark, monkeypatch):
    rows = near_rows()
    want = brute_near(rows)
    got = near_dedup.near_dedup(docs(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    monkeypatch.setattr(near_dedup, "BLOCK", 7)  # several blocks of one bucket
    monkeypatch.setattr(near_dedup, "WORK", 3)  # buckets banded again
    got = near_dedup.near_dedup(docs(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == want
    assert near_dedup.near_dedup(docs(spark, [])).count() == 0


def test_one_band_of_many_unrelated_sets(spark, monkeypatch):
    """A bucket that all share, of sets that hardly anything links: cells take the place of all pairs."""
    vocab = [f"w{i}" for i in range(3000)]
    rng = random.Random(6)
    rows = []
    for g in range(30):
        base = [rng.choice(vocab) for _ in range(80)]
        rows += [(2 * g + k, varied(g * 7 + k, base, k, vocab), "s") for k in range(2)]
    one = near_dedup.signatures

    def same_first_band(hashed, counts):
        sig, keys = one(hashed, counts)
        keys[:, 0] = 1
        return sig, keys

    monkeypatch.setattr(near_dedup, "signatures", same_first_band)
    want = brute_near(rows)
    for work in (1 << 20, 10):
        monkeypatch.setattr(near_dedup, "WORK", work)
        got = near_dedup.near_dedup(docs(spark, rows)).collect()
        assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == want


def test_pruning_bounds():
    for threshold in (0.8, 0.85):
        least = near_dedup.least_matches(threshold, 1e-4)
        assert len(least) == near_dedup.HASHES // near_dedup.BATCH and (least[1:] > least[:-1]).all()
        # at the threshold itself all batches together drop a pair with the miss probability at most
        assert near_dedup.missed(threshold, least.tolist()) <= 1e-4
        rng = random.Random(1)
        runs = [[sum(rng.random() < threshold for _ in range(near_dedup.BATCH)) for _ in least] for _ in range(2000)]
        assert sum(any(sum(r[: i + 1]) < m for i, m in enumerate(least)) for r in runs) <= 3
        # unrelated pairs go with the first batch
        assert least[0] > 8


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(60) if i != 30] + [("x", "y")], "a string, b string")
    got = {r["sid"]: r["comp"] for r in graph.components(links).collect()}
    assert {got[f"{i:03d}"] for i in range(31)} == {"000"} and {got[f"{i:03d}"] for i in range(31, 61)} == {"031"} and got["y"] == "x"
    assert graph.components(links.limit(0)).count() == 0


def brute_targets(sizes, weights, share=1.5, epochs=2):
    target = {s: 0.0 for s in sizes}
    left, open_ = share * sum(sizes.values()), set(sizes)
    while left > 1e-9 and open_:
        total = sum(weights[s] for s in open_)
        give = {s: left * weights[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += give[s]
            if target[s] >= epochs * sizes[s]:
                left += target[s] - epochs * sizes[s]
                target[s] = float(epochs * sizes[s])
                open_.discard(s)
    return target


@pytest.mark.parametrize("bucket", [3, 5000])
def test_mixing(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 40)), rng.choice(["b", "a", "c", "d", None])) for i in range(300)] + [(300, "", "a"), (301, None, "e"), (302, "x y", "e")]
    got = {r["doc_id"]: r for r in mixing.mix(docs(spark, rows)).collect()}
    size = {i: len((t or "").split()) for i, t, _ in rows}
    sizes = defaultdict(int)
    for i, _, s in rows:
        sizes[s] += size[i]
    order = sorted((s for s in sizes if s is not None)) + [None]
    targets = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = defaultdict(int)
    for i, _, s in rows:
        r = got[i]
        assert r["size"] == size[i] and r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        assert r["taken"] == r["size"] * r["repeats"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= max(size[i] for i, _, x in rows if x == s) / 2 + 1e-6
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs(spark, rows).repartition(7)).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}
    assert mixing.mix(docs(spark, [])).count() == 0


def test_sharding(spark, tmp_path):
    root = str(tmp_path / "table")
    df = spark.range(4000).withColumns({"text": F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit("é")), "shard": F.lit(None).cast("string")})
    df = df.withColumn("text", F.when(F.col("id") % 50 > 0, F.col("text")))
    table = sharding.ShardedTable(spark, root, unit=1 << 10, target=60_000)
    assert table.version() == 0 and table.manifest().count() == 0
    table.append(df.filter("id < 2000").repartition(12))
    table.append(df.filter("id >= 2000 AND id < 2100").repartition(3))
    assert table.append(df.filter("id >= 2100").repartition(6)) == 3
    before = {r["path"]: r for r in table.manifest().collect()}
    assert len(before) == 21 and sum(r["rows"] for r in before.values()) == 4000
    plan = defaultdict(list)
    for r in table.plan().collect():
        plan[r["run"]].append(before[r["path"]])
    assert table.compact() == 4
    live = table.manifest().collect()
    merged = sorted(r["rows"] for r in live if r["written"] == 4)
    assert merged == sorted(sum(x["rows"] for x in run) for run in plan.values())
    for run in plan.values():
        assert len(run) > 1 and len({x["tier"] for x in run}) == 1
        assert sum(x["bytes"] for x in run) <= 60_000 + max(x["bytes"] for x in run)
    assert {r["path"] for r in live if r["written"] < 4} == set(before) - {x["path"] for run in plan.values() for x in run}
    for v in (3, 4):
        assert table.read(v).select("id", "text").exceptAll(df.select("id", "text")).count() == 0 and table.read(v).count() == 4000
    other = sharding.ShardedTable(spark, root)
    with pytest.raises(sharding.CommitConflict):
        other._commit(4, other.manifest(), "late", df.schema)
    assert table.version() == 4
    table.vacuum(keep=1)
    assert table.read().count() == 4000 and table.read().filter("text IS NULL").count() == 80
    tiers = spark.range(6).select(sharding.tier_of(F.element_at(F.array(*map(F.lit, (0, 9, 10, 19, 20, 40))), F.col("id").cast("int") + 1), 10)).collect()
    assert [r[0] for r in tiers] == [0, 0, 1, 1, 2, 3]


def test_shards_of_an_empty_arrival(spark, tmp_path):
    table = sharding.ShardedTable(spark, str(tmp_path / "t"))
    table.append(spark.range(0))
    table.append(spark.range(5).coalesce(1))
    assert table.read().count() == 5 and table.compact() in (2, 3)
    assert table.read().count() == 5


def test_shards_of_clashing_columns_and_empty_tables(spark, tmp_path, monkeypatch):
    names = ["__path", "__run", "__shard", "_metadata", "path", "run", "bytes"]
    df = spark.range(300).select(F.col("id").alias("doc_id"), *[F.concat(F.lit(n), F.col("id")).alias(n) for n in names])
    monkeypatch.setattr(sharding, "WAVE", 2)  # several jobs for one compaction
    table = sharding.ShardedTable(spark, str(tmp_path / "t"), unit=64, target=6_000)
    table.append(df.filter("doc_id < 200").repartition(9))
    table.append(df.filter("doc_id >= 200").repartition(4).select(*reversed(df.columns)))
    with pytest.raises(ValueError):
        table.append(spark.range(3))
    runs = table.plan().select("run").distinct().count()
    assert runs > 2 and table.compact() == 3
    assert table.manifest().filter("written = 3").count() == runs
    assert table.read().exceptAll(df).count() == 0 and table.read().count() == 300
    shown = table.read(shard_col="shard")
    assert shown.columns == [*df.columns, "shard"] and shown.groupBy("shard.path").agg((F.count("*") != F.max("shard.rows")).alias("off")).filter("off").count() == 0
    with pytest.raises(ValueError):
        table.read(shard_col="__SHARD")
    none = sharding.ShardedTable(spark, str(tmp_path / "n"))
    none.append(df.limit(0))
    assert none.compact() == 1 and none.read(shard_col="s").columns == [*df.columns, "s"] and none.read().count() == 0


def test_partly_dead_writes_give_only_live_rows(spark, tmp_path):
    table = sharding.ShardedTable(spark, str(tmp_path / "t"), unit=64, target=3_000)
    wide = spark.range(2000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    # one large shard that stays and small ones that are merged
    table.append(wide.filter("id < 1900").coalesce(1).union(wide.filter("id >= 1900").repartition(4)))
    table.compact()
    assert table.read().exceptAll(wide).count() == 0 and table.read().count() == 2000
    assert {w for _, w in table._folders(table.manifest())} == {True, False}


@pytest.mark.parametrize("rows", [[], [(None, None, None), (1, "é x", "s"), (1, "é x", "s"), (4, "", None), (8, "long " * 100_000, "t")]])
def test_sharding_query(spark, tmp_path, rows):
    """The registered query gives each row back, for awkward rows and columns too."""
    import hashlib

    from resultlake.llm import queries

    made = docs(spark, rows).withColumns({"__shard": F.lit("a"), "shard": F.lit(1), "__path": F.lit("b"), "tier": F.lit("c")})
    made.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op2_sharding"](spark, str(tmp_path)).collect()
    want = [(i, s, len((t or "").encode()), t if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, t, s in rows]
    assert sorted(((r["doc_id"], r["source"], r["n_bytes"], r["text_sha256"]) for r in got), key=str) == sorted(want, key=str)


SF = "/root/testdata/sf0.001"


def test_near_stage_links_from_80_percent_on(spark):
    words = [f"w{i}" for i in range(104)]  # 100 shingles
    rows = [(1, " ".join(words), "s"), (2, " ".join(words[:94] + [f"x{i}" for i in range(10)]), "s"), (3, " ".join(f"y{i}" for i in range(50)), "s")]
    rows += [(i + 10, t, s) for i, (_, t, s) in enumerate(near_rows())]
    sets = [shingle_set(t) for _, t, _ in rows[:2]]
    assert 0.80 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.85
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near(spark, docs(spark, rows), SF).collect())
    assert kept == sorted(i for i, _, c in brute_near(rows, 80) if i == c) and 2 not in kept


def test_pipeline_stages(spark):
    """Each stage against brute force on what the stage before it kept."""
    at = spark.read.parquet(f"{SF}/documents.parquet")
    all_ids = {r["doc_id"] for r in at.select("doc_id").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = at
        at = scratch.stored(stage(spark, at, SF), f"test-{name}")
        if name != "bpe":
            assert at.columns == corpus_pipeline.COLUMNS
    data = {n: [(r["doc_id"], r["text"], r["source"]) for r in d.collect()] for n, d in seen.items()}
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    kept = {i for i, _, _ in data["exact_dedup"]}
    assert len(all_ids - kept - toxic) <= 0.02 * len(all_ids) and len((toxic & all_ids) - kept) >= 0.5 * len(toxic & all_ids)
    assert {i for i, _, _ in data["near_dedup"]} == {i for i, k, _ in brute_exact(data["exact_dedup"]) if i == k}
    assert {i for i, _, _ in data["mixing"]} == {i for i, _, c in brute_near(data["near_dedup"]) if i == c}
    repeats = {r["doc_id"]: r["repeats"] for r in mixing.mix(seen["mixing"]).collect()}
    got = defaultdict(int)
    for i, t, _ in data["bpe"]:
        got[i] += 1
    assert dict(got) == {i: n for i, n in repeats.items() if n}
    import hashlib

    texts = {i: t for i, t, _ in data["bpe"]}
    out = at.collect()
    assert len(out) == len(data["bpe"]) and all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in out)


def test_pipeline_on_awkward_rows(spark, tmp_path):
    rows = [(1, None, None), (2, "", "s"), (None, "x y", "s"), (3, "x y", "s"), (3, "x y", "s"), (4, "long " * 5000, "s")]
    docs(spark, rows).select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= {1, 2, 3, 4, None} and 4 in {r["doc_id"] for r in out}


def test_stages_decide_by_row(spark, tmp_path):
    """Null and repeated ids: what is decided of one row holds for no other."""
    rng = random.Random(8)
    text = [" ".join(rng.choice("abcdefghijklmnop") * 3 + str(rng.randrange(900)) for _ in range(40)) for _ in range(6)]
    near = text[3] + " more"
    rows = [(None, text[0], "s"), (None, text[1], "s"), (None, text[1], "t"), (None, text[1], "t"), (7, text[2], "s"), (7, text[3], "s"), (7, text[3], "s"), (None, near, "s"), (8, text[4], "s"), (8, text[2], "s"), (9, "a", "s"), (9, "a", "s")]
    got = sorted(r["text"] for r in corpus_pipeline.exact(spark, docs(spark, rows), SF).collect())
    assert got == sorted({t for _, t, _ in rows})
    got = sorted(r["text"] for r in corpus_pipeline.near(spark, docs(spark, rows), SF).collect())
    assert got == sorted({t for _, t, _ in rows} - {near})
    some = [(None, near, "s"), (None, text[3], "s"), (5, text[0], "s"), (5, None, "s")]
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near(spark, docs(spark, some), SF).collect()]
    assert len(got) == 3 and (5, text[0]) in got and (5, None) in got


def test_toxic_rows_of_repeated_ids_go_alone(spark, tmp_path):
    clean = [(i, f"a calm note number {i} about rivers", "s") for i in range(60)]
    bad = [(100 + i, f"you vilewordish thing number {i} about rivers", "s") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, int(i >= 100)) for i, _, _ in clean + bad], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    worse = "you vilewordish thing number 7 about"
    odd = [(None, "a calm walk", "s"), (500, "a calm river", "s"), (None, f"{worse} walks", "s"), (500, f"{worse} lakes", "s")]
    got = corpus_pipeline.toxicity(spark, docs(spark, clean + bad + odd), str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(i, t) for i, t, _ in clean + odd[:2]], key=str)


def test_mix_stage_takes_each_row_as_the_mix_says(spark):
    rng = random.Random(3)
    rows = [(None if i % 2 else i // 6, " ".join("w" * rng.randint(1, 30)) + f" {i}", rng.choice("abc")) for i in range(120)]
    out = corpus_pipeline.mixing(spark, docs(spark, rows), SF).collect()
    words = defaultdict(int)
    for r in out:
        words[r["source"]] += len(r["text"].split())
    for r in mixing.mix(docs(spark, rows)).select("source_size", "target").distinct().collect():
        source = next(s for s in "abc" if sum(len(t.split()) for _, t, x in rows if x == s) == r["source_size"])
        assert abs(words[source] - r["target"]) <= 31


def test_rows_of_files_have_keys_without_a_copy(spark, tmp_path, monkeypatch):
    rows = [(None, "a b", "s"), (None, "c d", "s"), (4, "a b", "s"), (4, "e f", "s"), (4, "e f", "s")]
    docs(spark, rows).select(*corpus_pipeline.COLUMNS).repartition(3).write.parquet(str(tmp_path / "d.parquet"))
    read = spark.read.parquet(str(tmp_path / "d.parquet"))
    assert sorted(r["text"] for r in corpus_pipeline.exact(spark, read, SF).collect()) == ["a b", "c d", "e f"]
    monkeypatch.setattr(corpus_pipeline, "stored", None)
    assert corpus_pipeline.keyed(read).select(corpus_pipeline.ROW).distinct().count() == 5
