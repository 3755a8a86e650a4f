"""MinHash near-dedup with sequential Bayesian verification.

Texts with equal shingle sets form one class, so copies cost one row each and no pairs.
Classes that share a band of their signatures are candidates. Signatures of a candidate
pair are compared batch by batch; the pair is dropped as soon as the posterior chance that
its similarity reaches the threshold is below ``miss``; survivors are verified exactly on
their full shingle sets. A bucket never emits all its pairs: a class is first held
against the most central member of its largest bucket; with what that linked contracted to
one component, members of other components than their centre's are held against it, and
those of smaller components are compared with the rest of the bucket in blocks, a task
each: what the signatures keep of a block is verified there, on sets that come once for each
member, and only links that join components leave it. Where that would be much, as in a bucket of many sets of one template, only members that share one
of their rarest shingles are compared: sets that are similar enough must (prefix filter), so
that loses no link, and what a template has in common is rare in none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm import words as W
from resultlake.llm.graph import components
from resultlake.llm.scratch import stored
from resultlake.llm.skew import facts_join

#: Hashes of a signature, each of 16 bits; rows of a band; bands. The bands use the first hashes.
HASHES, ROWS, BANDS = 256, 5, 25
#: Hashes compared at once.
BATCH = 32
#: Buckets of up to so many members emit their pairs; larger ones are compared with a centre, then in blocks.
SMALL = 6
#: Members of a block of a large bucket; comparisons in a bucket from which on only members with a rare shingle in common are compared.
BLOCK, WORK = 512, 1 << 20
#: Shingles of a block, about; one larger set is a block of its own.
BLOCK_SHINGLES = 1 << 20


def _coefficients(n: int) -> np.ndarray:
    """Odd multipliers, fixed by rule."""
    return W.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, shingles of each text) of lower-cased words; repeats are kept."""
    data, offsets = B.buffer(column)
    data = W.LOWER[data]
    starts, ends, counts = W.spans(data, offsets, W.NOT_SPACE)
    return W.grams(W.hashes(data, starts, ends), counts, width, short=True)


def signatures(hashed: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit signatures, band keys) of the texts; those of empty texts mean nothing."""
    n = len(counts)
    sig = np.zeros((n, HASHES), np.uint16)
    low = np.zeros((n, ROWS * BANDS), np.uint32)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        for j, a in enumerate(_coefficients(HASHES)):
            least = np.minimum.reduceat(((hashed * a) >> np.uint64(32)).astype(np.uint32), starts)
            sig[some, j] = W.mix(least.astype(np.uint64)).astype(np.uint16)
            if j < ROWS * BANDS:
                low[some, j] = least
    keys = np.empty((n, BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(n, b + 1, np.uint64)
        for r in range(ROWS):
            key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, b * ROWS + r].astype(np.uint64))
        keys[:, b] = key
    return sig, keys.view(np.int64)


def least_matches(threshold: float, miss: float) -> np.ndarray:
    """For each number of batches compared, the matches below which a pair is dropped.

    With a uniform prior the similarity after m matches of n is Beta(m + 1, n - m + 1);
    the pair is dropped while P(similarity >= threshold) is below a bound. The bound is
    ``miss`` at first and is halved until :func:`missed`, the chance that a pair at the
    threshold is dropped by any of the batches, is ``miss`` at most.
    """
    bound = miss
    while True:
        out = []
        for n in range(BATCH, HASHES + 1, BATCH):
            tail, m = 0.0, 0  # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
            while m <= n:
                tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
                if tail >= bound:
                    break
                m += 1
            out.append(m)
        if missed(threshold, out) <= miss:
            return np.array(out)
        bound /= 2


def missed(threshold: float, least: list[int]) -> float:
    """The chance that a pair of similarity ``threshold`` is dropped by one of the batches, by exact summation."""
    step = np.array([comb(BATCH, k) * threshold**k * (1 - threshold) ** (BATCH - k) for k in range(BATCH + 1)])
    alive = np.ones(1)
    for bound in least:
        alive = np.convolve(alive, step)
        alive[:bound] = 0
    return float(1 - alive.sum())


def survivors(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Positions of the signature pairs that no batch drops."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    for i, least_now in enumerate(least):
        cut = slice(i * BATCH, (i + 1) * BATCH)
        matches = matches + (left[alive, cut] == right[alive, cut]).sum(1, dtype=np.int32)
        keep = matches >= least_now
        alive, matches = alive[keep], matches[keep]
    return alive


def digest(members: np.ndarray) -> bytes:
    """The name of the class of texts with these shingles."""
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _sign(width: int, own_cols: list[str]):
    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "text", 2 << 20):
            hashed, counts = shingles(b.column("text"), width)
            sig, keys = signatures(hashed, counts)
            ends = np.cumsum(counts)
            size = np.zeros(len(counts), np.int64)
            sid: list[bytes | None] = []
            for i, (s, e) in enumerate(zip(ends - counts, ends)):
                own = np.unique(hashed[s:e])
                size[i] = len(own)
                sid.append(digest(own) if len(own) else None)
            bands = B.lists(keys.ravel(), np.full(len(counts), BANDS), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size), pa.array(sid, pa.binary()), B.fixed(sig), bands, *(b.column(c) for c in own_cols)], ["doc_id", "n_shingles", "sid", "sig", "bands", *own_cols])

    return run


def _sets(width: int):
    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "text"):
            hashed, counts = shingles(b.column("text"), width)
            ends = np.cumsum(counts)
            own = [x for s, e in zip(ends - counts, ends) if len(x := np.unique(hashed[s:e]))]
            if own:
                sizes = np.array([len(x) for x in own], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(map(digest, own), pa.binary()), B.binary(np.concatenate(own).view(np.uint8), np.concatenate([[0], np.cumsum(sizes * 8)]))], ["sid", "members"])

    return run


def _stack(column: pa.Array) -> np.ndarray:
    data, offsets = B.buffer(column)
    return data.view(np.uint16).reshape(len(offsets) - 1, HASHES)


def _shingle_rows(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, comp, size, shingle): a row for each shingle of a set."""
    for b in B.pieces(it, "members"):
        data, offsets = B.buffer(b.column("members"))
        sizes = np.diff(offsets) // 8
        at = pa.array(np.repeat(np.arange(b.num_rows), sizes))
        yield pa.RecordBatch.from_arrays([b.column("sid").take(at), b.column("comp").take(at), pa.array(sizes).take(at), pa.array(data.view(np.int64))], ["sid", "comp", "size", "shingle"])


def prefix_cells(some: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, sid, comp, cell): sets (sid, comp) once for each of their rarest shingles that may show a link; ``key`` is 0.

    Two sets with 100 * common >= percent * united have so many shingles in common that, in
    one order of shingles, here from the rarest on, the first few of each have one in
    common. For the larger set these are what is left of its size less percent of it, and
    one; for the smaller one fewer, as it must lie in the larger one with more of its own
    (2 * percent of 100 + percent). Cells without a set that comes as the smaller one are
    left out: that are those of what a template has in common.
    """
    rows = stored(some.join(sets, "sid").mapInArrow(_shingle_rows, "sid binary, comp binary, size long, shingle long"), "shingles")
    counts = stored(rows.groupBy("shingle").agg(F.count("*").alias("n")), "shingle-counts")
    rows = facts_join(rows, counts.select("shingle", F.col("n").alias("of")), ["shingle"], counts)
    nth = F.row_number().over(Window.partitionBy("sid").orderBy("of", "shingle"))
    larger = F.expr(f"size - (size * {percent} + 99) div 100 + 1")
    smaller = F.expr(f"size - (size * {2 * percent} + {99 + percent}) div {100 + percent} + 1")
    first = rows.withColumn("nth", nth).filter(F.col("nth") <= larger).filter("of > 1")
    first = stored(first.select("sid", "comp", "shingle", (F.col("nth") <= smaller).alias("as_smaller")), "prefixes")
    wanted = first.filter("as_smaller").groupBy("shingle").agg(F.count("*").alias("n"))
    first = facts_join(first, wanted.select("shingle"), ["shingle"], stored(first.groupBy("shingle").agg(F.count("*").alias("n")), "prefix-counts"))
    return first.select(F.lit(0).cast("long").alias("key"), "sid", "comp", F.xxhash64(F.lit("rare"), "shingle").alias("cell"))


def _prune(least: np.ndarray):
    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield b.take(pa.array(survivors(_stack(b.column("sig_a")), _stack(b.column("sig_b")), least))).select(["a", "b"])

    return run


def _block_members(least: np.ndarray):
    def found(run: pa.Table) -> pa.Table:
        """Members that have pairs of different components which no batch drops, in the first band that the two share; a key of 0 is none.

        A left member names the others by ``at``, their places in the block.
        """
        sig = np.frombuffer(b"".join(run["sig"].to_pylist()), np.uint16).reshape(len(run), HASHES)
        bands = run["bands"].combine_chunks().flatten().to_numpy().reshape(len(run), BANDS)
        key = run["key"].to_numpy()
        comp = pd.factorize(run["comp"].to_pandas())[0]
        side = run["as_left"].to_numpy()
        left, right = np.flatnonzero(side), np.flatnonzero(~side)
        one, two = [], []
        for i in left:
            other = right[comp[right] != comp[i]]
            other = other[survivors(np.broadcast_to(sig[i], (len(other), HASHES)), sig[other], least)]
            shared = bands[other] == bands[i]
            other = other[(key[i] == 0) | (bands[other, shared.argmax(1)] == key[i])]
            if len(other):
                one.append(i)
                two.append(other)
        flat = np.concatenate([*two, np.zeros(0, np.int64)])
        met = np.unique(flat)
        rows = np.concatenate([np.array(one, np.int64), met])
        others = B.lists(flat, np.array([*map(len, two), *[0] * len(met)]), pa.int32())
        return run.select(["cell", "i", "j", "sid", "comp"]).take(pa.array(rows)).append_column("at", pa.array(rows, pa.int32())).append_column("others", others)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in B.runs(it, ["cell", "i", "j"]):
            side = group["as_left"].to_numpy()
            if side.any() and not side.all():
                yield from found(group).to_batches()

    return run


def _block_links(percent: int):
    def found(run: pa.Table) -> pa.Table:
        """Links between components of the block that no other of its links joins, verified on full sets."""
        data, offsets = B.buffer(run["members"].combine_chunks())
        codes, every = pd.factorize(data.view(np.uint64))
        offsets = offsets // 8
        size = np.diff(offsets)
        comp = pd.factorize(run["comp"].to_pandas())[0]
        named = run["others"].combine_chunks()
        values, cuts = named.flatten().to_numpy(), np.concatenate([[0], np.cumsum(named.value_lengths().to_numpy())])
        left = np.diff(cuts) > 0
        at = run["at"].to_numpy()
        place = np.zeros(at.max() + 1, np.int64)
        place[at[~left]] = np.flatnonzero(~left)
        own = np.zeros(len(every), bool)
        one, two = [], []
        for i in np.flatnonzero(left):
            other = place[values[cuts[i] : cuts[i + 1]]]
            like = 100 * np.minimum(size[other], size[i]) >= percent * np.maximum(size[other], size[i])
            other = other[(comp[other] != comp[i]) & like]
            if not len(other):
                continue
            n = size[other]
            begin = np.cumsum(n) - n
            mine = codes[offsets[i] : offsets[i + 1]]
            own[mine] = True
            common = np.add.reduceat(own[codes[np.repeat(offsets[other] - begin, n) + np.arange(n.sum())]], begin, dtype=np.int64)
            own[mine] = False
            for x in other[100 * common >= percent * (n + size[i] - common)]:
                if comp[x] != comp[i]:
                    comp[comp == comp[x]] = comp[i]
                    one.append(i)
                    two.append(x)
        sid = run["sid"].combine_chunks()
        return pa.table({"a": sid.take(pa.array(one, pa.int64())), "b": sid.take(pa.array(two, pa.int64()))})

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in B.runs(it, ["cell", "i", "j"]):
            yield from found(group).to_batches()

    return run


def _verify(percent: int):
    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            xs, xo = B.buffer(b.column("members_a"))
            ys, yo = B.buffer(b.column("members_b"))
            xs, ys, xo, yo = xs.view(np.uint64), ys.view(np.uint64), xo // 8, yo // 8
            keep = []
            for i in range(b.num_rows):
                x, y = xs[xo[i] : xo[i + 1]], ys[yo[i] : yo[i + 1]]
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    keep.append(i)
            yield b.take(pa.array(keep, pa.int64())).select(["a", "b"])

    return run


def near_dedup(docs: DataFrame, percent: int = 80, miss: float = 1e-4, width: int = 5, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    A document's set is its distinct shingles of ``width`` lower-cased words (A-Z only);
    with fewer words all of them are one shingle. Documents are linked if 100 * common >=
    ``percent`` * united shingles; component_id is the smallest doc_id that links reach.
    ``miss`` bounds the chance that the signature comparison, all its batches together,
    drops a pair at the threshold.
    Null and empty texts have no shingles and stand alone. Rows that share a doc_id are
    linked as their texts are, and each is kept if the id is its component's. A null
    doc_id is never a component's id unless it stands alone. With ``row_col``, a unique key
    of the rows that is returned as the last column, just one row of each component is
    kept, of equal id the one with the least key. An empty table gives an empty result.
    Other columns, whatever their names, are ignored.
    """
    B.small_batches(docs.sparkSession)
    least = least_matches(percent / 100, miss)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *B.rows_key(row_col))
    own = [row_col] if row_col else []
    signed = stored(text.mapInArrow(_sign(width, own), "doc_id long, n_shingles long, sid binary, sig binary, bands array<long>" + B.rows_schema(row_col)), "signatures")
    classes = signed.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("first_id"), *least_row("doc_id", row_col), F.any_value(F.struct("sig", "bands", "n_shingles")).alias("s"), F.count("*").alias("n"))
    classes = stored(classes.select("sid", "first_id", *(["first_row"] if row_col else []), "s.sig", "s.bands", "s.n_shingles", "n"), "classes")

    member = classes.select("sid", F.posexplode("bands").alias("band", "key")).select("sid", "key")
    sizes = stored(member.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    member = stored(facts_join(member, sizes.select("key", F.col("n").alias("size")), ["key"], sizes), "members")
    mass = member.groupBy("sid").agg(F.sum("size").alias("mass"))
    centre = member.join(mass, "sid").groupBy("key").agg(F.max(F.struct("mass", "sid"))["sid"].alias("centre"))
    held = stored(facts_join(member, centre, ["key"], sizes), "held")
    # each class is compared with the centre of its largest bucket first
    nearest = held.filter("sid != centre").groupBy("sid").agg(F.max(F.struct("size", "key", "centre"))["centre"].alias("centre"))
    pairs = nearest.select(F.least("sid", "centre").alias("a"), F.greatest("sid", "centre").alias("b")).distinct()

    sig = classes.select("sid", "sig")

    def pruned(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b").join(sig.select(F.col("sid").alias("a"), F.col("sig").alias("sig_a")), "a").join(sig.select(F.col("sid").alias("b"), F.col("sig").alias("sig_b")), "b")
        return both.mapInArrow(_prune(least), "a binary, b binary")

    first = stored(pruned(pairs), "candidates")
    large = stored(member.filter(F.col("size") > SMALL).select("key", "sid"), "large")

    def sets_of(wanted: DataFrame) -> DataFrame:
        ids = classes.join(wanted.select("sid").distinct(), "sid", "left_semi").select(F.col("first_id").alias("id")).distinct()
        # where a doc_id repeats, each of its texts gives the set of its own class
        texts = text.join(ids, F.col("doc_id").eqNullSafe(F.col("id"))).select("text")
        return texts.mapInArrow(_sets(width), "sid binary, members binary").groupBy("sid").agg(F.any_value("members").alias("members"))

    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("sid"))
    sets = stored(sets_of(ends(first).unionByName(large.select("sid"))), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("members").alias("members_a")), "a").join(sets.select(F.col("sid").alias("b"), F.col("members").alias("members_b")), "b")
        return both.mapInArrow(_verify(percent), "a binary, b binary")

    links = stored(verified(first), "links")
    label = components(links)
    rest = stored(pruned(apart(held, label)), "candidates")
    if not rest.isEmpty():
        sets = sets.unionByName(stored(sets_of(ends(rest)).join(sets, "sid", "left_anti"), "sets"))
        links = links.unionByName(stored(verified(rest), "links"))
        label = components(links)
    if not large.isEmpty():
        links = links.unionByName(stored(block_links(large, classes.select("sid", "sig", "bands", "n_shingles"), label, least, sets, percent), "links"))
        label = components(links)

    named = classes.select("sid", "first_id", *(["first_row"] if row_col else [])).join(label, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    smallest = named.groupBy("comp").agg(F.min("first_id").alias("component_id"), *([F.min("first_row").alias("first_row")] if row_col else []))
    named = named.select("sid", "comp").join(smallest, "comp").drop("comp")
    out = signed.select("doc_id", "n_shingles", "sid", *own)
    known = facts_join(out, named, ["sid"], classes.select("sid", "n"))
    out = known.unionByName(out.filter("sid IS NULL"), allowMissingColumns=True)
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    kept = F.col("sid").isNull() | (F.col(row_col) == F.col("first_row.row")) if row_col else F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), *own)


def least_row(id_col: str, row_col: str | None) -> list[Column]:
    """The row of the smallest id, of equal ids that with the least key; nothing where rows have no key."""
    return [F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row_col).alias("row"))).alias("first_row")] if row_col else []


def apart(held: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components: members of a bucket with its centre, and all pairs of small buckets.

    ``held``: key, sid, size, centre. Components are told to the members of buckets, before
    there are pairs, so that a group which its centre has linked makes none.
    """
    m = stored(held.join(label, "sid", "left").withColumn("comp", F.coalesce("comp", "sid")), "labelled")
    own = m.groupBy("key").agg(F.max(F.when(F.col("sid") == F.col("centre"), F.col("comp"))).alias("of"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    own = stored(own.filter("lo != hi").select("key", "of"), "mixed")
    some = m.join(own, "key")
    near = some.filter("comp != of").select(F.least("sid", "centre").alias("a"), F.greatest("sid", "centre").alias("b"))
    small = some.filter(F.col("size").between(3, SMALL)).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("sid", "comp"))).alias("m"))
    small = small.select("m", F.posexplode("m").alias("at", "x")).select("x", F.explode(F.slice("m", F.col("at") + 2, F.lit(SMALL))).alias("y"))
    small = small.filter("x.comp != y.comp").select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"))
    return near.unionByName(small).distinct()


def mixed(m: DataFrame, by: str) -> DataFrame:
    """(by, main, comps, size, minor) of buckets with several components: the largest, their number, members, members outside the largest."""
    parts = m.groupBy(by, "comp").agg(F.count("*").alias("n"))
    top = parts.groupBy(by).agg(F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps"), F.sum("n").alias("size")).filter("comps > 1")
    return top.select(by, F.col("top.comp").alias("main"), "comps", "size", (F.col("size") - F.col("top.n")).alias("minor"))


def block_links(large: DataFrame, sig: DataFrame, label: DataFrame, least: np.ndarray, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components in large buckets.

    In each bucket the members outside its largest component are compared with all members,
    block by block; a bucket of one component needs nothing. The members of buckets in which
    that is more than ``WORK`` comparisons are compared where they have a rare shingle in
    common (:func:`prefix_cells`), in whatever bucket. Pairs are no rows: a block's members
    with pairs to verify meet again with their sets, so rows grow with members and blocks.
    """
    m = stored(large.join(label, "sid", "left").withColumn("comp", F.coalesce("comp", "sid")), "labelled")
    buckets = stored(mixed(m, "key"), "buckets")
    light = buckets.filter(F.col("minor") * F.col("size") <= WORK).select("key")
    heavy = buckets.filter(F.col("minor") * F.col("size") > WORK).select("key", F.col("size").alias("n"))
    cells = m.join(light, "key", "left_semi").select("key", "sid", "comp", F.col("key").alias("cell"))
    if not heavy.isEmpty():
        again = facts_join(m, heavy.select("key"), ["key"], heavy).select("sid", "comp").distinct()
        cells = cells.unionByName(prefix_cells(again, sets, percent))
    cells = stored(cells.join(sig.select("sid", "n_shingles"), "sid"), "cells")
    top = stored(mixed(cells, "cell").join(cells.groupBy("cell").agg(F.sum("n_shingles").alias("shingles")), "cell"), "tops")
    m = facts_join(cells.drop("n_shingles"), top.select("cell", "main", "size", "shingles"), ["cell"], top.select("cell", F.col("size").alias("n"))).withColumn("minor", F.col("comp") != F.col("main"))
    blocks = F.ceil(F.greatest(F.col("size") / F.lit(BLOCK), F.col("shingles") / F.lit(BLOCK_SHINGLES))).cast("int")
    m = m.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    left = m.filter("minor").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    left = left.select("key", "cell", "sid", "comp", F.col("block").alias("i"), F.col("with").alias("j"), F.lit(True).alias("as_left"))
    # a block of the right side is wanted where the left side has a block
    wanted = m.filter("minor").select("cell", F.col("block").alias("i")).distinct()
    right = m.join(wanted, "cell").select("key", "cell", "sid", "comp", "i", F.col("block").alias("j"), F.lit(False).alias("as_left"))
    dealt = lambda rows: rows.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    rows = left.unionByName(right).join(sig.select("sid", "sig", "bands"), "sid")
    found = stored(dealt(rows).mapInArrow(_block_members(least), "cell long, i int, j int, sid binary, comp binary, at int, others array<int>"), "block-members")
    return dealt(found.join(sets, "sid")).mapInArrow(_block_links(percent), "a binary, b binary").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
