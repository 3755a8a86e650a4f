"""Exact dedup by composable polynomial fingerprints.

A text, without the white space of ASCII, is hashed as a polynomial over two primes.
Hashes of chunks combine by shifting the left one by the length of the right one, so the
chunks of a huge document are hashed by different tasks. Texts with equal fingerprints
and lengths are then compared chunk by chunk in one streaming aggregation; where that
finds a difference, the texts of that fingerprint are told apart by a cryptographic digest.
Texts whose fingerprint no other has stay where they are: a bitmap of the fingerprints that
repeat, of bounded size, tells each task which of its texts have to meet others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm.scratch import stored
from resultlake.llm.skew import facts_join

#: Two primes below 2**31 and the base of the polynomial.
PRIMES = (2147483647, 2147483629)
BASE = 1000003
#: Characters of a document from which on its chunks are hashed by separate tasks.
HUGE_CHARS = 8 << 20
CHUNK_CHARS = 1 << 20
#: Bytes of a block, blocks hashed at once, and bytes of a chunk that the comparison holds.
BLOCK_BYTES = 4096
BLOCKS = 512
COMPARE_BYTES = 256 << 10

#: Bits of the bitmap of repeated fingerprints for each of them, and in all, at least and at most, as powers of two (32 MB at most, sent to every task).
BITS_EACH, LEAST_POWER, MOST_POWER = 16, 16, 28

SPACE = r"[\x20\x09-\x0D]"


def counted(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags of each text are set."""
    if len(flags) > BLOCK_BYTES * (len(offsets) - 1):  # long texts, without a copy as wide integers
        return np.array([np.count_nonzero(flags[s:e]) for s, e in zip(offsets[:-1], offsets[1:])], np.int64)
    out, some = np.zeros(len(offsets) - 1, np.int64), offsets[:-1] < offsets[1:]
    if some.any():
        out[some] = np.add.reduceat(flags.view(np.uint8), offsets[:-1][some], dtype=np.int64)
    return out


def squeezed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts without white space."""
    kept = (data - np.uint8(9) > 4) & (data != 32)  # bytes below 9 wrap round
    return data[kept], np.concatenate([[0], np.cumsum(counted(kept, offsets))])


def fingerprints(data: np.ndarray, offsets: np.ndarray, primes: tuple[int, int] = PRIMES) -> list[np.ndarray]:
    """For each prime, the polynomial of each text modulo the prime, from hashes of its blocks.

    Blocks are hashed ``BLOCKS`` at a time, so a long text needs little more memory than its bytes.
    """
    lengths = np.diff(offsets)
    blocks = -(-lengths // BLOCK_BYTES)
    owner = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = offsets[:-1][owner] + nth * BLOCK_BYTES
    ends = np.minimum(starts + BLOCK_BYTES, offsets[1:][owner])
    powers = []
    for p in primes:
        power = np.ones(BLOCK_BYTES, np.uint64)
        for i in range(1, BLOCK_BYTES):
            power[i] = int(power[i - 1]) * BASE % p
        powers.append(power)
    parts = [np.zeros(len(owner), np.int64) for _ in primes]
    for lo in range(0, len(owner), BLOCKS):
        s, e = starts[lo : lo + BLOCKS], ends[lo : lo + BLOCKS]
        to_end = np.repeat(e, e - s) - np.arange(s[0], e[-1]) - 1
        values = data[s[0] : e[-1]].astype(np.uint64) + np.uint64(1)
        for part, power, p in zip(parts, powers, primes):
            part[lo : lo + BLOCKS] = np.add.reduceat(values * power[to_end], s - s[0]) % np.uint64(p)
    out = []
    for part, power, p in zip(parts, powers, primes):
        hashed = np.zeros(len(lengths), np.int64)
        one = blocks[owner] == 1
        hashed[owner[one]] = part[one]
        full = int(power[-1]) * BASE % p
        for i in np.flatnonzero(~one):
            shift = full if ends[i] - starts[i] == BLOCK_BYTES else pow(BASE, int(ends[i] - starts[i]), p)
            hashed[owner[i]] = (int(hashed[owner[i]]) * shift + int(part[i])) % p
        out.append(hashed)
    return out


_ROW = "doc_id long, n_points long, n_bytes long, fp1 long, fp2 long, text_sha256 string"
_CHUNK = "row string, nth int, n_bytes long, fp1 long, fp2 long, shift1 long, shift2 long"


def _hash_rows(primes: tuple[int, int], own: list[str]):
    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "text"):
            raw, at = B.buffer(b.column("text"))
            points = counted((raw & 0xC0) != 0x80, at)
            data, offsets = squeezed(raw, at)
            fp1, fp2 = fingerprints(data, offsets, primes)
            view = memoryview(np.ascontiguousarray(data))
            sha = [hashlib.sha256(view[s:e]).hexdigest() for s, e in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(points), pa.array(np.diff(offsets)), pa.array(fp1), pa.array(fp2), pa.array(sha, pa.string()), *(b.column(c) for c in own)], ["doc_id", "n_points", "n_bytes", "fp1", "fp2", "text_sha256", *own])

    return run


def _hash_chunks(primes: tuple[int, int]):
    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "chunk"):
            data, offsets = squeezed(*B.buffer(b.column("chunk")))
            n = np.diff(offsets)
            fps = fingerprints(data, offsets, primes)
            shifts = [pa.array([pow(BASE, int(x), p) for x in n], pa.int64()) for p in primes]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("nth"), pa.array(n), *map(pa.array, fps), *shifts], ["row", "nth", "n_bytes", "fp1", "fp2", "shift1", "shift2"])

    return run


def _bit(fp1: Column, fp2: Column, n_bytes: Column, size: int) -> Column:
    """The place of a fingerprint in a bitmap: by arithmetic that :func:`_bits` repeats."""
    return F.pmod(fp1 * 31 + fp2 + n_bytes * 7, F.lit(size))


def _bits(fp1: np.ndarray, fp2: np.ndarray, n_bytes: np.ndarray, size: int) -> np.ndarray:
    return (fp1 * 31 + fp2 + n_bytes * 7) % size


def repeated(groups: DataFrame) -> np.ndarray:
    """The bitmap of the fingerprints (fp1, fp2, n_bytes) of ``groups``, in words of 32 bits.

    Its size follows their number up to a fixed one, beyond which more texts than need be are
    compared. The driver sees the words that are not zero, at most 2 ** (MOST_POWER - 5) of them.
    """
    power = min(MOST_POWER, max(LEAST_POWER, (BITS_EACH * groups.count()).bit_length()))
    at = groups.select(_bit(F.col("fp1"), F.col("fp2"), F.col("n_bytes"), 1 << power).alias("at"))
    words = at.groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 31 AS INT))")).alias("bits")).toPandas()
    out = np.zeros(1 << (power - 5), np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def _compare_rows(primes: tuple[int, int], known: Broadcast | None):
    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "text"):
            data, offsets = squeezed(*B.buffer(b.column("text")))
            fp1, fp2 = fingerprints(data, offsets, primes)
            n = np.diff(offsets)
            if known is not None:
                bit = _bits(fp1, fp2, n, 32 * len(known.value))
                kept = (known.value[bit >> 5] >> (bit & 31).astype(np.uint32) & 1).astype(bool)
                data = data[np.repeat(kept, n)]
                fp1, fp2, n = fp1[kept], fp2[kept], n[kept]
                offsets = np.concatenate([[0], np.cumsum(n)])
                if not len(n):
                    continue
            chunks = np.maximum(1, -(-n // COMPARE_BYTES))
            owner = np.repeat(np.arange(len(n)), chunks)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
            starts = offsets[:-1][owner] + nth * COMPARE_BYTES
            cut = np.append(starts, offsets[-1])
            yield pa.RecordBatch.from_arrays([pa.array(fp1[owner]), pa.array(fp2[owner]), pa.array(n[owner]), pa.array(nth.astype(np.int32)), B.binary(data, cut)], ["fp1", "fp2", "n_bytes", "nth", "chunk"])

    return run


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes: tuple[int, int] = PRIMES, row_col: str | None = None) -> DataFrame:
    """doc_id, n_points, n_bytes, fp1, fp2, text_sha256 for each row of ``docs``.

    n_points counts the code points of the text as it is, the other columns are of the
    text without white space. Null counts as empty. ``row_col``, a key of the rows, is
    returned as the last column. Other columns of ``docs`` are ignored.
    """
    B.small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [row_col] if row_col else []
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *B.rows_key(row_col))
    huge = F.length("text") > HUGE_CHARS
    plain = base.filter(~huge).mapInArrow(_hash_rows(primes, own), _ROW + B.rows_schema(row_col))
    big = base.filter(huge).withColumn("row", F.sha2("text", 256))  # the same whenever the rows are read; copies share their chunks' hashes
    facts = big.select("row", "doc_id", *own, F.length("text").cast("long").alias("n_points"), F.sha2(F.regexp_replace("text", SPACE, ""), 256).alias("text_sha256"))
    count = F.ceil(F.length("text") / F.lit(CHUNK_CHARS)).cast("int")
    cut = big.select("row", "text", F.explode(F.sequence(F.lit(0), count - 1)).alias("nth")).select("row", "nth", F.col("text").substr(F.col("nth") * CHUNK_CHARS + 1, F.lit(CHUNK_CHARS)).alias("chunk"))
    parts = cut.repartition("row", "nth").mapInArrow(_hash_chunks(primes), _CHUNK)
    parts = parts.groupBy("row", "nth").agg(*[F.first(c).alias(c) for c in ("n_bytes", "fp1", "fp2", "shift1", "shift2")])
    joined = parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("nth", "n_bytes", "fp1", "fp2", "shift1", "shift2"))).alias("c"))

    def combined(k: int) -> Column:
        """left * base ** len(right) + right, chunk after chunk."""
        return F.aggregate("c", F.lit(0).cast("long"), lambda h, x: (h * x[f"shift{k}"] + x[f"fp{k}"]) % F.lit(primes[k - 1]))

    whole = joined.select("row", F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x["n_bytes"]).alias("n_bytes"), combined(1).alias("fp1"), combined(2).alias("fp2"))
    return plain.unionByName(facts.join(whole, "row").drop("row"))


def collisions(docs: DataFrame, text_col: str = "text", primes: tuple[int, int] = PRIMES, among: DataFrame | None = None) -> DataFrame:
    """(fp1, fp2, n_bytes) under which texts differ: chunks of equal texts have equal least and greatest values.

    ``among``: the fingerprints to look at, all if None; texts of others are not moved but
    for the few that share a bit with one of them. Least and greatest are taken before the
    shuffle too, so copies in one task leave as one row.
    """
    B.small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    known = None if among is None else docs.sparkSession.sparkContext.broadcast(repeated(among))  # 2 ** (MOST_POWER - 3) bytes at most
    chunks = docs.select(text).mapInArrow(_compare_rows(primes, known), "fp1 long, fp2 long, n_bytes long, nth int, chunk binary")
    same = chunks.groupBy("fp1", "fp2", "n_bytes", "nth").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    return same.filter("least != most").select("fp1", "fp2", "n_bytes").distinct()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes: tuple[int, int] = PRIMES, row_col: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without white space; null counts as empty. Of
    equal texts the row with the most code points, then the smallest doc_id, stays. Rows
    that share text and doc_id are the same document: each is marked as it. A null doc_id
    stays only if its group has no other. With ``row_col``, a unique key of the rows that
    is returned as the last column, just one row of each group stays, of equal id the one
    with the least key. An empty table gives an empty result. Other columns, whatever
    their names, are ignored.
    """
    rows = stored(fingerprint(docs, id_col, text_col, primes, row_col), "fingerprints")
    several = rows.groupBy("fp1", "fp2", "n_bytes").agg(F.count("*").alias("n")).filter("n > 1")
    several = stored(several.select("fp1", "fp2", "n_bytes"), "repeated")
    bad = stored(collisions(docs, text_col, primes, several), "collisions")
    key = ["fp1", "fp2", "n_bytes", "variant"]
    if bad.isEmpty():
        rows = rows.withColumn("variant", F.lit(""))
    else:
        rows = rows.join(bad.withColumn("clash", F.lit(True)), ["fp1", "fp2", "n_bytes"], "left")
        rows = rows.withColumn("variant", F.when(F.col("clash"), F.col("text_sha256")).otherwise("")).drop("clash")
    first = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), *([F.col(row_col)] if row_col else []))
    groups = rows.groupBy(*key).agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    groups = stored(groups.select(*key, F.col("first.doc_id").alias("keep_id"), "group_size", *([F.col(f"first.{row_col}").alias("keep_row")] if row_col else [])), "groups")
    kept = F.col(row_col) == F.col("keep_row") if row_col else F.col("doc_id").eqNullSafe(F.col("keep_id"))
    both = facts_join(rows, groups, key, groups.select(*key, F.col("group_size").alias("n")))
    return both.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", *([row_col] if row_col else []))
