"""Phrases of two to five words whose words come together more often than chance.

Suffix pointers, each the place of a word with what follows it, are sorted by a three-way
quicksort over words (multikey quicksort) to the longest phrase's depth: the partition equal
to a pivot at each depth is a phrase, its size the phrase's frequency, and partitions smaller
than the least frequency are abandoned.

Before, pointers are routed by language and their two leading words, so that all of a phrase
are in one task. Only those whose words and neighbours can be frequent are: words are counted
first, then neighbours of frequent words, and bitmaps of the frequent ones, which can err
only by letting too much through, cut each suffix where it can't be part of a frequent
phrase any more. Equal suffixes of a batch are one pointer with a weight. Leading words with
very many pointers are dealt over tasks by the whole suffix; their tasks give the counts of
all beginnings, whatever their size, and these are added up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm.scratch import stored
from resultlake.llm.words import LOWER, hashes, mix, spans

#: Words of a phrase, at most; occurrences, at least; phrases of a language that are returned.
LONGEST, LEAST, TOP = 5, 100, 2_000
#: Bits of a bitmap for each of its members, and in all, at most (as a power of two: 32 MB).
BITS_EACH, MOST_BITS = 16, 28
#: Pointers of leading words from which on they are dealt over tasks, at least; leading words that are, at most.
HOT_ROWS, HOT_KEYS = 20_000, 100_000
#: Pointers that are sorted at once, about.
CHUNK = 1 << 19

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_SEPARATOR
_WORD[[0x20, 0x09]] = False


class Words:
    """The words of some texts of one language."""

    def __init__(self, texts: pa.Array) -> None:
        self.data, offsets = B.buffer(texts)
        self.data = LOWER[self.data]
        self.starts, self.ends, counts = spans(self.data, offsets, _WORD)
        cuts = np.cumsum(_SEPARATOR[self.data], dtype=np.int64)
        text = np.repeat(np.arange(len(counts)), counts)
        #: Whether each word but the last stands in one piece with the next.
        self.joined = (text[1:] == text[:-1]) & (cuts[self.starts[1:]] == cuts[self.ends[:-1] - 1])

    def hashes(self, lang: str) -> np.ndarray:
        """Of each word with its language."""
        key = np.frombuffer(lang.encode(), np.uint8)
        return mix(hashes(self.data, self.starts, self.ends) ^ hashes(key, np.zeros(1, np.int64), np.array([len(key)])))

    def counted(self) -> tuple[pa.Array, pa.Array]:
        """(different words, how often each)."""
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        found = pc.value_counts(B.binary(self.data[_WORD[self.data]], offsets))
        return found.field("values").cast(pa.string()), found.field("counts")

    def phrases(self, at: np.ndarray, size: np.ndarray) -> pa.Array:
        """The phrases of ``size`` words from word ``at`` on, words parted by a blank."""
        ends = np.cumsum(size)
        word = np.repeat(at - (ends - size), size) + np.arange(int(size.sum()))
        length = self.ends[word] - self.starts[word] + 1  # with a blank
        stop = np.cumsum(length)
        made = np.append(self.data, np.uint8(32))[np.minimum(np.repeat(self.starts[word] - (stop - length), length) + np.arange(int(stop[-1]) if len(stop) else 0), len(self.data))]
        made[stop - 1] = 32
        keep = np.ones(len(made), bool)
        keep[stop[ends - 1] - 1] = False
        whole = np.concatenate([[0], stop[ends - 1]])
        return B.binary(made[keep], whole - np.arange(len(whole))).cast(pa.string())


def neighbours(words: np.ndarray) -> np.ndarray:
    """Hashes of each word with the next."""
    return mix(words[:-1] * _GOLD + words[1:])


def by_language(it: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    for b in B.pieces(it, "text"):
        names = b.column("lang").dictionary_encode()
        codes = names.indices.to_numpy()
        for code, name in enumerate(names.dictionary.to_pylist()):
            words = Words(b.column("text").filter(pa.array(codes == code)))
            if len(words.starts):
                yield name, words


class Bitmap:
    """The hashes that may be among some; a hash that is among them always may."""

    def __init__(self, words: np.ndarray, bits: int) -> None:
        self.words, self.shift = words, np.uint64(64 - bits)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.words[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & 1 == 1


def bitmap(some: DataFrame) -> Bitmap:
    """Of the 64-bit integers ``h``. Its size follows their number up to a fixed one, beyond which it lets more through."""
    n = some.count()
    bits = min(MOST_BITS, max(10, (BITS_EACH * n).bit_length()))
    at = some.select(F.shiftrightunsigned("h", 64 - bits).alias("at"))
    found = at.groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 31 AS INT))")).alias("bits")).toPandas()  # 2**23 words at most
    words = np.zeros(1 << (bits - 5), np.uint32)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return Bitmap(words, bits)


def quicksort(keys: np.ndarray, weight: np.ndarray, least: int, first: int) -> Iterator[tuple[int, int, int]]:
    """(row, depth, weight) of each beginning of ``depth`` keys, ``first`` at least, that rows of ``least`` weight share.

    Rows of ``keys`` end with -1 where they are shorter. Multikey quicksort of pointers to
    rows: less than, equal to and greater than a pivot at one depth, the equal ones one
    deeper; partitions of less weight are abandoned.
    """
    rows, deepest = keys.shape
    pointers = np.arange(rows)
    todo = [(0, rows, 0)]
    while todo:
        lo, hi, depth = todo.pop()
        part = pointers[lo:hi]
        if not len(part) or weight[part].sum() < least:
            continue
        here = keys[part, depth]
        pivot = here[0] if len(part) < 3 else np.partition(here, len(part) // 2)[len(part) // 2]
        less, same = here < pivot, here == pivot
        a, b = lo + int(less.sum()), lo + int(less.sum()) + int(same.sum())
        equal = part[same]
        pointers[lo:hi] = np.concatenate([part[less], equal, part[~less & ~same]])
        todo += [(lo, a, depth), (b, hi, depth)]
        if pivot >= 0:
            size = int(weight[equal].sum())
            if size >= least:
                if depth + 1 >= first:
                    yield int(equal[0]), depth + 1, size
                if depth + 1 < deepest:
                    todo.append((a, b, depth + 1))


def _sorted_counts(t: pa.Table, least: int, longest: int) -> pa.RecordBatch:
    """(lang, phrase, words, n) of the phrases in pointers (lang, phrase, n)."""
    t = t.combine_chunks()
    words = pc.split_pattern(t.column("phrase").combine_chunks(), " ")
    size = np.diff(words.offsets.to_numpy())
    ids = words.flatten().dictionary_encode()
    keys = np.full((len(t), longest + 1), -1, np.int32)
    keys[:, 0] = t.column("lang").combine_chunks().dictionary_encode().indices.to_numpy()
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    keys[np.repeat(np.arange(len(t)), size), place + 1] = ids.indices.to_numpy()
    found = np.array(list(quicksort(keys, t.column("n").to_numpy(), least, 3)), np.int64).reshape(-1, 3)
    texts = t.column("phrase").take(pa.array(found[:, 0])).to_pylist()
    cut = [" ".join(p.split(" ")[: k - 1]) for p, k in zip(texts, found[:, 1].tolist())]
    lang = t.column("lang").take(pa.array(found[:, 0])).combine_chunks()
    return pa.RecordBatch.from_arrays([lang, pa.array(cut, pa.string()), pa.array(found[:, 1] - 1), pa.array(found[:, 2])], ["lang", "phrase", "words", "n"])


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(phrases, words) of ``docs`` (lang, text): (lang, phrase, words, n) of 1 to ``longest`` words, and (lang, n) words in all.

    Both are written tables. ``n``, occurrences inside pieces, is ``least`` at least.
    """
    B.small_batches(docs.sparkSession)

    def words(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, w in by_language(it):
            word, n = w.counted()
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(word), pa.string()), word, n], ["lang", "phrase", "n"])

    single = docs.mapInArrow(words, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    known = stored(single.groupBy("lang", F.when(F.col("n") >= least, F.col("phrase")).alias("phrase")).agg(F.sum("n").alias("n")), "words")  # rare words are one row
    totals = known.groupBy("lang").agg(F.sum("n").alias("n"))
    common = known.filter("phrase IS NOT NULL")

    def word_hashes(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, w in by_language(it):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(w.hashes(lang)).view(np.int64))], ["h"])

    frequent = docs.sparkSession.sparkContext.broadcast(bitmap(common.select("lang", F.col("phrase").alias("text")).mapInArrow(word_hashes, "h long")))

    def pairs(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, w in by_language(it):
            h = w.hashes(lang)
            good = frequent.value.holds(h)
            key, n = np.unique(neighbours(h)[w.joined & good[:-1] & good[1:]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])

    both = stored(docs.mapInArrow(pairs, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("h"), "neighbours")
    linked = docs.sparkSession.sparkContext.broadcast(bitmap(both))

    def pointers(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, w in by_language(it):
            h = w.hashes(lang)
            good = frequent.value.holds(h)
            on = np.append(w.joined & good[:-1] & good[1:] & linked.value.holds(neighbours(h)), np.zeros(longest, bool))
            at = np.flatnonzero(on)
            size, going = np.ones(len(at), np.int64), np.ones(len(at), bool)
            for k in range(longest - 1):
                going &= on[at + k]
                size += going
            found = pc.value_counts(w.phrases(at, size))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), found.field("values"), found.field("counts")], ["lang", "phrase", "n"])

    lead = F.xxhash64("lang", F.substring_index("phrase", " ", 2)).alias("lead")
    made = stored(docs.mapInArrow(pointers, "lang string, phrase string, n long").select("lang", "phrase", "n", lead), "suffixes")
    sizes = made.groupBy("lead").agg(F.count("*").alias("rows"))
    total = made.count()
    hot = sizes.filter(F.col("rows") > max(HOT_ROWS, -(-total // HOT_KEYS))).select("lead", F.lit(True).alias("hot"))  # HOT_KEYS at most
    routed = made.join(F.broadcast(hot), "lead", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    routed = routed.withColumn("lead", F.when(F.col("hot"), F.xxhash64("lang", "phrase")).otherwise(F.col("lead")))
    routed = routed.repartition("lead").sortWithinPartitions("hot", "lead").select("lang", "phrase", "n", "lead", "hot")

    def count(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _chunks(it, CHUNK):
            for some, bound in ((t.filter(pc.invert(t.column("hot"))), least), (t.filter(t.column("hot")), 1)):
                if len(some):
                    yield _sorted_counts(some, bound, longest)
        B.give_back()

    several = routed.mapInArrow(count, "lang string, phrase string, words long, n long").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return stored(several.unionByName(common.select("lang", "phrase", F.lit(1).cast("long").alias("words"), "n")), "phrases"), totals


def _chunks(it: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that part no ``lead``; the batches are sorted by hot and lead."""
    held: list[pa.RecordBatch] = []
    for b in it:
        if not b.num_rows:
            continue
        if sum(x.num_rows for x in held) >= rows:
            last = held[-1].column("lead")[-1]
            own = int(pc.sum(pc.equal(b.column("lead"), last)).as_py() or 0)  # its rows are first
            if own < b.num_rows:
                yield pa.Table.from_batches([*held, b.slice(0, own)])
                held, b = [], b.slice(own)
        held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut: the ``top`` phrases of each language.

    ``docs`` (lang, text): null texts are empty, a null language is ``und``; texts without
    words and empty tables give nothing; repeated rows count each. The score of a phrase cut
    in two is floor(1000 * a * n / (l * r)), that of its worst cut counts (the first of equal
    ones). A phrase inside a longer one of the same frequency goes; by that all phrases
    between them have it too, so the ones a word longer decide. Ties of score are broken by
    frequency, then by the phrase's bytes. Other columns are ignored.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    known, totals = frequent_phrases(texts, least, longest)
    parts = known.filter("words > 1").withColumn("w", F.split("phrase", " ", -1))
    join = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    size = F.col("words").cast("int")
    longer = parts.filter("words > 2").select("lang", "n", F.explode(F.array(join(F.lit(1), size - 1), join(F.lit(2), size - 1))).alias("phrase"))
    kept = parts.join(longer, ["lang", "phrase", "n"], "left_anti").withColumnRenamed("n", "a")
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(k.alias("cut"), join(F.lit(1), k).alias("left"), join(k + 1, size - k).alias("right")))
    each = kept.withColumn("c", F.explode(cuts)).select("lang", "phrase", "a", "c.*")
    side = lambda phrase, n: known.select("lang", F.col("phrase").alias(phrase), F.col("n").alias(n))
    each = each.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    each = each.withColumns({f"__{c}": wide(c) for c in ("a", "n", "l", "r")}).withColumn("score", F.expr("(1000BD * __a * __n) div (__l * __r)"))
    worst = each.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "n", "score", "cut"), F.struct("score", "cut")).alias("v")).select("lang", "phrase", "v.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = worst.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", F.col("cut").cast("long").alias("cut"))
