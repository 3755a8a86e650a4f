"""Language identification by prediction by partial matching (PPM).

The texts of a bounded sample give, for each language, a tree of byte contexts of up to
``ORDER`` bytes with the counts of what follows them. The trees are frozen: a text is not
learned from while it is coded. A byte is coded in the longest of its contexts that the
language knows; where that has not seen the byte, the code escapes to the next shorter one
(method C: as many escapes as different bytes), in which the bytes of the longer context are
excluded. Below the empty context all bytes that are left are equally likely. A text is of
the language whose code for it is shortest.

With frozen counts all that a language can pay for a byte is known beforehand. So the trees
of all languages are one table of grams, with a row of costs for each; a byte is one look-up
where its gram is in the table, a few where the code escapes. Costs are whole numbers of
1/65536 bit, so that sums don't depend on how texts are put into batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm.toxicity import held_out
from resultlake.llm.words import LOWER

#: Longest context in bytes; a gram, with what follows, has one byte more and fits into 56 bits.
ORDER = 4
#: The sample that is learned from: rows and bytes of text for each language, at most.
TRAIN_ROWS, TRAIN_BYTES = 1_000, 2 << 20
#: Parts of a bit.
UNIT = 1 << 16
UNKNOWN = "und"

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _places(offsets: np.ndarray, size: int) -> np.ndarray:
    """The place of each byte in its text."""
    return np.arange(size) - np.repeat(offsets[:-1], np.diff(offsets))


def _grams(data: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, keys): for each byte the gram of ``k`` bytes that ends there; wrong where a text has fewer."""
    key = np.zeros(len(data), np.uint64)
    for k in range(1, longest + 1):
        shifted = np.zeros(len(data), np.uint64)
        shifted[k - 1 :] = data[: max(0, len(data) - k + 1)]
        key = key | (shifted << np.uint64(8 * (k - 1)))
        yield k, key | (np.uint64(k) << np.uint64(56))


def gram_counts(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of the grams of 1 to ``order + 1`` bytes inside the texts; a key has the length in its top byte."""
    place = _places(offsets, len(data))
    found = [np.unique(keys[place >= k - 1], return_counts=True) for k, keys in _grams(LOWER[data], order + 1)]
    return np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found])


class Table:
    """Places of 64-bit keys, found by hashing; 0 is never a key."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros((1 << bits) + 64, np.uint64)
        self.at = np.zeros(len(self.keys), np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.rounds = 0
        while len(todo):
            self.rounds += 1
            if slot.max() >= len(self.keys):  # a full end
                grown = 64 + int(slot.max()) + 1 - len(self.keys)
                self.keys, self.at = np.append(self.keys, np.zeros(grown, np.uint64)), np.append(self.at, np.zeros(grown, np.int32))
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[todo[free]]
            won = self.keys[slot] == keys[todo]
            self.at[slot[won]] = todo[won]
            slot, todo = slot[~won] + 1, todo[~won]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _GOLD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where there is none."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.at[slot], -1)
        todo = np.flatnonzero((held != keys) & (held != 0))
        for _ in range(self.rounds):
            if not len(todo):
                break
            slot[todo] = np.minimum(slot[todo] + 1, len(self.keys) - 1)
            held = self.keys[slot[todo]]
            same = held == keys[todo]
            out[todo[same]] = self.at[slot[todo[same]]]
            todo = todo[~same & (held != 0)]
        return out


class Model:
    """What each language pays, from the counts of its grams.

    ``keys``: grams of 1 to ``order + 1`` bytes, sorted; ``counts`` (grams, languages). Each
    language has seen a byte at least.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int = ORDER) -> None:
        self.order, self.table = order, Table(keys)
        size, tongues = counts.shape
        root = size  # the empty context; its row is the last
        length = (keys >> np.uint64(56)).astype(np.int64)
        body = keys & np.uint64((1 << 56) - 1)
        mark = lambda k: k.astype(np.uint64) << np.uint64(56)
        below = np.where(length > 1, self.table.find((body >> np.uint64(8)) | mark(length - 1)), root)  # the context
        mask = (np.uint64(1) << (np.uint64(8) * (length - 1).astype(np.uint64))) - np.uint64(1)
        shorter = np.where(length > 1, self.table.find((body & mask) | mark(length - 1)), root)  # without the first byte
        counts = np.vstack([counts, np.zeros((1, tongues), counts.dtype)]).astype(np.float64)
        n, d, out = (np.zeros((size + 1, tongues)) for _ in range(3))  # bytes after a context, different ones, excluded ones
        np.add.at(n, below, counts[:-1])
        np.add.at(d, below, counts[:-1] > 0)
        np.add.at(out, below, counts[shorter] * (counts[:-1] > 0) * (length > 1)[:, None])
        log = lambda x: np.log2(np.maximum(x, 1e-300))
        up = np.append(shorter, root)
        rest, new = n[up] - out + d[up] - d, d[up] - d  # what is left in the shorter context, and different bytes of it
        left = log(rest)  # cost of a byte there is left - log(count)
        leave = np.where(new > 0, left - log(new), 0.0)  # of leaving it as well
        left[root] = leave[root] = 0
        first_leave = np.where(n > 0, log(n + d) - log(d), 0.0)  # of leaving the longest known context
        known = n > 0
        total_leave, chain = np.zeros_like(n), np.zeros_like(n)  # from the longest known one out of the root; from the shorter one on
        fall, top = np.zeros_like(n), np.zeros_like(n)  # of the gram's byte after leaving its context; from its context on
        bare = log(256 - d[root])
        total_leave[root] = first_leave[root]
        for k in range(1, order + 2):
            at = np.flatnonzero(length == k)
            s, c = shorter[at], below[at]
            chain[at] = leave[at] + chain[s]
            total_leave[at] = np.where(known[at], first_leave[at] + chain[at], total_leave[s])
            fall[at] = bare if k == 1 else np.where(counts[s] > 0, left[c] - log(counts[s]), leave[c] + fall[s])
            seen = counts[at] > 0
            top[at] = np.where(seen, log(n[c] + d[c]) - log(counts[at]), np.where(known[c], first_leave[c] + fall[at], top[s]))
        whole = lambda x: np.round(x * UNIT).astype(np.int32)
        self.root, self.followed = root, known.any(axis=1)
        self.top, self.fall, self.leave, self.chain, self.total_leave, self.left = map(whole, (top, fall, leave, chain, total_leave, left))
        self.known, self.seen, self.log, self.bare = known, counts > 0, whole(log(np.maximum(counts, 1))), whole(bare)

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code lengths (texts, languages) in 1/65536 bit."""
        out = np.zeros((len(offsets) - 1, self.top.shape[1]), np.int64)
        if not len(data):
            return out
        place = _places(offsets, len(data))
        *shorter, longest = (keys for _, keys in _grams(LOWER[data], self.order + 1))
        gram = self.table.find(longest)
        gram[place < self.order] = -1
        cost = self.top[gram]  # rows without a gram are written below
        todo = np.flatnonzero(gram < 0)
        if len(todo):
            cost[todo] = self._escaped(todo, place[todo], shorter)
        some = offsets[:-1] < offsets[1:]
        out[some] = np.add.reduceat(cost, offsets[:-1][some], axis=0, dtype=np.int64)
        return out

    def _escaped(self, todo: np.ndarray, place: np.ndarray, grams: list[np.ndarray]) -> np.ndarray:
        """Costs of bytes whose longest gram is not known; ``grams[k - 1]`` are all grams of ``k`` bytes."""
        context = np.full((len(todo), self.order + 1), self.root, np.int64)  # by length
        depth, found, width = np.zeros(len(todo), np.int64), np.full(len(todo), -1, np.int64), np.zeros(len(todo), np.int64)
        for k in range(1, self.order + 1):
            there = np.flatnonzero(place >= k)  # contexts of all shorter lengths are known, or this one isn't
            there = there[depth[there] == k - 1]
            at = self.table.find(grams[k - 1][todo[there] - 1])
            held = (at >= 0) & self.followed[at]
            context[there[held], k] = at[held]
            depth[there[held]] = k
            there = np.flatnonzero((place >= k - 1) & (width == k - 1))  # a gram is known only if its end is
            at = self.table.find(grams[k - 1][todo[there]])
            found[there[at >= 0]], width[there[at >= 0]] = at[at >= 0], k
        rows = np.arange(len(todo))
        deep = context[rows, depth]
        out = self.top[found].astype(np.int64)
        none = found < 0
        out[none] = self.total_leave[deep[none]] + self.bare
        fell = np.flatnonzero(~none & (depth >= width))  # contexts that don't know the byte lie above its gram
        g, above, deep = found[fell], context[fell, width[fell]], deep[fell]
        into = np.where(self.seen[g], self.left[above] - self.log[g], self.leave[above] + self.fall[g])
        paid = self.total_leave[deep].astype(np.int64) - self.chain[above] + into
        out[fell] = np.where(self.known[above], paid, self.top[g])
        return out


def sample(docs: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> DataFrame:
    """(lang, text): what is learned from, of ``docs`` (doc_id, text, lang).

    Of each language ``rows`` rows at most, by a hash of the id, of which the shorter ones
    are taken until their bytes are over ``size``; one row at least. The ids are read first,
    alone, so that texts are read only of the rows chosen.
    """
    able = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("__h", F.xxhash64("doc_id"))
    first = able.select("lang", "__h").withColumn("__n", F.row_number().over(Window.partitionBy("lang").orderBy("__h"))).filter(F.col("__n") <= rows)
    limit = first.groupBy("lang").agg(F.max("__h").alias("__most"))
    near = able.join(F.broadcast(limit), "lang").filter("__h <= __most").select("lang", "text", "__h", F.xxhash64("text").alias("__t"))
    by_id = Window.partitionBy("lang").orderBy("__h", "__t")
    some = near.withColumn("__n", F.row_number().over(by_id)).filter(F.col("__n") <= rows)  # ids may repeat
    some = some.dropDuplicates(["lang", "text"]).withColumn("__size", F.octet_length("text").cast("long"))
    used = F.sum("__size").over(Window.partitionBy("lang").orderBy("__size", "__h", "__t").rowsBetween(Window.unboundedPreceding, -1))
    return some.withColumn("__used", F.coalesce(used, F.lit(0))).filter((F.col("__used") == 0) | (F.col("__used") + F.col("__size") <= size)).select("lang", "text")


def learn(train: DataFrame, order: int = ORDER) -> tuple[list[str], Model | None]:
    """(languages in order, their model) of (lang, text), or no model where there is no text; counted by Spark."""

    def count(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "text"):
            names = np.array(b.column("lang").to_pylist(), object)
            for name in sorted(set(names.tolist())):
                data, offsets = B.buffer(b.filter(pa.array(names == name)).column("text"))
                keys, n = gram_counts(data, offsets, order)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    counts = train.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # of the sample only
    if not len(counts):
        return [], None
    names = sorted(set(counts["lang"]))
    keys, row = np.unique(counts["gram"].to_numpy().view(np.uint64), return_inverse=True)
    table = np.zeros((len(keys), len(names)), np.int64)
    table[row, np.searchsorted(names, counts["lang"].to_numpy().astype(str))] = counts["n"].to_numpy()
    return names, Model(keys, table, order)


def identify(docs: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits for each row of ``docs`` (doc_id, text, lang).

    Learned from a bounded sample (:func:`sample`) of rows with a language whose id is not
    held out; a null id is, as in :func:`held_out`. ``score`` is the share of the best
    language in the probabilities of the text under all of them, ``bits`` the length of its
    code for the whole text; of languages with codes of one length the first by code points
    is taken. Null, empty and letterless texts are ``und`` with a score of 0 and null bits,
    as are all texts where no language can be learned (an empty table, no labels). Rows with
    equal texts have equal values, repeated rows a row each. Other columns are ignored.
    """
    B.small_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    names, model = learn(sample(base, rows, size), order)
    coded = base.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    out = "doc_id long, lang_pred string, score double, bits double"
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's bytes times the order, for each language

    def score(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = sent.value
        for b in B.pieces(it, "text", 1 << 20):
            unknown = b.column("text").is_null().to_numpy(zero_copy_only=False)
            if ppm is None:
                unknown[:] = True
                best, share, least = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows), np.zeros(b.num_rows)
            else:
                bits = ppm.bits(*B.buffer(b.column("text")))
                best, least = bits.argmin(axis=1), bits.min(axis=1)
                share = 1 / np.exp2(np.maximum((least[:, None] - bits) / UNIT, -1000)).sum(axis=1)
            label = [UNKNOWN if u else names[k] for u, k in zip(unknown.tolist(), best.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(label, pa.string()), pa.array(np.where(unknown, 0.0, share)), pa.array(least / UNIT, pa.float64(), mask=unknown)], ["doc_id", "lang_pred", "score", "bits"])

    scored = coded.mapInArrow(score, out)
    return scored.select("doc_id", _held(), "lang_pred", "score", "bits")


def _held() -> Column:
    return held_out(F.col("doc_id")).alias("held_out")
