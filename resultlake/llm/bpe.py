"""Byte-level BPE encoding and decoding over padded numpy matrices.

The distinct pieces of a batch are grouped by length and laid out as matrices of token ids.
In each round every row of a matrix merges its leftmost pair of least rank; ranks come from
a hash table over pairs of ids, and rows are compacted by one column. Rows without a pair
that merges leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm import pieces as P

#: No pair: above every rank.
NONE = np.int32(0x7FFFFFFF)
#: Bytes of a vocabulary file that may be sent to executors.
MOST_BYTES = 64 << 20
#: Rows of one matrix, and the longest piece in a matrix. The rounds over a longer piece, which
#: cost the square of its length, are made by a queue of its pairs instead, in the same order.
MATRIX_ROWS, LONGEST = 1 << 16, 1024
#: Pieces whose ids a worker keeps between batches.
REMEMBERED = 1 << 18
#: Bytes of texts, or of ids, that are coded at once: their pieces take many times as much.
STEP_BYTES = 1 << 20


class Vocabulary:
    """Ranks of byte strings, the pairs that merge, and the bytes of each id."""

    def __init__(self, file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines()) if a}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        by_id: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.ends = np.cumsum([len(t) for t in by_id]).astype(np.int64)
        self.lengths = np.diff(self.ends, prepend=0)
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self._fill(np.array(keys, np.uint64), np.array(values, np.int32))
        self.memory: dict[bytes, bytes] = {}  # ids as bytes: an array would hold the matrix that it is a row of

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open table with linear probing, a quarter full at most."""
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(1 << self.bits, NONE)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, one = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[one]
            self.keys[slot[put]] = keys[todo[put]]
            self.values[slot[put]] = values[todo[put]]
            stay = np.ones(len(todo), bool)
            stay[put] = False
            todo, slot = todo[stay], (slot[stay] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, which is the id of what they merge into."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], NONE)
        todo = np.flatnonzero((self.keys[slot] != keys) & (self.values[slot] != NONE))
        for step in range(1, self.probes):
            if not len(todo):
                break
            at = (slot[todo] + step) & ((1 << self.bits) - 1)
            hit = self.keys[at] == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            todo = todo[~hit & (self.values[at] != NONE)]
        return out

    def merge(self, ids: np.ndarray) -> list[np.ndarray]:
        """The token ids of each row of a matrix of byte ids."""
        rows = np.arange(len(ids))
        out: list[np.ndarray] = [ids[0]] * len(ids)
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while True:
            best = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            least = ranks[np.arange(len(ids)), best] if ranks.shape[1] else np.full(len(ids), NONE)
            over = least == NONE
            if over.any():
                for r, done in zip(rows[over].tolist(), ids[over]):
                    out[r] = done
                go = ~over
                rows, ids, ranks, best, least = rows[go], ids[go], ranks[go], best[go], least[go]
            if not len(rows):
                return out
            n, width = ids.shape
            every = np.arange(n)
            ids[every, best] = least
            kept = np.ones((n, width), bool)
            kept[every, best + 1] = False
            ids = ids[kept].reshape(n, width - 1)
            kept = np.ones((n, width - 1), bool)
            kept[every, best] = False
            ranks = ranks[kept].reshape(n, width - 2)
            right = np.flatnonzero(best < width - 2)  # the merged id and what follows it
            ranks[right, best[right]] = self.rank(ids[right, best[right]], ids[right, best[right] + 1])
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self.rank(ids[left, best[left] - 1], ids[left, best[left]])

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """The same for one long row: a queue of (rank, position) over linked neighbours."""
        token = ids.tolist()
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.rank(ids[:-1], ids[1:]).tolist()
        queue = [(r, i) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(queue)
        ranks.append(int(NONE))

        def renew(i: int) -> None:
            j = after[i]
            ranks[i] = int(self.rank(np.array([token[i]]), np.array([token[j]]))[0]) if j < n else int(NONE)
            if ranks[i] != NONE:
                heapq.heappush(queue, (ranks[i], i))

        while queue:
            r, i = heapq.heappop(queue)
            if token[i] < 0 or ranks[i] != r:
                continue
            j = after[i]
            token[i], token[j], after[i] = r, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return np.array([t for t in token if t >= 0], np.int32)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each text)."""
        made = P.split(column, spaced=True, table=P.byte_level_classes())
        first, which = made.distinct()
        own = made.bytes_of(first)
        starts, lengths = made.starts[first], (made.ends - made.starts)[first]
        ids: list[bytes] = [self.memory.get(x) for x in own]
        new = np.array([i for i, x in enumerate(ids) if x is None], np.int64)
        new = new[np.argsort(lengths[new], kind="stable")]
        cuts = np.flatnonzero(np.diff(lengths[new])) + 1
        for group in np.split(new, cuts) if len(new) else []:
            width = int(lengths[group[0]])
            step = max(1, min(MATRIX_ROWS, (1 << 22) // width))
            for some in np.split(group, range(step, len(group), step)):
                matrix = self.byte_id[made.data[starts[some][:, None] + np.arange(width)]]
                for i, x in zip(some.tolist(), self.merge(matrix) if width <= LONGEST else map(self.merge_long, matrix)):
                    ids[i] = x.tobytes()
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory = {}
        for i in new[lengths[new] <= 64][:REMEMBERED].tolist():
            self.memory[own[i]] = ids[i]
        sizes = np.array([len(x) for x in ids], np.int64) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        begin = np.cumsum(sizes) - sizes
        per = sizes[which]
        total = np.concatenate([[0], np.cumsum(per)])
        gather = np.repeat(begin[which] - total[:-1], per) + np.arange(total[-1])
        ends = np.concatenate([[0], np.cumsum(made.counts)])
        return flat[gather], np.diff(total[ends])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts whose ids these are."""
        per = self.lengths[ids]
        total = np.concatenate([[0], np.cumsum(per)])
        gather = np.repeat(self.ends[ids] - per - total[:-1], per) + np.arange(total[-1])
        return self.bytes[gather], total[np.concatenate([[0], np.cumsum(counts)])]


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(sent: Broadcast) -> Vocabulary:
    """The vocabulary of this worker, built once."""
    key = hash(sent.value)
    if key not in _loaded:
        _loaded[key] = Vocabulary(sent.value)
    return _loaded[key]


def send_file(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file, which only the driver needs to have; of bounded size."""
    with open(path, "rb") as f:
        held = f.read(MOST_BYTES + 1)
    if len(held) > MOST_BYTES:
        raise ValueError(f"vocabulary file over {MOST_BYTES} bytes: {path}")
    return spark.sparkContext.broadcast(held)


def _coded(own: Vocabulary, it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in B.pieces(it, "text", STEP_BYTES):
        ids, counts = own.encode(b.column("text"))
        offsets = np.concatenate([[0], np.cumsum(counts)]) * 4
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts), B.binary(ids.astype("<u4").view(np.uint8), offsets)], ["doc_id", "n_tokens", "ids"])


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids for each row of ``docs``; ids are little-endian unsigned 32-bit integers.

    Ids are those of ordinary encoding: strings of special tokens are ordinary text. Null
    and empty texts have no ids. Rows are independent, so repeats and ties need nothing,
    and an empty table gives an empty result. Other columns are ignored.
    """
    B.small_batches(docs.sparkSession)
    sent = send_file(docs.sparkSession, vocabulary)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _coded(_vocabulary(sent), it)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the bytes of the text as ``decoded``; null ids give none."""
    B.small_batches(encoded.sparkSession)
    sent = send_file(encoded.sparkSession, vocabulary)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _vocabulary(sent)
        for b in B.pieces(it, "ids", STEP_BYTES):
            held, offsets = B.buffer(b.column("ids"))
            data, at = own.decode(held.view("<u4").astype(np.int64), np.diff(offsets) // 4)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_tokens"), b.column("ids"), B.binary(data, at)], ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")
