"""Token counts from a cache of digests.

A text is known by the digest of its normalised form and the digest of the tokenizer file.
Counts that the cache holds are joined; of the others each distinct text is encoded once,
and its count is appended to the cache.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm import pieces as P
from resultlake.llm import scratch
from resultlake.llm.bpe import send_file
from resultlake.llm.skew import facts_join

#: Runs of white space are one blank to the tokenizer, so they are one in the normalised text.
BLANKS = r"[\x20\x09-\x0D]+"
#: Pieces whose counts a worker keeps between batches.
REMEMBERED = 1 << 19
CACHE = "content_digest binary, tokenizer_digest string, n_tokens long"


def strange_points(tokenizer) -> np.ndarray:  # noqa: ANN001
    """Code points whose texts go to the library whole.

    Those are characters that it normalises to anything but one character, or to one whose
    class is not that of the character in :func:`pieces.classes`, and those that Python's
    tables of characters lack, so that its test for composed texts says nothing.
    """
    from tokenizers import Regex, pre_tokenizers

    strange = np.ones(0x110000, bool)
    points = np.array([i for i in P.POINTS if i and unicodedata.category(chr(i)) != "Cn"])
    plain = "\0".join(map(chr, points.tolist()))
    forms = tokenizer.normalizer.normalize_str(plain).split("\0")
    single = np.array([len(f) == 1 for f in forms])
    now = np.array([ord(f) if len(f) == 1 else 0 for f in forms])
    kind = np.full(0x110000, P.OTHER, np.uint8)
    for pattern, value in ((r"\s", P.SPACE), (r"\p{L}", P.LETTER), (r"\p{N}", P.NUMBER)):
        cut = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        shown = "".join(x for x, _ in cut.pre_tokenize_str(plain))
        kind[np.frombuffer(shown.encode("utf-32-le"), np.uint32)] = value
    strange[points] = ~single | (kind[now] != P.classes()[points])
    return strange


@cache
def _strange_bits(file: bytes) -> bytes:
    """:func:`strange_points` of a tokenizer file, a bit for each code point; made once on the driver."""
    return np.packbits(strange_points(_tokenizer(file))).tobytes()


def _tokenizer(file: bytes):  # noqa: ANN202
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(file.decode())
    made.no_truncation()
    made.no_padding()
    return made


class Counter:
    """Counts tokens of a word-level BPE by its distinct pieces; the library encodes each piece.

    The tokenizer composes characters, lower-cases and drops white space before it splits;
    texts in which that could move a border between pieces, and texts that may hold special
    tokens, go to the library whole.
    """

    def __init__(self, file: bytes, strange: bytes):
        self.tokenizer = _tokenizer(file)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends_word = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.ends_word[i] = token.endswith("</w>")
        self.memory: dict[bytes, int] = {}
        self.strange = np.unpackbits(np.frombuffer(strange, np.uint8)).astype(bool)

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def pieces(self, texts: list[str]) -> list[int]:
        """Tokens of each piece: all are encoded as one text and cut at the ends of words."""
        ids = np.array(self.tokenizer.encode(" ".join(texts), add_special_tokens=False).ids, np.int64)
        ends = np.flatnonzero(self.ends_word[ids])
        if len(ends) != len(texts):
            return self.whole(texts)
        return np.diff(ends, prepend=-1).tolist()

    def _alone(self, texts: pa.Array) -> np.ndarray:
        """Which texts go to the library whole."""
        alone = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False).copy()
        data, offsets = B.buffer(texts)
        if (data & 0x80).any():
            points, _, at = P.points_of(data, offsets)
            odd = np.concatenate([[0], np.cumsum(self.strange[points])])[at]
            alone |= np.diff(odd) > 0
            ascii_only = pc.string_is_ascii(texts).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(~ascii_only & ~alone):
                alone[i] = not unicodedata.is_normalized("NFC", texts[int(i)].as_py())
        return alone

    def count(self, column: pa.Array) -> np.ndarray:
        texts = pc.fill_null(column, "")
        alone = self._alone(texts)
        out = np.zeros(len(texts), np.int64)
        if alone.any():
            at = np.flatnonzero(alone)
            out[at] = self.whole(texts.take(pa.array(at)).to_pylist())
        at = np.flatnonzero(~alone)
        made = P.split(texts.take(pa.array(at)) if alone.any() else texts, spaced=False)
        first, which = made.distinct()
        own = made.bytes_of(first)
        counts = [self.memory.get(x) for x in own]
        new = [i for i, c in enumerate(counts) if c is None]
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory = {}
        for lo in range(0, len(new), 4096):
            some = new[lo : lo + 4096]
            for i, c in zip(some, self.pieces([own[i].decode() for i in some])):
                counts[i] = c
                if len(own[i]) <= 64:
                    self.memory[own[i]] = c
        total = np.concatenate([[0], np.cumsum(np.array(counts, np.int64)[which])]) if len(own) else np.zeros(1, np.int64)
        ends = np.concatenate([[0], np.cumsum(made.counts)])
        out[at] = np.diff(total[ends])
        return out


_loaded: dict[int, Counter] = {}


def _counter(sent: Broadcast, strange: bytes) -> Counter:
    key = hash(sent.value)
    if key not in _loaded:
        _loaded[key] = Counter(sent.value, strange)
    return _loaded[key]


def normalised(text: Column) -> Column:
    """The text with each run of white space as one blank; its tokens are the same."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def read_cache(spark: SparkSession, where: str) -> DataFrame:
    """The cache's rows as it is now; none where it was never written.

    Each append is a folder of its own, and the folders that are complete are named to the
    reader: two readings at different times are never taken for the same.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(where)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    appends = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
    done = sorted(p.toString() for p in appends if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    return spark.read.schema(CACHE).parquet(*done) if done else spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``.

    ``tokenizer`` is a file of the library tokenizers, ``cache`` a folder of counts that is
    read and appended to; without one a new folder in the shared scratch folder is used.
    Null counts as empty, which has no tokens. Equal texts are encoded once. A doc_id that
    repeats gets a row each time. An empty table gives an empty result. Other columns are
    ignored. Two jobs that append the same digest add equal rows, which are read as one.
    """
    spark = docs.sparkSession
    B.small_batches(spark)
    sent = send_file(spark, tokenizer)
    strange = spark.sparkContext.broadcast(_strange_bits(sent.value))  # a bit for each code point
    version = hashlib.sha256(sent.value).hexdigest()
    cache = cache or scratch.path(spark, "token-counts")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("content_digest")
    keyed = scratch.stored(base.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest), "digests")

    def known() -> DataFrame:
        of = read_cache(spark, cache).filter(F.col("tokenizer_digest") == version)
        return of.groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens"))

    # rows of a digest are counted before any join, so a text that is very frequent is one row here
    sizes = scratch.stored(keyed.groupBy("content_digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "sizes")
    missed = sizes.join(known(), "content_digest", "left_anti").select(F.col("doc_id").alias("id"), F.col("content_digest").alias("wanted"))

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _counter(sent, strange.value)
        last = None
        for b in B.pieces(it, "text"):
            # equal rows come one after another
            digests = b.column("wanted").to_pylist()
            first = [i for i, d in enumerate(digests) if d != (digests[i - 1] if i else last)]
            last = digests[-1] if digests else last
            if first:
                b = b.take(pa.array(first, pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column("wanted"), pa.array(own.count(b.column("text")))], ["content_digest", "n_tokens"])

    # id and digest are both keys: an id that many rows share, or that many lack, is many keys
    texts = base.withColumn("own", digest).join(missed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("wanted"))).select("wanted", "text")
    counted = texts.mapInArrow(run, "content_digest binary, n_tokens long")
    counted.select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens").write.parquet(f"{cache}/append={uuid.uuid4().hex}")

    joined = facts_join(keyed, known(), ["content_digest"], sizes)
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
