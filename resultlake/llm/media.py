"""Media columns: payloads as progressive JPEG files, and files as RGB tensors.

A payload is held in the format's unit, the 8 x 8 block of quantised coefficients: each of
its bytes, as a signed number, is one coefficient. Progressive scans keep coefficients
exactly, so the payload is read back from the file without loss.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm import jpeg as J

#: Bytes of payload or file that one step works on.
STEP_BYTES = 1 << 20
UNIT_BYTES = 64 * len(J.UNIT)


def write_files(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(files, payload bytes) of texts, each filled up with zeros to a positive multiple of 64 bytes."""
    lengths = np.diff(offsets)
    payload = np.maximum(64, -(-lengths // 64) * 64)
    units = -(-payload // UNIT_BYTES)
    units = np.array([h * w for h, w in map(J.grid, units.tolist())], np.int64)
    room = units * UNIT_BYTES
    begin = np.cumsum(room) - room
    flat = np.zeros(int(room.sum()), np.uint8)
    at = np.arange(len(data)) + np.repeat(begin - offsets[:-1], lengths)
    flat[at] = data
    notes = [b"payload %d text %d" % (p, n) for p, n in zip(payload.tolist(), lengths.tolist())]
    return J.encode(flat.view(np.int8).reshape(-1, 64), units, notes), payload


def read_payload(image: J.Image) -> np.ndarray | None:
    """The payload's bytes from the coefficients, in coding order of units; None for files that :func:`write_files` did not make."""
    said = image.note.split()
    if len(said) != 4 or said[0] != b"payload" or not said[1].isdigit():
        return None
    rows, columns = image.units
    parts = []
    for c, (h, v) in enumerate(image.sampling):
        parts.append(image.blocks[c].reshape(rows, v, columns, h, 64).transpose(0, 2, 1, 3, 4).reshape(rows * columns, h * v, 64))
    flat = np.concatenate(parts, 1).astype(np.int8).view(np.uint8).ravel()
    return flat[: int(said[1])]


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media for each row of ``docs``: the text's UTF-8 bytes as a progressive JPEG file.

    Null counts as empty, whose payload is 64 zeros. Rows are independent: equal texts give
    equal files, repeated ids a row each. An empty table gives an empty result. Other
    columns are ignored.
    """

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "text", STEP_BYTES):
            data, offsets = B.buffer(b.column("text"))
            files, _ = write_files(data, offsets)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(offsets)), pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])

    B.small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_bytes long, media binary")


DECODED = "doc_id long, n_bytes long, media binary, payload binary, height int, width int, rgb binary"


def decode_media(media: DataFrame, then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, schema: str = DECODED) -> DataFrame:
    """``media`` (doc_id, n_bytes, media) with payload, height, width and rgb.

    ``rgb`` is the tensor of height x width x 3 unsigned bytes in row-major order, at full
    resolution; ``payload`` is read from the coefficients of the stored bytes, and null for
    files that hold none, which any other progressive JPEG is. A null file gives nulls. ``then`` turns each batch of such rows into rows of ``schema`` in the worker
    that has decoded them, so that tensors of which only something is wanted do not leave it.
    """
    names = [c.split()[0] for c in DECODED.split(", ")]
    made = then or (lambda b: b)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "media", STEP_BYTES):
            there = b.filter(b.column("media").is_valid())
            if len(there) < len(b):
                lost = b.filter(b.column("media").is_null())
                none = [pa.nulls(len(lost), kind) for kind in (pa.binary(), pa.int32(), pa.int32(), pa.binary())]
                yield made(pa.RecordBatch.from_arrays([*lost.columns, *none], names))
            data, offsets = B.buffer(there.column("media"))
            images, scans = J.parse(data, offsets)
            J.decode_scans(data, images, scans)
            read = [read_payload(i) for i in images]
            payload = [None if x is None else x.tobytes() for x in read]
            rgb = [x.tobytes() for x in J.to_rgb(images)]
            yield made(pa.RecordBatch.from_arrays([*there.columns, pa.array(payload, pa.binary()), pa.array([i.height for i in images], pa.int32()), pa.array([i.width for i in images], pa.int32()), pa.array(rgb, pa.binary())], names))

    B.small_batches(media.sparkSession)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def features(b: pa.RecordBatch) -> pa.RecordBatch:
    """Decoded rows with a feature of their tensor: size, sums of channels, levels of green."""
    out = []
    held, offsets = B.buffer(b.column("rgb"))
    for s, e, h, w in zip(offsets[:-1], offsets[1:], b.column("height").to_pylist(), b.column("width").to_pylist()):
        if h is None:
            out.append(None)
            continue
        flat = held[s:e].reshape(-1, 3)
        total = flat.sum(0, dtype=np.int64)
        levels = np.bincount(flat[:, 1] >> 5, minlength=8)
        out.append(f"{h}x{w};sum={total[0]},{total[1]},{total[2]};green={','.join(map(str, levels.tolist()))}")
    return pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, "feature"])


def describe(media: DataFrame) -> DataFrame:
    """Digests of payload and file, a feature of the tensor and the tensor, for each file of :func:`encode_media`.

    Rows are independent; a null file gives nulls, repeated ids a row each, an empty table
    an empty result. ``rgb`` is height x width x 3 unsigned bytes in row-major order.
    """
    seen = decode_media(media, features, f"{DECODED}, feature string")
    length = F.octet_length("payload")
    return seen.select(
        "doc_id",
        "n_bytes",
        length.cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring(F.col("payload"), length - 63, F.lit(64))).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "height",
        "width",
        "rgb",
    )
