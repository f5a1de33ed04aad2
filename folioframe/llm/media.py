"""Media columns: payloads stored as progressive JPEG files and read back.

A payload's bytes become quantised coefficients, the format's own unit: byte b
is b - 128 below 128 and b - 127 from there on (never zero), and an MCU's four
luma and two chroma blocks (4:2:0) take 384 bytes, luma first; spaces fill the
last MCUs up. The file's comment holds the payload's length before and after it
was padded to a multiple of 192. Reading gives the coefficients, so the payload
without loss, and the full-resolution RGB tensor with its chroma upsampled,
which the features are computed from.

Defined results: null text counts as empty and is one MCU of spaces; equal
texts give equal files and features; a long text is one image (the largest one,
of 65,520 by 65,520 samples, holds more than a string of Spark's); repeated
rows give a row each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import progressive_jpeg
from ._common import id_bytes, map_slices

#: Bytes that a payload is padded to; bytes of an MCU.
UNIT, MCU = 192, 384
#: Bytes of payload that are coded at a time.
AT_ONCE = 1 << 20
_SPACE = b" "


def encode(payloads: list[bytes]) -> list[bytes]:
    """Progressive JPEG files that hold the payloads, padded by spaces to whole MCUs."""
    if not payloads:
        return []
    sizes = [max(1, -(-len(p) // UNIT)) * UNIT for p in payloads]
    grids = [((c := math.isqrt(n - 1) + 1), -(-n // c)) for n in (-(-size // MCU) for size in sizes)]
    padded = b"".join(p.ljust(c * r * MCU, _SPACE) for p, (c, r) in zip(payloads, grids, strict=True))
    value = np.frombuffer(padded, "u1").astype("i2") - 128
    value += value >= 0
    comments = [b"payload %d %d" % (len(p), size) for p, size in zip(payloads, sizes, strict=True)]
    return progressive_jpeg.write(value.reshape(-1, 64), grids, comments)


def decode(files: list[bytes]) -> tuple[list[bytes], list[int], list[np.ndarray]]:
    """The padded payloads, their lengths before padding, and the RGB tensors."""
    images, coef = progressive_jpeg.read(files)
    value = (coef - (coef > 0) + 128).astype("u1")
    payloads, lengths = [], []
    for image in images:
        _, n, padded = image.comment.split()
        a = image.bases[0]
        payloads.append(value[a : a + -(-int(padded) // 64)].tobytes()[: int(padded)])
        lengths.append(int(n))
    return payloads, lengths, progressive_jpeg.rgb(images, coef)


def feature(tensor: np.ndarray) -> str:
    """Width, height, mean colour, and one bit for each of 8x8 cells: brighter than the one before."""
    height, width, _ = tensor.shape
    mean = tensor.reshape(-1, 3).sum(axis=0, dtype="i8") * 1000 // (height * width)
    green = tensor[:, :, 1].astype("i8")
    cells = np.add.reduceat(np.add.reduceat(green, np.arange(8) * height // 8, axis=0), np.arange(8) * width // 8, axis=1).ravel()
    bits = int("".join("1" if a > b else "0" for a, b in zip(cells[1:], cells, strict=False)) or "0", 2)
    return f"{width}x{height} {mean[0]},{mean[1]},{mean[2]} {bits:016x}"


def media_column(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, media): each text as a progressive JPEG file."""

    def store(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), pa.array(encode(batch.column(1).to_pylist()), pa.binary())], ["doc_id", "media"])

    rows = id_bytes(df, id_col, text_col)
    return map_slices(rows, store, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, media binary", AT_ONCE)


def read_media(df: DataFrame, tensors: bool = False) -> DataFrame:
    """(doc_id, n_bytes, payload, media_bytes, media_sha256, feature), with tensors also height, width and rgb, of (doc_id, media)."""

    def load(batch: pa.RecordBatch) -> pa.RecordBatch:
        files = batch.column(1).to_pylist()
        payloads, lengths, images = decode(files)
        columns = [batch.column(0), pa.array(lengths, pa.int64()), pa.array(payloads, pa.binary()), pa.array([feature(x) for x in images]), batch.column(1)]
        names = ["doc_id", "n_bytes", "payload", "feature", "media"]
        if tensors:
            columns += [pa.array([x.shape[0] for x in images], pa.int32()), pa.array([x.shape[1] for x in images], pa.int32()), pa.array([x.tobytes() for x in images], pa.binary())]
            names += ["height", "width", "rgb"]
        return pa.record_batch(columns, names)

    rows = df.select("doc_id", F.col("media").alias("data"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, payload binary, feature string, media binary" + ", height int, width int, rgb binary" * tensors
    return map_slices(rows, load, schema, AT_ONCE)


def digests(df: DataFrame) -> DataFrame:
    """The digest columns of read_media()'s rows, and the tensors where they have them."""
    tensor = [c for c in ("height", "width", "rgb") if c in df.columns]
    return df.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -16)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature", *tensor,
    )
