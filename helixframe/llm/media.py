"""Operator 3: media columns. Netpbm and BMP decoded to arrays, area-resized by integral images, tiled as NPY.

Images live in a binary column of a table in the shared folder, tiles in a column of another. A null or
malformed image (cut short, with samples out of range, or with sizes that its bytes can't fill) gives a row
with status 'bad' and null features. Null and empty texts become one row of spaces; equal texts become equal
images, so repeated rows and ties have equal features; texts are stored whole, whatever their length. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import keep, table, text_chunks

PIXELS_WIDE = 64  # 3 samples a pixel: 192 payload bytes a row
TILE = 16
STRIP_ROWS = 4096  # rows of an integral image held at a time
_HEAD = re.compile(rb"P([1-6])" + rb"(?:\s|#[^\n]*\n)+(\d+)" + rb"(?:\s|#[^\n]*\n)+(\d+)")


def ppm(rows: np.ndarray) -> bytes:
    """An H x W x 3 array of bytes as binary PPM."""
    return b"P6\n%d %d\n255\n" % (rows.shape[1], rows.shape[0]) + rows.tobytes()


def bmp(rows: np.ndarray) -> bytes:
    """An H x W x 3 array of bytes as a bottom-up 24-bit BMP."""
    h, w = rows.shape[:2]
    body = np.pad(rows[::-1, :, ::-1].reshape(h, w * 3), ((0, 0), (0, -w * 3 % 4))).tobytes()
    return struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 2835, 2835, 0, 0) + body


def decode_image(data: bytes) -> np.ndarray:
    """H x W x C bytes (C is 1 or 3) of a P1-P6 or uncompressed BMP image; ValueError if it is neither or malformed."""
    try:
        return _bmp(data) if data[:2] == b"BM" else _netpbm(data)
    except (OverflowError, struct.error) as e:
        raise ValueError("a number out of range, or a header cut short") from e


def _netpbm(data: bytes) -> np.ndarray:
    if not (m := _HEAD.match(data)):
        raise ValueError("neither Netpbm nor BMP")
    kind, w, h, at, top = int(m[1]), int(m[2]), int(m[3]), m.end(), 1
    if kind not in (1, 4):
        if not (m := re.compile(rb"(?:\s|#[^\n]*\n)+(\d+)").match(data, at)):
            raise ValueError("no maximum")
        top, at = int(m[1]), m.end()
    channels = 3 if kind in (3, 6) else 1
    n = w * h * channels
    if not 0 < top < 65536 or not 0 < n <= 8 * len(data):
        raise ValueError("bad header, or an image too large for its bytes")
    if kind == 1:
        found = re.findall(rb"[01]", re.sub(rb"#[^\n]*", b"", data[at:]))
        samples = np.array(found[:n], dtype="S1") != b"1"
    elif kind in (2, 3):
        samples = np.array(re.sub(rb"#[^\n]*", b"", data[at:]).split()[:n], dtype=np.int64)
    elif kind == 4:
        wide = (w + 7) // 8
        bits = np.unpackbits(np.frombuffer(data, np.uint8, wide * h, at + 1).reshape(h, wide), axis=1)[:, :w]
        samples = (bits == 0).ravel()
    else:
        samples = np.frombuffer(data, np.uint8 if top < 256 else ">u2", n, at + 1)
    if len(samples) < n or samples.max() > top or samples.min() < 0:
        raise ValueError("samples missing or out of range")
    if top != 255:
        samples = (samples.astype(np.int64) * 510 + top) // (2 * top)
    return samples.astype(np.uint8).reshape(h, w, channels)


def _bmp(data: bytes) -> np.ndarray:
    start, head, w, h, _, bits, packing = struct.unpack_from("<10xIIiiHHI", data)
    flip, h = h > 0, abs(h)
    if head < 40 or packing or bits not in (1, 4, 8, 24, 32) or w <= 0 or not h:
        raise ValueError("BMP of an unsupported kind")
    line = (w * bits + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, line * h, start).reshape(h, line)
    rows = rows[::-1] if flip else rows
    if bits >= 24:
        return np.ascontiguousarray(rows[:, : w * bits // 8].reshape(h, w, bits // 8)[:, :, 2::-1])
    colours = struct.unpack_from("<I", data, 46)[0] or 1 << bits
    table_ = np.frombuffer(data, np.uint8, colours * 4, 14 + head).reshape(-1, 4)[:, 2::-1]
    index = rows if bits == 8 else np.unpackbits(rows, axis=1).reshape(h, -1, bits) @ (1 << np.arange(bits)[::-1])
    index = index[:, :w]
    if index.max() >= len(table_):
        raise ValueError("colour out of the table")
    return table_[index]


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Each output sample is the mean over its exact area, from four values of the integral image.

    The integral is built strip by strip and read only at the rows that output borders touch, so
    memory does not grow with the image's height.
    """
    h, w, c = image.shape
    ys = np.arange(height + 1) * h / height
    low = np.minimum(ys.astype(np.int64), h - 1)
    part = (ys - low)[:, None, None]
    need = np.unique(np.r_[low, low + 1])
    lines = np.zeros((len(need), w + 1, c))  # need[k] image rows summed, then along the row
    total = np.zeros((w, c), np.int64)
    for at in range(0, h, STRIP_ROWS):
        sums = np.cumsum(image[at : at + STRIP_ROWS], axis=0, dtype=np.int64) + total
        here = np.flatnonzero((need > at) & (need <= at + len(sums)))
        lines[here, 1:] = np.cumsum(sums[need[here] - at - 1], axis=1)
        total = sums[-1]
    position = {int(y): k for k, y in enumerate(need)}
    first, second = lines[[position[int(y)] for y in low]], lines[[position[int(y) + 1] for y in low]]
    rows = first + (second - first) * part
    xs = np.arange(width + 1) * w / width
    left = np.minimum(xs.astype(np.int64), w - 1)
    grid = rows[:, left] + (rows[:, left + 1] - rows[:, left]) * (xs - left)[None, :, None]
    mean = np.diff(np.diff(grid, axis=0), axis=1) * (height * width / (h * w))
    return np.clip(np.floor(mean + 0.5), 0, 255).astype(np.uint8)


def difference_hash(image: np.ndarray) -> str:
    """64 bits: whether each of 8 x 8 grey cells is darker than its right neighbour."""
    small = area_resize(image, 8, 9).astype(np.int64)
    grey = (small @ [299, 587, 114]) // 1000 if small.shape[2] == 3 else small[:, :, 0]
    return np.packbits(grey[:, :-1] < grey[:, 1:]).tobytes().hex()


def npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, array, version=(1, 0), allow_pickle=False)
    return out.getvalue()


def payload_image(text: str) -> tuple[int, bytes]:
    """(UTF-8 length, image) of a text: its bytes and spaces up to a positive multiple of 192, as samples.

    Texts of an even number of rows become PPM, the others BMP.
    """
    raw = text.encode()
    rows = np.frombuffer(raw.ljust(max(1, -(-len(raw) // 192)) * 192, b" "), np.uint8).reshape(-1, PIXELS_WIDE, 3)
    return len(raw), (bmp if len(rows) % 2 else ppm)(rows)


def store_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A table in the shared folder: (key, n_bytes, media)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch, text):
                sizes, images = zip(*map(payload_image, texts), strict=True)
                ids = batch.column(batch.schema.get_field_index(key)).slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(images, pa.binary())], names=[key, "n_bytes", "media"])

    return keep(docs.select(key, text).mapInArrow(run, f"{key} long, n_bytes long, media binary"), "media")


def _rows(batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple]:
    """One row at a time: images may be large."""
    at = [batch.column(batch.schema.get_field_index(c)) for c in columns]
    for i in range(batch.num_rows):
        yield tuple(a[i].as_py() for a in at)


def tiles(media: DataFrame, key: str = "doc_id", column: str = "media", size: int = TILE) -> DataFrame:
    """(key, status, height, width, channels, tile, dhash): an NPY tile of size x size and a difference hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, data in _rows(batch, [key, column]):
                try:
                    image = decode_image(data or b"")
                    out.append((k, "ok", *image.shape, npy(area_resize(image, size, size)), difference_hash(image)))
                except ValueError:
                    out.append((k, "bad", None, None, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names) if out else pa.RecordBatch.from_arrays([pa.array([], t) for t in types], names=names)

    names = [key, "status", "height", "width", "channels", "tile", "dhash"]
    types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
    return media.select(key, column).mapInArrow(run, f"{key} long, status string, height int, width int, channels int, tile binary, dhash string")


def payload_features(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """A table in the shared folder: digests of what the stored images hold, each image's difference hash, and its NPY tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, n, data in _rows(batch, [key, "n_bytes", "media"]):
                image = decode_image(data)
                payload = image.tobytes()
                out.append((k, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), difference_hash(image), npy(area_resize(image, TILE, TILE))))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 9, types, strict=True)], names=names)

    i, s = pa.int64(), pa.string()
    names = [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile"]
    types = [i, i, i, s, i, i, s, s, pa.binary()]
    schema = f"{key} long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary"
    return keep(media.select(key, "n_bytes", "media").mapInArrow(run, schema), "tiles")


def op3_media_columns(spark, sf_dir: str) -> DataFrame:
    out = payload_features(store_texts(table(spark, sf_dir, "documents")))
    return out.withColumn("tile_sha256", F.sha2("tile", 256)).drop("tile")
