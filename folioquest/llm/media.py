"""Media columns: Netpbm and BMP bytes to numpy arrays, area resizing, NPY tiles, difference hashes.

Decoding covers P1 to P6 (8- and 16-bit samples) and uncompressed BMP of 8 (palette), 24 and 32 bits.
Resizing integrates: sums along columns are interpolated at the cell borders, then sums along rows, so every
source pixel counts by the area it shares with the cell. Rows are taken in strips; beside the image memory holds one
number for each row and each column of the result.

A text becomes an image of 192 RGB pixels (576 bytes) a row: an even number of rows as P6, an odd one as 24-bit BMP.
Null and empty texts give one row of 255s; equal texts give equal values; repeated rows are kept as rows of their own.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from folioquest.llm import common

WIDTH = 192
ROW = WIDTH * 3
STRIP = 4096


def pad(data: bytes) -> bytes:
    """Bytes 255 up to a positive multiple of a row."""
    return data + b"\xff" * (max(1, -(-len(data) // ROW)) * ROW - len(data))


def encode_ppm(pixels: np.ndarray) -> bytes:
    h, w, _ = pixels.shape
    return b"P6\n%d %d\n255\n" % (w, h) + pixels.tobytes()


def encode_pgm(pixels: np.ndarray) -> bytes:
    h, w = pixels.shape[:2]
    return b"P5\n%d %d\n255\n" % (w, h) + pixels.reshape(h, w).tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """24 bits a pixel, bottom row first, rows padded to four bytes."""
    h, w, _ = pixels.shape
    rows = np.zeros((h, -(-w * 3 // 4) * 4), np.uint8)
    rows[:, : w * 3] = pixels[::-1, :, ::-1].reshape(h, w * 3)
    head = struct.pack("<2sIHHI", b"BM", 54 + rows.size, 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, rows.size, 2835, 2835, 0, 0) + rows.tobytes()


def _netpbm_head(data: bytes, n: int) -> tuple[list[int], int]:
    """n numbers after the magic number, and where the samples begin."""
    values, at = [], 2
    while len(values) < n:
        while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
            at = data.index(b"\n", at) + 1 if data[at : at + 1] == b"#" else at + 1
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        if end == at:
            raise ValueError("bad Netpbm header")
        values.append(int(data[at:end]))
        at = end
    return values, at


def decode_netpbm(data: bytes) -> np.ndarray:
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm file")
    head, at = _netpbm_head(data, 2 if kind in (b"P1", b"P4") else 3)
    w, h, most = (*head, 1)[:3]
    channels = 3 if kind in (b"P3", b"P6") else 1
    if kind == b"P4":
        bits = np.unpackbits(np.frombuffer(data, np.uint8, h * -(-w // 8), at + 1).reshape(h, -1), axis=1)[:, :w]
        return ((1 - bits) * 255).astype(np.uint8)[:, :, None]
    if kind in (b"P5", b"P6"):
        kind_of = np.dtype(">u2") if most > 255 else np.dtype(np.uint8)
        return np.frombuffer(data, kind_of, h * w * channels, at + 1).reshape(h, w, channels)
    body = data[at:].decode("ascii")
    values = [int(c) for c in body if c in "01"] if kind == b"P1" else [int(x) for x in body.split()]
    out = np.array(values[: h * w * channels], np.uint16 if most > 255 else np.uint8).reshape(h, w, channels)
    return (1 - out) * np.uint8(255) if kind == b"P1" else out


def decode_bmp(data: bytes) -> np.ndarray:
    if data[:2] != b"BM":
        raise ValueError("not a BMP file")
    (start,) = struct.unpack_from("<I", data, 10)
    size, w, h, _, bits, packed = struct.unpack_from("<IiiHHI", data, 14)
    if packed not in (0, 3) or bits not in (8, 24, 32):
        raise ValueError(f"BMP with {bits} bits and compression {packed}")
    stride, up = -(-w * bits // 32) * 4, h > 0
    rows = np.frombuffer(data, np.uint8, abs(h) * stride, start).reshape(abs(h), stride)
    rows = rows[::-1] if up else rows
    if bits == 8:
        (used,) = struct.unpack_from("<I", data, 46)
        palette = np.frombuffer(data, np.uint8, 4 * (used or 256), 14 + size).reshape(-1, 4)
        return palette[rows[:, :w]][:, :, 2::-1]
    return rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray:
    """Height x width x channels, in RGB order."""
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def _at(sums: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Running sums along the last axis (first one 0), read at fractional places."""
    low = np.minimum(edges.astype(np.int64), sums.shape[-1] - 2)
    return sums[..., low] + (edges - low) * (sums[..., low + 1] - sums[..., low])


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each cell of a height x width grid laid over an image, and over its channels where it has any."""
    h, w = image.shape[:2]
    columns = np.linspace(0, w, width + 1)
    strips = []
    for lo in range(0, h, STRIP):
        strip = image[lo : lo + STRIP]
        strip = strip.mean(axis=2) if strip.ndim == 3 else strip
        sums = np.zeros((len(strip), w + 1))
        np.cumsum(strip, axis=1, out=sums[:, 1:], dtype=np.float64)
        strips.append(np.diff(_at(sums, columns), axis=1))
    down = np.zeros((width, h + 1))
    np.cumsum(np.concatenate(strips).T, axis=1, out=down[:, 1:])
    cells = np.diff(_at(down, np.linspace(0, h, height + 1)), axis=1).T
    return cells * (height * width / (h * w))


def difference_hash(image: np.ndarray) -> tuple[int, np.ndarray]:
    """64 bits, one for each cell darker than its right neighbour on an 8 x 9 grid; and that grid."""
    tile = np.round(area_resize(image, 8, 9), 6)
    bits = np.packbits((tile[:, :-1] < tile[:, 1:]).ravel())
    return int.from_bytes(bits.tobytes(), "big"), tile.astype(np.float32)


def npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(array), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def text_to_media(text: str) -> bytes:
    pixels = np.frombuffer(pad(text.encode()), np.uint8).reshape(-1, WIDTH, 3)
    return encode_bmp(pixels) if len(pixels) % 2 else encode_ppm(pixels)


def media_columns(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media (the stored file), pixels' digests as read back, difference hash and NPY tile."""

    def make():
        def row(doc_id, text):
            media = text_to_media(text)
            image = decode(media)
            back = image.tobytes()
            value, tile = difference_hash(image)
            return doc_id, len(text.encode()), media, len(back), common.sha(back), zlib.crc32(back[-32:]), value.to_bytes(8, "big").hex(), npy(tile)

        return row

    return common.row_map(common.keyed_text(docs), make, "doc_id long, n_bytes long, media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, dhash string, tile binary")


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    return media_columns(common.documents(spark, sf_dir)).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.concat_ws(":", "dhash", F.substring(F.sha2("tile", 256), 1, 16)).alias("feature"))


QUERIES = {"op2_media_columns": op2_media_columns}
ORACLES: dict[str, str] = {}
