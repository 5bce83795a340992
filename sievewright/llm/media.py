"""Media columns: Netpbm and BMP pictures to numpy arrays, area resizing by integral images,
NPY tiles and difference hashes.

Decoders take plain and raw Netpbm (P1-P6) with comments and any largest sample up to 65535, and
uncompressed BMP of 1, 4, 8, 16, 24 or 32 bits, either row order, 16 and 32 bits also with masks
(BITFIELDS). ``decode`` gives the samples as they are stored, ``plane`` the grey values from 0 to 255,
whatever the largest sample. A tile is the area mean of a picture at ``side`` x ``side``, saved as NPY
bytes; the difference hash compares the neighbours of a 9 x 8 area mean.

Defined results: a broken, empty or null picture gets null height, width, tile and hash. A null or empty
text is stored as one square of filling. Equal texts give equal pictures, repeated rows repeated rows;
an empty table gives no rows; a very long text is one tall picture, so memory follows the longest text.
Other columns are kept where an operator says so, those named as its results are replaced.
"""

from __future__ import annotations

import hashlib
import io
import zlib

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts, utf8

SIDE, UNIT, FILL = 16, 576, 255


def encode_pgm(samples: np.ndarray) -> bytes:
    rows, cols = samples.shape
    return b"P5\n%d %d\n255\n" % (cols, rows) + samples.astype(np.uint8).tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """An 8-bit grey BMP, bottom row first, rows padded to four bytes."""
    rows, cols = samples.shape
    wide = -(-cols // 4) * 4
    body = np.zeros((rows, wide), np.uint8)
    body[:, :cols] = samples[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4).copy()
    palette[:, 3] = 0
    head = np.array([40, cols, rows], "<i4").tobytes() + np.array([1, 8], "<u2").tobytes() + np.array([0, body.size, 2835, 2835, 256, 256], "<u4").tobytes()
    start = 14 + len(head) + palette.size
    return b"BM" + np.array([start + body.size, 0, start], "<u4").tobytes() + head + palette.tobytes() + body.tobytes()


def _netpbm_header(data: bytes, fields: int) -> tuple[list[int], int]:
    """The numbers after the magic, with comments skipped, and where the samples begin."""
    found: list[int] = []
    at = 2
    while len(found) < fields:
        while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
            if data[at : at + 1] == b"#":
                at = data.index(b"\n", at)
            at += 1
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        found.append(int(data[at:end]))
        at = end
    return found, at + 1


def read_netpbm(data: bytes) -> tuple[np.ndarray, int]:
    """Samples, rows x columns or rows x columns x 3, and the largest that the header allows."""
    kind = int(data[1:2])
    bitmap, colour, plain = kind in (1, 4), kind in (3, 6), kind < 4
    numbers, at = _netpbm_header(data, 2 if bitmap else 3)
    cols, rows = numbers[:2]
    most = 1 if bitmap else numbers[2]
    if not 1 <= most <= 65535 or rows < 1 or cols < 1:
        raise ValueError("no such picture")
    shape = (rows, cols, 3) if colour else (rows, cols)
    size = int(np.prod(shape))
    if plain and bitmap:
        raw = np.array([c - 48 for c in data[at - 1 :] if c in b"01"], np.uint8)
    elif plain:
        raw = np.array(data[at - 1 :].split(), np.int64)
    elif bitmap:
        wide = -(-cols // 8)
        raw = np.unpackbits(np.frombuffer(data, np.uint8, rows * wide, at).reshape(rows, wide), axis=1)[:, :cols].reshape(-1)
    else:
        raw = np.frombuffer(data, ">u2" if most > 255 else np.uint8, size, at)
    if raw.size < size:
        raise ValueError("the picture is cut short")
    samples = raw[:size].reshape(shape)
    if bitmap:
        return ((1 - samples) * 255).astype(np.uint8), 255
    if samples.max() > most or samples.min() < 0:
        raise ValueError("a sample is out of range")
    return samples.astype(np.uint16 if most > 255 else np.uint8), most


def _masked(values: np.ndarray, masks: list[int]) -> np.ndarray:
    """Channels under bit masks, each scaled to 0-255."""
    if not all(masks):
        raise ValueError("a mask is empty")
    channels = [(values & m) // (m & -m) * 255.0 / (m // (m & -m)) for m in masks]
    return np.rint(np.stack(channels, axis=2)).astype(np.uint8)


def decode_bmp(data: bytes) -> np.ndarray:
    """Rows x columns of grey samples, or rows x columns x 3."""
    start = int.from_bytes(data[10:14], "little")
    head = int.from_bytes(data[14:18], "little")
    cols, rows = (int(x) for x in np.frombuffer(data, "<i4", 2, 18))
    bits, packed = int.from_bytes(data[28:30], "little"), int.from_bytes(data[30:34], "little")
    if packed not in (0, 3) or bits not in (1, 4, 8, 16, 24, 32) or packed == 3 and bits not in (16, 32):
        raise ValueError("only uncompressed BMP")
    tall = abs(rows)
    if tall < 1 or cols < 1:
        raise ValueError("no such picture")
    wide = (cols * bits + 31) // 32 * 4
    body = np.frombuffer(data, np.uint8, tall * wide, start).reshape(tall, wide)
    if rows > 0:
        body = body[::-1]
    if packed == 3 or bits == 16:
        values = np.ascontiguousarray(body[:, : cols * bits // 8]).view("<u2" if bits == 16 else "<u4").astype(np.int64)
        return _masked(values, [int(m) for m in np.frombuffer(data, "<u4", 3, 54)] if packed == 3 else [0x7C00, 0x3E0, 0x1F])
    if bits >= 24:
        n = bits // 8
        return np.ascontiguousarray(body[:, : cols * n].reshape(tall, cols, n)[:, :, 2::-1])
    if bits < 8:
        plane = np.unpackbits(body, axis=1)
        index = plane if bits == 1 else plane.reshape(tall, -1, 4) @ np.array([8, 4, 2, 1], np.uint8)
    else:
        index = body
    index = index[:, :cols]
    used = int.from_bytes(data[46:50], "little") or 1 << bits
    palette = np.frombuffer(data, np.uint8, used * 4, 14 + head).reshape(used, 4)[:, 2::-1]
    if (palette == palette[:, :1]).all():
        return np.ascontiguousarray(palette[:, 0][index])
    return palette[index]


def read(data: bytes) -> tuple[np.ndarray, int]:
    """The samples of a picture and the largest possible one."""
    if data[:2] == b"BM":
        return decode_bmp(data), 255
    if data[:1] == b"P" and data[1:2] in (b"1", b"2", b"3", b"4", b"5", b"6"):
        return read_netpbm(data)
    raise ValueError("neither Netpbm nor BMP")


def decode(data: bytes) -> np.ndarray:
    return read(data)[0]


def plane(data: bytes) -> np.ndarray:
    """Grey values from 0 to 255."""
    samples, most = read(data)
    return grey(samples) if most == 255 else grey(samples) * (255 / most)


def integral(plane: np.ndarray) -> np.ndarray:
    """Sums over all samples above and left, with a leading row and column of zeros."""
    out = np.zeros((plane.shape[0] + 1, plane.shape[1] + 1))
    np.cumsum(plane, axis=0, dtype=np.float64, out=out[1:, 1:])
    np.cumsum(out[1:, 1:], axis=1, out=out[1:, 1:])
    return out


def _lookup(sums: np.ndarray, at: np.ndarray, axis: int) -> np.ndarray:
    low = np.minimum(at.astype(np.int64), sums.shape[axis] - 2)
    part = (at - low).reshape((-1, 1) if axis == 0 else (1, -1))
    return sums.take(low, axis) * (1 - part) + sums.take(low + 1, axis) * part


def area_resize(plane: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """Mean over the exact (fractional) area that each new sample covers."""
    sums = integral(plane)
    ys, xs = np.linspace(0, plane.shape[0], rows + 1), np.linspace(0, plane.shape[1], cols + 1)
    grid = _lookup(_lookup(sums, ys, 0), xs, 1)
    return np.diff(np.diff(grid, axis=0), axis=1) / (plane.shape[0] / rows * plane.shape[1] / cols)


def grey(picture: np.ndarray) -> np.ndarray:
    return picture if picture.ndim == 2 else picture @ np.array([0.299, 0.587, 0.114])


def difference_hash(plane: np.ndarray) -> str:
    small = area_resize(plane, 8, 9)
    return np.packbits(small[:, 1:] > small[:, :-1] + 1e-9).tobytes().hex()


def npy_tile(plane: np.ndarray, side: int = SIDE) -> bytes:
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(area_resize(plane, side, side)), 0, 255).astype(np.uint8))
    return out.getvalue()


def features_of(data: bytes | None, side: int = SIDE) -> tuple[int | None, int | None, bytes | None, str | None]:
    """Height, width, tile and difference hash of a picture."""
    try:
        values = plane(data)
        return values.shape[0], values.shape[1], npy_tile(values, side), difference_hash(values)
    except (ValueError, IndexError, TypeError, OverflowError, ZeroDivisionError):
        return None, None, None, None


def media_features(pictures: DataFrame, media: str = "media", side: int = SIDE) -> DataFrame:
    """Add height, width, tile (NPY bytes), dhash (16 hex digits) to rows that hold pictures;
    columns of those names are replaced. A picture that does not decode gets nulls."""

    def work(stored: list[bytes | None]) -> dict:
        return dict(zip(("height", "width", "tile", "dhash"), map(list, zip(*(features_of(x, side) for x in stored), strict=True)), strict=True))

    return map_texts(pictures, media, work, "height long, width long, tile binary, dhash string", pictures.columns)


def text_picture(text: str | None) -> tuple[int, bytes]:
    """UTF-8 bytes of a text and its picture: the bytes, filled with 255 to whole 24 x 24 squares, are
    the grey samples, 24 to a row. Texts with an even checksum become Netpbm, the others BMP, so that
    equal texts have equal pictures."""
    raw = utf8(text)
    full = raw + bytes([FILL]) * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))
    samples = np.frombuffer(full, np.uint8).reshape(-1, 24)
    return len(raw), (encode_bmp if zlib.crc32(raw) & 1 else encode_pgm)(samples)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_files: bool = True) -> DataFrame:
    """Store each text as a picture, read it back and compute features, in one pass: id, n_bytes,
    payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, dhash, tile_sha256 and, if
    asked for, the files media and tile."""
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "dhash", "tile_sha256", "media", "tile"]
    kinds = ["long", "long", "string", "long", "long", "string", "string", "string", "binary", "binary"]
    width = len(names) if with_files else len(names) - 2

    def work(texts: list[str | None]) -> dict:
        rows = []
        for text in texts:
            size, data = text_picture(text)
            payload = decode(data).tobytes()
            _, _, tile, dhash = features_of(data)
            digest = lambda x: hashlib.sha256(x).hexdigest()
            rows.append((size, len(payload), digest(payload), zlib.crc32(payload[-32:]), len(data), digest(data), dhash, digest(tile), data, tile)[:width])
        return dict(zip(names[:width], map(list, zip(*rows, strict=True)), strict=True))

    return map_texts(docs, text_col, work, ", ".join(f"{n} {k}" for n, k in zip(names[:width], kinds, strict=False)), [id_col])
