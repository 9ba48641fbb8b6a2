"""Media columns: Netpbm and BMP pictures in binary columns, decoded to numpy
arrays, resized by area with integral images, and written as NPY tiles with
difference hashes.

Defined results
    null media        null features (``encode_text`` turns null text into empty)
    undecodable media null features and a text in ``error``
    empty text        one row of 64 zero bytes
    equal payloads    equal media, tiles and hashes
Every row is handled by itself, so ties, repeated rows, empty tables and other
columns do not matter; operators read only the columns named to them and
return the key columns given plus their own.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, named, schema_of

#: Samples in a picture row that holds a text's bytes.
WIDTH = 64
#: Rows and columns of the tile from which the 64 difference bits come.
TILE = (8, 9)


# ---------------------------------------------------------------- encoders


def padded(data: bytes, unit: int = WIDTH) -> bytes:
    """``data`` with zero bytes up to a positive multiple of ``unit``."""
    return data + bytes(max(unit, -(-len(data) // unit) * unit) - len(data))


def encode_pgm(payload: bytes, width: int = WIDTH) -> bytes:
    """Raw grey-map with one byte a sample; ``payload`` fills whole rows."""
    if not payload or len(payload) % width:
        raise ValueError(f"payload must be a positive multiple of {width} bytes")
    return b"P5\n%d %d\n255\n" % (width, len(payload) // width) + payload


def encode_bmp(pixels: np.ndarray) -> bytes:
    """24-bit BMP of (h, w, 3), or 8-bit grey BMP of (h, w)."""
    h, w = pixels.shape[:2]
    grey = pixels.ndim == 2
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256)) if grey else b""
    line = w if grey else 3 * w
    rows = pixels[::-1] if grey else pixels[::-1, :, ::-1]
    body = b"".join(r.astype(np.uint8).tobytes() + bytes(-line % 4) for r in rows)
    head = 14 + 40 + len(palette)
    return (
        struct.pack("<2sIHHI", b"BM", head + len(body), 0, 0, head)
        + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8 if grey else 24, 0, len(body), 2835, 2835, 256 if grey else 0, 0)
        + palette
        + body
    )


# ---------------------------------------------------------------- decoders


def _value_errors(decoder: Callable[[bytes], np.ndarray]) -> Callable[[bytes], np.ndarray]:
    """Whatever a damaged picture does to a decoder, it is a ValueError."""

    @wraps(decoder)
    def run(data: bytes) -> np.ndarray:
        try:
            return decoder(data)
        except (struct.error, OverflowError, IndexError) as e:
            raise ValueError(f"damaged picture: {e}") from e

    return run


def _netpbm_fields(data: bytes, count: int) -> tuple[list[int], int]:
    """The header's numbers after the magic, and where the raster starts."""
    found, at = [], 2
    while len(found) < count:
        while at < len(data) and (data[at : at + 1].isspace() or data[at] == 0x23):
            if data[at] == 0x23:  # a comment runs to the end of its line
                while at < len(data) and data[at] not in b"\r\n":
                    at += 1
            else:
                at += 1
        start = at
        while at < len(data) and data[at : at + 1].isdigit():
            at += 1
        if start == at:
            raise ValueError("bad Netpbm header")
        found.append(int(data[start:at]))
    return found, at + 1


@_value_errors
def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6: (h, w) for bit and grey maps, (h, w, 3) for colour. Bits become
    0 (black) or 255; samples of two bytes become uint16."""
    kind = data[1:2]
    if data[:1] != b"P" or kind not in b"123456" or not kind:
        raise ValueError("not Netpbm")
    bits = kind in b"14"
    (w, h, *rest), at = _netpbm_fields(data, 2 if bits else 3)
    top = 1 if bits else rest[0]
    if w < 1 or h < 1 or not 0 < top < 65536:
        raise ValueError("bad Netpbm size")
    depth = 3 if kind in b"36" else 1
    n = w * h * depth
    if kind == b"1":  # digits need no space between them
        digits = np.frombuffer(data, np.uint8, offset=at - 1)
        samples = digits[(digits == 48) | (digits == 49)][:n] - 48
    elif kind in b"23":
        samples = np.array(data[at:].split()[:n], dtype=np.int64)
    elif kind == b"4":
        line = -(-w // 8)
        raw = np.frombuffer(data, np.uint8, count=min(line * h, len(data) - at), offset=at)
        if len(raw) < line * h:
            raise ValueError("Netpbm raster is cut short")
        samples = np.unpackbits(raw.reshape(h, line), axis=1)[:, :w].reshape(-1)
    else:
        kind_of = np.dtype(">u2") if top > 255 else np.dtype(np.uint8)
        if len(data) - at < n * kind_of.itemsize:
            raise ValueError("Netpbm raster is cut short")
        samples = np.frombuffer(data, kind_of, count=n, offset=at)
    if len(samples) < n:
        raise ValueError("Netpbm raster is cut short")
    if n and not 0 <= int(samples.min()) <= int(samples.max()) <= top:
        raise ValueError("Netpbm sample above its maximum")
    if bits:
        samples = (1 - samples.astype(np.uint8)) * np.uint8(255)
    samples = samples.astype(np.uint16 if top > 255 else np.uint8, copy=False)
    return samples.reshape((h, w, 3) if depth == 3 else (h, w))


def _channel(values: np.ndarray, mask: int) -> np.ndarray:
    """The masked bits of each number, as 0 to 255."""
    shift = (mask & -mask).bit_length() - 1 if mask else 0
    most = mask >> shift
    if not mask or most & (most + 1):
        raise ValueError("bad BMP colour mask")
    return (((values & mask) >> shift) * 255 // most).astype(np.uint8)


@_value_errors
def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 16, 24 or 32 bits, with the colour masks of 16
    and 32 bits: (h, w) where every palette colour is grey, else (h, w, 3)."""
    if data[:2] != b"BM" or len(data) < 30:
        raise ValueError("not BMP")
    start, head = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<I", data, 14)[0]
    if head == 12:
        w, h, _, bits = struct.unpack_from("<HHHH", data, 18)
        packing, colours, entry = 0, 0, 3
    else:
        w, h, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
        colours, entry = struct.unpack_from("<I", data, 46)[0], 4
    if packing not in (0, 3, 6) or (packing and bits not in (16, 32)) or bits not in (1, 4, 8, 16, 24, 32) or w < 1 or h == 0:
        raise ValueError("unsupported BMP")
    line = -(-w * bits // 32) * 4
    raw = np.frombuffer(data, np.uint8, count=min(line * abs(h), max(0, len(data) - start)), offset=min(start, len(data)))
    if len(raw) < line * abs(h):
        raise ValueError("BMP raster is cut short")
    rows = raw.reshape(abs(h), line)
    if h > 0:
        rows = rows[::-1]
    if packing or bits == 16:
        masks = struct.unpack_from("<III", data, 54) if packing else (0x7C00, 0x03E0, 0x001F)
        values = np.ascontiguousarray(rows[:, : w * bits // 8]).view("<u2" if bits == 16 else "<u4").astype(np.int64)
        return np.stack([_channel(values, mask) for mask in masks], axis=2)
    if bits >= 24:
        return rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1].copy()
    if bits < 8:
        each = np.unpackbits(rows, axis=1).reshape(abs(h), -1, bits)
        rows = (each * (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)).sum(axis=2, dtype=np.uint8)
    index = rows[:, :w]
    count = colours or 1 << bits
    palette = np.frombuffer(data, np.uint8, count=count * entry, offset=14 + head).reshape(count, entry)[:, 2::-1]
    if index.max() >= count:
        raise ValueError("BMP colour outside its palette")
    if (palette[:, 0] == palette[:, 1]).all() and (palette[:, 1] == palette[:, 2]).all():
        return palette[:, 0][index]
    return palette[index]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


# ---------------------------------------------------------------- features


def to_grey(pixels: np.ndarray) -> np.ndarray:
    if pixels.ndim == 2:
        return pixels
    return (pixels.astype(np.int64) @ np.array([299, 587, 114])) // 1000


def _edges(table: np.ndarray, parts: int) -> np.ndarray:
    """Rows of a summed-area table at ``parts + 1`` equal cuts, in units of
    1/parts: between two rows the sum grows linearly, so fractions are exact."""
    n = table.shape[0] - 1
    at = np.arange(parts + 1) * n
    whole, part = at // parts, at % parts
    nxt = np.minimum(whole + 1, n)
    shape = (-1,) + (1,) * (table.ndim - 1)
    return table[whole] * (parts - part).reshape(shape) + table[nxt] * part.reshape(shape)


def resize_area(pixels: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """Mean over each target cell's area, by an integral image in whole numbers;
    float64 of (rows, cols). A cell may cover parts of pixels."""
    h, w = pixels.shape
    table = np.zeros((h + 1, w + 1), dtype=np.int64)
    np.cumsum(pixels, axis=0, dtype=np.int64, out=table[1:, 1:])
    # only the cut rows are summed along the other axis
    cut = _edges(table, rows)
    np.cumsum(cut[:, 1:], axis=1, out=cut[:, 1:])
    cells = np.diff(np.diff(_edges(cut.T, cols).T, axis=0), axis=1)
    return cells / (h * w)


def difference_hash(tile: np.ndarray) -> int:
    """A bit for each pair of neighbours in a row: the left one is darker."""
    return int.from_bytes(np.packbits(tile[:, :-1] < tile[:, 1:]).tobytes(), "big")


def npy_tile(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(tile, dtype=np.float32), version=(1, 0), allow_pickle=False)
    return out.getvalue()


# ---------------------------------------------------------------- operators


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode_text(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Key columns, ``n_bytes`` and ``media``: each text's UTF-8 bytes, zero-padded
    to whole rows, as a grey-map of 8-bit samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 500):
            data = [x or b"" for x in batch.column(len(keys)).to_pylist()]
            media = [encode_pgm(padded(x)) for x in data]
            columns = [*batch.columns[: len(keys)], pa.array([len(x) for x in data], pa.int64()), pa.array(media, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "n_bytes", "media"])

    data = df.select(*map(named, keys), F.encode(named(text), "UTF-8").alias("__data"))
    return map_arrow(data, run, schema_of(df, keys, "n_bytes bigint, media binary"))


FEATURES = (
    "height int, width int, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, "
    "media_sha256 string, dhash string, tile binary, error string"
)


def _features(media: bytes | None) -> tuple:
    if media is None:
        return (None,) * 10
    stored = (len(media), hashlib.sha256(media).hexdigest())
    try:
        pixels = decode(media)
    except ValueError as e:
        return (None, None, None, None, None, *stored, None, None, str(e))
    payload = pixels.tobytes()
    tile = resize_area(to_grey(pixels), *TILE)
    return (
        pixels.shape[0], pixels.shape[1], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]),
        *stored, f"{difference_hash(tile):016x}", npy_tile(tile), None,
    )


def media_features(df: DataFrame, media: str = "media", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Key columns and :data:`FEATURES` from a binary column of pictures: what the
    decoded samples hold, the stored form's digest, the area-resized tile as an
    NPY file and its difference hash."""
    schema = schema_of(df, keys, FEATURES)
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
    names = [x.split()[0] for x in FEATURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 500):
            found = [_features(x) for x in batch.column(len(keys)).to_pylist()]
            columns = [pa.array(list(x), kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], names=[*keys, *names])

    return map_arrow(df.select(*map(named, keys), named(media)), run, schema)
