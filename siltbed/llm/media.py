"""Media columns: PNG images in binary columns, read with checksum tests and numpy unfiltering, and their hashes.

``with_images`` stores each text's bytes losslessly as the RGB samples of a PNG of 64 pixels' width (rows of 192
bytes); ``image_features`` reads any column of such files back. The feature is a perceptual hash: grey levels are
area-averaged to 32 x 32, and the signs of the lowest 8 x 8 cosine-transform coefficients against their median make 64
bits, as 16 hex digits.

Defined results: null text counts as empty (one row of blanks); a null or damaged file gives null features and the
reason in ``error``; repeated rows give equal rows; an empty table gives an empty result; columns other than the id and
the text or media column are not carried.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame

from siltbed.llm._common import scanned

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH, CHANNELS = 64, 3
STRIDE = WIDTH * CHANNELS
PIECE = 1 << 16


def payload_of(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, the text padded with blanks to whole image rows)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    rows = max(1, -(-len(raw) // STRIDE))
    return len(raw), raw.ljust(rows * STRIDE, b" ")


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def encoded(payload: bytes, level: int = 6) -> bytes:
    """A PNG whose samples are ``payload``; each row takes the filter of least absolute residue: none, sub or up."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, STRIDE)
    tried = np.stack([samples] * 3)
    tried[1, :, CHANNELS:] -= samples[:, :-CHANNELS]
    tried[2, 1:] -= samples[:-1]
    kinds = np.abs(tried.view(np.int8).astype(np.int16)).sum(axis=2).argmin(axis=0)
    rows = np.empty((len(samples), STRIDE + 1), np.uint8)
    rows[:, 0] = kinds
    rows[:, 1:] = tried[kinds, np.arange(len(samples))]
    header = struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 2, 0, 0, 0)
    packed = zlib.compress(rows.tobytes(), level)
    body = b"".join(chunk(b"IDAT", packed[i : i + PIECE]) for i in range(0, len(packed), PIECE))
    return SIGNATURE + chunk(b"IHDR", header) + body + chunk(b"IEND", b"")


def chunks(data: bytes):
    """(kind, content) of each chunk whose checksum holds; ValueError otherwise."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at = 8
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("cut short")
        (n,) = struct.unpack_from(">I", data, at)
        kind, content = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if at + 12 + n > len(data):
            raise ValueError("cut short")
        if struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(content, zlib.crc32(kind)):
            raise ValueError(f"checksum of {kind!r}")
        yield kind, content
        at += 12 + n


def unfiltered(rows: np.ndarray, step: int) -> np.ndarray:
    """Samples of filtered rows (filter type in front); ``step`` is the bytes of a pixel."""
    kinds, out = rows[:, 0], rows[:, 1:].copy()
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown filter")
    sub = kinds == 1
    if sub.any():
        pixels = out[sub].reshape(int(sub.sum()), -1, step)
        out[sub] = np.cumsum(pixels, axis=1, dtype=np.uint8).reshape(len(pixels), -1)
    blank = np.zeros(out.shape[1], np.uint8)
    for i in np.flatnonzero(kinds > 1):
        above = out[i - 1] if i else blank
        if kinds[i] == 2:
            out[i] += above
            continue
        row, up = out[i].tolist(), above.tolist()
        for x in range(len(row)):
            a, b = (row[x - step] if x >= step else 0), up[x]
            if kinds[i] == 3:
                guess = (a + b) // 2
            else:
                c = up[x - step] if x >= step else 0
                p = a + b - c
                guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            row[x] = (row[x] + guess) & 255
        out[i] = row
    return out


def decoded(data: bytes) -> np.ndarray:
    """(height, width, channels) samples of an 8-bit, non-interlaced grey, RGB or RGBA file."""
    parts, header, ended = [], None, False
    for kind, content in chunks(data):
        if kind == b"IHDR":
            if len(content) != 13:
                raise ValueError("header of the wrong length")
            header = struct.unpack(">IIBBBBB", content)
        elif kind == b"IDAT":
            parts.append(content)
        ended = kind == b"IEND"
    if header is None or not ended:
        raise ValueError("chunk missing")
    width, height, bits, colour, *modes = header
    step = {0: 1, 2: 3, 6: 4}.get(colour)
    if bits != 8 or step is None or any(modes):
        raise ValueError("unsupported samples")
    size, inflate = height * (width * step + 1), zlib.decompressobj()
    if not size:
        raise ValueError("wrong size")
    try:
        raw = inflate.decompress(b"".join(parts), size + 1)  # no more than the header promises
    except zlib.error as e:
        raise ValueError(f"deflate: {e}") from None
    if len(raw) != size or not inflate.eof:
        raise ValueError("wrong size")
    rows = np.frombuffer(raw, np.uint8).reshape(height, -1)
    return unfiltered(rows, step).reshape(height, width, step)


def averaged(cells: np.ndarray, to: int = 32) -> np.ndarray:
    """Means over ``to`` equal lengths of the rows, with parts of rows at the edges, by prefix sums."""
    n = len(cells)
    sums = np.concatenate([np.zeros_like(cells[:1]), np.cumsum(cells, axis=0)])
    edges = np.arange(to + 1) * (n / to)
    at = np.minimum(edges.astype(np.int64), n - 1)
    return np.diff(sums[at] + (edges - at)[:, None] * cells[at], axis=0) / (n / to)


COSINES = np.cos(np.pi * (2 * np.arange(32)[None, :] + 1) * np.arange(8)[:, None] / 64)


def low_frequency_hash(samples: np.ndarray) -> str:
    grey = samples[..., :3].mean(axis=2)
    area = averaged(averaged(grey).T).T
    low = (COSINES @ area @ COSINES.T).ravel()
    bits = np.round(low, 6) > np.round(np.median(low[1:]), 6)
    return np.packbits(bits).tobytes().hex()


def with_images(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes and the text's PNG in the binary column ``media``."""

    def encode(texts):
        sized = [payload_of(t) for t in texts]
        return [n for n, _ in sized], [encoded(p) for _, p in sized]

    return scanned(docs, text_col, [id_col], {"n_bytes": "long", "media": "binary"}, encode)


FEATURES = {
    "payload_bytes": "long",
    "payload_sha256": "string",
    "tail_crc32": "long",
    "media_bytes": "long",
    "media_sha256": "string",
    "feature": "string",
    "error": "string",
}


def features_of(data: bytes | None) -> tuple:
    if data is None:
        return None, None, None, None, None, None, "null"
    own = len(data), hashlib.sha256(data).hexdigest()
    try:
        samples = decoded(data)
    except ValueError as e:
        return None, None, None, *own, None, str(e)
    payload = samples.tobytes()
    return (
        len(payload),
        hashlib.sha256(payload).hexdigest(),
        zlib.crc32(payload[-16:]),
        *own,
        low_frequency_hash(samples),
        None,
    )


def image_features(media: DataFrame, media_col: str = "media") -> DataFrame:
    """The other columns of ``media``, and what the files hold when read back (``FEATURES``)."""
    keep = [c for c in media.columns if c != media_col and c not in FEATURES]

    def read(files):
        rows = [features_of(x) for x in files]
        return [[row[i] for row in rows] for i in range(len(FEATURES))]

    return scanned(media, media_col, keep, FEATURES, read)
