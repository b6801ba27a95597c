"""Binary media columns: lossless 8-bit PNG images and low-frequency cosine-transform hashes.

`encode_png` writes a grey 8-bit image (one row filter for each line, the zlib stream in IDAT chunks of
bounded size), `decode_png` reads it back: signature, chunk order, lengths and CRCs are tested, the zlib
stream must end where the data do and have the size that the header says, and the five row filters are
undone with numpy. `dct_hash` shrinks the image by area to 32 x 32, keeps the 8 x 8 lowest frequencies of
its cosine transform and sets a bit for each coefficient over their median.

A text is stored as its UTF-8 bytes, followed by zero bytes up to a positive multiple of 64, as lines of
64 samples. Null and empty texts are one line of zeros. Rows are independent: nothing is shuffled, memory
is bounded by one Arrow batch and one image. Repeated rows and null doc_id are kept; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
IDAT_BYTES = 1 << 16
#: Samples that are filtered together.
BAND_BYTES = 1 << 20
LEVEL = 3
SIDE, LOW = 32, 8
SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class PngError(ValueError):
    pass


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def _filtered(image: np.ndarray, a: int, b: int) -> np.ndarray:
    """Lines a..b-1, each led by the filter (none, sub or up) whose residuals, read as signed, are smallest in sum."""
    band = image[a:b]
    sub, up = band.copy(), band.copy()
    sub[:, 1:] -= band[:, :-1]
    up[1:] -= band[:-1]
    if a:
        up[0] -= image[a - 1]
    tried = np.stack([band, sub, up])
    best = np.abs(tried.view(np.int8).astype(np.int16)).sum(axis=2, dtype=np.int64).argmin(axis=0)
    lines = np.empty((b - a, image.shape[1] + 1), np.uint8)
    lines[:, 0] = best
    lines[:, 1:] = tried[best, np.arange(b - a)]
    return lines


def encode_png(image: np.ndarray) -> bytes:
    """Lines are filtered and compressed a band at a time, so that only the image and its compressed form are held whole."""
    h, w = image.shape
    z = zlib.compressobj(LEVEL)
    step = max(1, BAND_BYTES // w)
    body = b"".join([z.compress(_filtered(image, a, min(a + step, h)).tobytes()) for a in range(0, h, step)] + [z.flush()])
    parts = [_chunk(b"IDAT", body[i : i + IDAT_BYTES]) for i in range(0, len(body), IDAT_BYTES)]
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + b"".join(parts) + _chunk(b"IEND", b"")


def _chunks(data: bytes):
    if data[:8] != SIGNATURE:
        raise PngError("no PNG signature")
    at = 8
    while at < len(data):
        if at + 12 > len(data):
            raise PngError("cut off in a chunk's head")
        n, kind = struct.unpack_from(">I4s", data, at)
        if at + 12 + n > len(data):
            raise PngError("cut off in a chunk")
        body = data[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + body):
            raise PngError(f"wrong checksum in {kind!r}")
        yield kind, body
        at += 12 + n
        if kind == b"IEND":
            if at != len(data):
                raise PngError("data after the end")
            return
    raise PngError("no end chunk")


def unfilter(lines: np.ndarray) -> np.ndarray:
    """Undo the row filters of 8-bit grey lines, each led by its filter's number. Runs of lines of one kind are undone together where the filter allows."""
    kinds, x = lines[:, 0], lines[:, 1:].copy()
    h, w = x.shape
    if kinds.max(initial=0) > 4:
        raise PngError("unknown row filter")
    left = np.flatnonzero(kinds == 1)
    x[left] = np.cumsum(x[left], axis=1, dtype=np.uint8)
    starts = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]]) if h else []
    for a, b in zip(starts, [*starts[1:], h], strict=True):
        if kinds[a] == 2:
            a0 = max(a - 1, 0)
            x[a0:b] = np.cumsum(x[a0:b], axis=0, dtype=np.uint8)
        elif kinds[a] > 2:
            for i in range(a, b):
                above = x[i - 1].astype(int) if i else np.zeros(w, int)
                x[i] = _average(x[i], above) if kinds[a] == 3 else _paeth(x[i], above)
    return x


def _average(line: np.ndarray, above: np.ndarray) -> list[int]:
    out, last = [], 0
    for v, b in zip(line.tolist(), above.tolist(), strict=True):
        last = (v + (last + b) // 2) & 255
        out.append(last)
    return out


def _paeth(line: np.ndarray, above: np.ndarray) -> list[int]:
    out, a, c = [], 0, 0
    for v, b in zip(line.tolist(), above.tolist(), strict=True):
        pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
        near = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
        a, c = (v + near) & 255, b
        out.append(a)
    return out


def decode_png(data: bytes) -> np.ndarray:
    """8-bit grey images without interlacing; anything else or any damage raises PngError."""
    head, body, ended = None, [], False
    for kind, part in _chunks(data):
        if (head is None) != (kind == b"IHDR"):
            raise PngError("the header is not the first chunk, once")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part) if len(part) == 13 else None
            if head is None or head[2:] != (8, 0, 0, 0, 0) or not head[0] or not head[1]:
                raise PngError("not an 8-bit grey image")
        elif kind == b"IDAT":
            if ended:
                raise PngError("data chunks are apart")
            body.append(part)
        else:
            ended = bool(body)
            if not kind[0] & 32 and kind != b"IEND":
                raise PngError(f"unknown critical chunk {kind!r}")
    w, h = head[:2]
    z, size = zlib.decompressobj(), h * (w + 1)
    try:
        raw = z.decompress(b"".join(body), size + 1)
    except zlib.error as e:
        raise PngError(str(e)) from e
    if len(raw) != size or not z.eof and z.decompress(z.unconsumed_tail, 1) or not z.eof or z.unused_data:
        raise PngError("the zlib stream does not have the header's size")
    return unfilter(np.frombuffer(raw, np.uint8).reshape(h, w + 1))


def _cosines() -> np.ndarray:
    k, n = np.arange(LOW)[:, None], np.arange(SIDE)[None, :]
    return np.cos(np.pi * (2 * n + 1) * k / (2 * SIDE))


_COS = _cosines()


def _shrink(x: np.ndarray) -> np.ndarray:
    """Means over SIDE equal parts of the first axis, with parts of samples by their share."""
    n = len(x)
    total = np.vstack([np.zeros((1, x.shape[1])), np.cumsum(x, axis=0, dtype=np.float64)])
    at = np.arange(SIDE + 1) * n / SIDE
    i = np.minimum(at.astype(int), n - 1)
    edge = total[i] + (at - i)[:, None] * x[i]
    return np.diff(edge, axis=0) * (SIDE / n)


def dct_hash(image: np.ndarray) -> int:
    """64 bits. Coefficients are rounded first, so that the order of additions can't show."""
    small = _shrink(_shrink(image).T).T
    low = np.round(_COS @ small @ _COS.T, 3).ravel()
    bits = low > np.median(low[1:])
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def payload(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")


def to_image(text: str | None) -> np.ndarray:
    return np.frombuffer(payload(text)[1], np.uint8).reshape(-1, WIDTH)


def _digest(batches):
    for batch in batches:
        rows = []
        for doc, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            n, raw = payload(t.as_py())
            stored = encode_png(np.frombuffer(raw, np.uint8).reshape(-1, WIDTH))
            image = decode_png(stored)
            back = image.tobytes()
            rows.append((doc, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{dct_hash(image):016x}"))
        cols = list(zip(*rows, strict=True)) or [[]] * 8
        kinds = [c.split() for c in SCHEMA.split(", ")]
        yield pa.record_batch([pa.array(c, pa.int64() if k == "long" else pa.string()) for c, (_, k) in zip(cols, kinds, strict=True)], names=[n for n, _ in kinds])


def media_digests(docs: DataFrame) -> DataFrame:
    """Stores each whole text as an image, reads the stored bytes back and describes both."""
    return arrow(docs.select(F.col("doc_id").cast("long"), "text"), _digest, SCHEMA)


def media_columns(docs: DataFrame) -> DataFrame:
    """doc_id, media binary, feature binary: the stored form itself."""

    def run(batches):
        for batch in batches:
            images = [to_image(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch({"doc_id": batch.column(0), "media": pa.array(map(encode_png, images), pa.binary()), "feature": pa.array([dct_hash(i).to_bytes(8, "big") for i in images], pa.binary())})

    return arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, media binary, feature binary")
