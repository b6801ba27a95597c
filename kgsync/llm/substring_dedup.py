"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: 16 bits wide, so it depends on the last 16 bytes alone, which
is what lets the boundaries of a passage fall into step again after an insertion before it. Chunks end
where the hash says so, never by where they began, and always between characters:

- after a word, if the hash's upper half (which all 16 bytes reach) is 0 modulo DIVISOR, about every
  DIVISOR words. Of REACH words in a row none of which ends so, the one with the least hash ends a chunk
  (all of them, if several have it): a line that is repeated may hold no byte that fits.
- in a run without white space (Chinese, Thai, minified code), after any character that has RUN bytes of
  the run before it, if that half is 0 modulo RUN_DIVISOR, and of RUN_REACH such characters one at least
  as well. Where the text is periodic, cuts of one hash follow each other closely; one in RUN_REACH stays.

A window is a sequence of chunks as long as MIN_WORDS words, and no longer than it must be, from its first
chunk on or back from its last one, so that a passage is covered up to both its ends. In a run the
WORD_BYTES bytes beyond its first RUN count as a word. A digest (128 bits) stands for a window; one that
occurred before, by (doc_id, place), is cut out: what goes lies in sequences of MIN_WORDS words that each
occurred before as a whole. The first occurrence stays.

1. Each Arrow batch of documents (a block) keeps one row of every digest that it holds twice: the later
   ones are repeats for certain. What is left goes, compressed by lane (a part of the digest), through an
   exchange. A passage that is in every document is one entry in a block, so it makes no hot key. There
   are as many lanes as the input asks for (`common.deal`); beyond MOST_LANES each of that many coarse
   lanes is dealt once more.
2. A partition holds its lanes in order, one of them in memory at a time, and passes on the places of all
   but the first entry of each digest, by groups of documents.
3. A group's places are brought in order by document and meet their documents, which are chunked again and
   cut.

Documents are told apart by doc_id and a hash of their text: rows that repeat in full are one document
and are cut alike. Null doc_id come first. Null texts stay null. All columns are kept, whatever their
names. An empty table gives an empty table. Memory is bounded by a block, a lane, a group of documents'
places, and a text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import MOST_LANES, arrow, deal, text_bytes, write_down
from .packing import groups

DIVISOR = 4
#: Of so many words in a row, one ends a chunk.
REACH = 6
#: What is sought are passages of over 50 words. Two copies of one have the same cuts from the first REACH words on
#: whose hashes lie within it (some three words in) and up to its last REACH ones: a window of so many words, and
#: the chunk by which it may be longer, fits in between.
MIN_WORDS = 32
#: Bytes of a run without white space before which it is a word like others.
RUN = 32
#: In a longer run: how rarely a character ends a chunk, of how many one does, and the bytes that count as a word.
RUN_DIVISOR, RUN_REACH, WORD_BYTES = 16, 32, 6
SEED = 7
BLOCK_BYTES = 8 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_GEAR = np.random.default_rng(SEED).integers(0, 1 << 16, 256, dtype=np.uint16)


def _hashes(b: np.ndarray) -> np.ndarray:
    """h[i] = the sum of gear[b[i - j]] << j for j < 16, by doubling."""
    h = _GEAR[b]
    for k in (1, 2, 4, 8):
        h[k:] = h[k:] + (h[:-k] << np.uint16(k))
    return h


def _least(h: np.ndarray, fits: np.ndarray, reach: int) -> np.ndarray:
    """Which of the places are the least of some `reach` in a row, where those that fit are less than all others."""
    if len(h) < reach:
        return fits
    rank = np.where(fits, np.uint16(0), h)
    least = _running(np.minimum, rank, reach)
    return rank == _running(np.maximum, np.pad(least, reach - 1), reach)


def _running(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """op over each `width` neighbours, by doubling."""
    n, have = len(x) - width + 1, 1
    while 2 * have <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return op(x[:n], x[width - have : width - have + n])


def _runs(space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes are (from, up to) that have RUN bytes of their run without white space before them."""
    edges = np.r_[-1, np.flatnonzero(space), len(space)]
    long = np.diff(edges) > RUN + 1
    return edges[:-1][long] + 1 + RUN, edges[1:][long]


def _run_cuts(b: np.ndarray, h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Bytes in runs after which a chunk ends."""
    flips = np.zeros(len(b) + 1, np.int8)
    flips[start], flips[stop] = 1, -1
    inside = np.cumsum(flips[:-1], dtype=np.int8).view(bool)
    inside[:-1] &= (b[1:] & 0xC0) != 0x80  # the last byte of a character
    at = np.flatnonzero(inside)
    fits = (h[at] >> np.uint16(8)) % RUN_DIVISOR == 0
    chosen = np.flatnonzero(_least(h[at], fits, RUN_REACH))
    if len(chosen):
        same = np.r_[False, (np.diff(h[at[chosen]].astype(np.int32)) == 0) & (np.diff(chosen) < RUN_REACH)]
        begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(chosen))))  # of the cuts of one hash
        step = (chosen - chosen[begin]) // RUN_REACH
        chosen = chosen[~same | np.r_[True, step[1:] != step[:-1]]]
    return at[chosen]


def cuts(raw: bytes) -> np.ndarray:
    """Ends of the chunks of a text's bytes, the last one its length."""
    if not raw:
        return np.zeros(0, np.int64)
    b = np.frombuffer(raw, np.uint8)
    h, space = _hashes(b), _SPACE[b]
    at = np.flatnonzero(space & ~np.r_[True, space[:-1]])  # the bytes after words
    ends = [at[_least(h[at], (h[at] >> np.uint16(8)) % DIVISOR == 0, REACH)] + 1, [len(raw)]]
    start, stop = _runs(space)
    if len(start):
        ends.append(_run_cuts(b, h, start, stop) + 1)
    return np.unique(np.concatenate(ends)).astype(np.int64)


def windows(raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows' first chunks, and the chunks after their last ones."""
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    begins = np.flatnonzero(~space & np.r_[True, space[:-1]])
    size = np.searchsorted(begins, ends) * WORD_BYTES
    start, stop = _runs(space)
    if len(start):
        n = np.searchsorted(start, ends)  # runs that begin before each end, and what of the last one lies behind it
        size += np.r_[0, np.cumsum(stop - start)][n] - np.where(n > 0, np.maximum(stop[n - 1] - ends, 0), 0)
    before = np.r_[0, size]  # what begins before each chunk, and in all
    k = np.arange(len(before))
    after = np.searchsorted(before, before + MIN_WORDS * WORD_BYTES)
    first = np.searchsorted(before, before - MIN_WORDS * WORD_BYTES, side="right") - 1
    forward, back = after < len(before), first >= 0
    pairs = np.unique(np.r_[k[forward] * len(before) + after[forward], first[back] * len(before) + k[back]])
    return pairs // len(before), pairs % len(before)


def _digests(raw: bytes, ends: np.ndarray) -> bytes:
    """16 bytes for each window."""
    from xxhash import xxh3_128_digest

    starts = np.r_[0, ends]
    first, after = windows(raw, ends)
    return b"".join([xxh3_128_digest(raw[a:b]) for a, b in zip(starts[first].tolist(), starts[after].tolist(), strict=True)])


def _order(digest: np.ndarray, doc: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sort by digest and occurrence, and whether each is the first of its digest or the same occurrence again."""
    by = np.lexsort((place, key, doc, digest[:, 1], digest[:, 0]))
    d = digest[by]
    new = np.ones(len(by), bool)
    new[1:] = (d[1:] != d[:-1]).any(axis=1)
    first = by[np.flatnonzero(new)][np.cumsum(new) - 1]
    same = (doc[by] == doc[first]) & (key[by] == key[first]) & (place[by] == place[first])
    return by, same


def _one(a: np.ndarray) -> bytes:
    raw = a.tobytes()
    z = pa.compress(raw, codec="zstd", asbytes=True)
    return struct.pack("<qq", len(raw), len(z)) + z


def _blob(*arrays: np.ndarray) -> bytes:
    return b"".join(map(_one, arrays))


def _unblob(data: bytes, *kinds: str) -> list[np.ndarray]:
    at, out = 0, []
    for k in kinds:
        n, z = struct.unpack_from("<qq", data, at)
        out.append(np.frombuffer(pa.decompress(data[at + 16 : at + 16 + z], decompressed_size=n, codec="zstd", asbytes=True), k))
        at += 16 + z
    return out


def _blocks(batches) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    docs, keys, raws, size = [], [], [], 0
    for batch in batches:
        for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if text.is_valid and (raw := text.as_buffer().to_pybytes()):
                docs.append(np.iinfo(np.int64).min if doc is None else doc)
                keys.append(key)
                raws.append(raw)
                size += len(raw)
                if size > BLOCK_BYTES:
                    yield np.array(docs), np.array(keys), raws
                    docs, keys, raws, size = [], [], [], 0
    if docs:
        yield np.array(docs), np.array(keys), raws


def _by_lane(n_lanes: int, digest: np.ndarray, row: np.ndarray, place: np.ndarray, docs: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Entries of each lane, compressed."""
    lane = (digest[:, 0] % np.uint64(n_lanes)).astype(np.int64)
    by = np.lexsort((place, row, lane))
    edges = np.r_[np.flatnonzero(np.diff(lane[by], prepend=-1)), len(by)]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        part = by[a:b]
        used, at = np.unique(row[part], return_inverse=True)
        yield int(lane[part[0]]), _blob(digest[part].reshape(-1), docs[used], keys[used], np.diff(at, prepend=0).astype(np.uint32), place[part])


def _lane_rows(found: Iterator[tuple[int, bool, bytes]]) -> Iterator[pa.RecordBatch]:
    while part := list(islice(found, 256)):
        a, b, c = zip(*part, strict=True)
        yield pa.record_batch({"lane": pa.array(a, pa.int64()), "certain": pa.array(b), "data": pa.array(c, pa.binary())})


def _entries(n_lanes: int):
    """Rows (lane, certain, data): entries by lane, and the places of certain repeats."""

    def block(docs, keys, raws) -> Iterator[tuple[int, bool, bytes]]:
        found = [_digests(raw, cuts(raw)) for raw in raws]
        digest = np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)
        counts = np.array([len(f) // 16 for f in found])
        row = np.repeat(np.arange(len(raws)), counts)
        place = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint32)
        by, first = _order(digest, docs[row], keys[row], place)
        repeat = np.sort(by[~first])
        if len(repeat):
            yield int(repeat[0] + len(raws)) % n_lanes, True, _blob(docs[row[repeat]], keys[row[repeat]], place[repeat])
        # of an occurrence that is there again as a whole, one entry is enough
        lone = np.ones(len(by), bool)
        lone[1:] = (digest[by[1:]] != digest[by[:-1]]).any(axis=1)
        keep = by[first & lone]
        for lane, data in _by_lane(n_lanes, digest[keep], row[keep], place[keep], docs, keys):
            yield lane, False, data

    def run(batches):
        for docs, keys, raws in _blocks(batches):
            yield from _lane_rows(block(docs, keys, raws))

    return run


def _unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    digest, docs, keys, at, place = _unblob(data, "<u8", "<i8", "<i8", "<u4", "<u4")
    at = np.cumsum(at, dtype=np.int64)
    return digest.reshape(-1, 2), docs[at], keys[at], place


def _deal_again(n_lanes: int):
    """Entries of coarse lanes, gathered up to a block's size, by finer lanes."""

    def block(parts) -> Iterator[tuple[int, bool, bytes]]:
        digest, doc, key, place = (np.concatenate(p) for p in zip(*parts, strict=True))
        for lane, data in _by_lane(n_lanes, digest, np.arange(len(place)), place, doc, key):
            yield lane, False, data

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for certain, data in zip(batch.column("certain").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if certain:
                    yield from _lane_rows(iter([(len(data) % n_lanes, True, data)]))
                    continue
                parts.append(_unpacked(data))
                size += len(parts[-1][3])
                if size * 16 > BLOCK_BYTES:
                    yield from _lane_rows(block(parts))
                    parts, size = [], 0
        if parts:
            yield from _lane_rows(block(parts))

    return run


def _marks(n: int, doc, key, place) -> pa.RecordBatch:
    """Places of repeated windows, one row for each group of documents that has any."""
    group = ((doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ key.astype(np.uint64)) % np.uint64(n)).astype(np.int64)
    by = np.argsort(group, kind="stable")
    edges = np.r_[np.flatnonzero(np.diff(group[by], prepend=-1)), len(by)]
    pairs = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
    data = [_blob(*(x[by[a:b]] for x in (doc, key, place))) for a, b in pairs]
    return pa.record_batch({"group": pa.array([int(group[by[a]]) for a, _ in pairs], pa.int64()), "data": pa.array(data, pa.binary())})


def _in_order(batches, name: str) -> Iterator[tuple[int, Iterator]]:
    """Rows with one value of the sorted first column, together."""
    rows = (r for batch in batches for r in zip(batch.column(name).to_pylist(), *(batch.column(c) for c in batch.schema.names if c != name), strict=True))
    return groupby(rows, key=itemgetter(0))


def _repeats(n: int):
    """The places of all entries but the first of each digest; the rows come in order of their lanes."""

    def run(batches):
        for _, rows in _in_order(batches, "lane"):
            parts = []
            for _, certain, data in rows:
                if certain.as_py():
                    yield _marks(n, *_unblob(data.as_py(), "<i8", "<i8", "<u4"))
                else:
                    parts.append(_unpacked(data.as_py()))
            if parts:
                digest, doc, key, place = (np.concatenate(p) for p in zip(*parts, strict=True))
                parts.clear()
                by, first = _order(digest, doc, key, place)
                repeat = by[~first]
                if len(repeat):
                    yield _marks(n, doc[repeat], key[repeat], place[repeat])

    return run


def _by_document(batches):
    """(doc, key, places): one row for each document with repeats; the rows come in order of their groups."""
    for _, rows in _in_order(batches, "group"):
        doc, key, place = (np.concatenate(p) for p in zip(*(_unblob(data.as_py(), "<i8", "<i8", "<u4") for _, data in rows), strict=True))
        by = np.lexsort((place, key, doc))
        doc, key, place = doc[by], key[by], place[by]
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])
        edges = np.r_[new, len(doc)]
        for i in range(0, len(new), 4096):
            j = min(i + 4096, len(new))
            lists = pa.ListArray.from_arrays(pa.array((edges[i : j + 1] - edges[i]).astype(np.int32)), pa.array(place[edges[i] : edges[j]].astype(np.int32)))
            yield pa.record_batch({"doc": pa.array(doc[new[i:j]]), "key": pa.array(key[new[i:j]]), "places": lists})


def spans(raw: bytes, places) -> list[tuple[int, int]]:
    """Byte ranges to cut out, given the numbers of the repeated windows."""
    ends = cuts(raw)
    first, after = windows(raw, ends)
    places = np.unique(np.asarray(places, np.int64))
    depth = np.zeros(len(ends) + 1, np.int64)
    np.add.at(depth, first[places], 1)
    np.add.at(depth, after[places], -1)
    flips = np.flatnonzero(np.diff(np.r_[False, np.cumsum(depth) > 0].astype(np.int8)))
    starts = np.r_[0, ends]
    return [(int(starts[a]), int(starts[b])) for a, b in zip(flips[::2], flips[1::2], strict=True)]


def cut(text: str, places) -> tuple[str, list[tuple[int, int]]]:
    raw = text.encode("utf-8", "surrogatepass")
    gone = spans(raw, places) if len(places) else []
    kept, at = [], 0
    for a, b in gone:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass"), gone


def _cut_rows(batches):
    for batch in groups(batches):
        texts, starts, lengths = [], [], []
        for t, places in zip(batch.column("text"), batch.column("places"), strict=True):
            if places.is_valid and t.is_valid:
                text, gone = cut(t.as_py(), places.as_py())
            else:
                text, gone = t.as_py(), []
            texts.append(text)
            starts.append([a for a, _ in gone])
            lengths.append([b - a for a, b in gone])
        yield pa.record_batch(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(starts, pa.list_(pa.int64())), pa.array(lengths, pa.list_(pa.int64()))],
            names=["row", "text", "starts", "lengths"],
        )


def repeated_places(docs: DataFrame, most_lanes: int = MOST_LANES) -> DataFrame:
    """(doc, key, places): for each document with repeats, the numbers of its repeated windows."""
    parts, n = deal(docs.sparkSession, text_bytes(docs))
    schema = "lane long, certain boolean, data binary"
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text")
    entries = arrow(keyed, _entries(min(n, most_lanes)), schema)
    if n > most_lanes:  # of coarse lanes, numbers modulo the least multiple that is fine enough
        n = -(-n // most_lanes) * most_lanes
        entries = write_down(entries.repartition(max(parts, most_lanes), "lane").mapInArrow(_deal_again(n), schema))
    found = entries.repartition(parts, "lane").sortWithinPartitions("lane").mapInArrow(_repeats(n), "group long, data binary")
    return found.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(_by_document, "doc long, key long, places array<int>")


def deduplicate(docs: DataFrame) -> DataFrame:
    """All columns with the deduplicated text, and the byte ranges cut out of the given one: a struct of `row`, `starts`, `lengths`."""
    names = docs.columns
    others = [F.col(f"`{c}`") for c in names if c != "text"]
    taken = docs.select(F.struct(*others).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("key"), "text")
    joined = taken.join(repeated_places(docs), ["doc", "key"], "left").select("row", "text", "places")
    schema = joined.select("row", "text").schema.add("starts", ArrayType(LongType())).add("lengths", ArrayType(LongType()))
    return joined.mapInArrow(_cut_rows, schema)


def documents(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out; all rows stay."""
    return deduplicate(docs).select(*((F.col("text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, text after deduplication, n_bytes before, n_removed bytes, n_spans."""
    cleaned = deduplicate(docs.select("doc_id", "text", F.octet_length("text").alias("n")))
    removed = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    n_bytes, n_spans = F.coalesce("row.n", F.lit(0)).cast("long"), F.size("starts").cast("long")
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "text", n_bytes.alias("n_bytes"), removed.alias("n_removed"), n_spans.alias("n_spans"), "starts", "lengths")
