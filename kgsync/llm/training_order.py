"""Training-order materialisation: fixed-stride binary shards in a keyed random order.

1. Each task makes the sequences of its documents (ids of a document, an end id, the next document; cut
   every `length` ids; the last one padded) and writes them, compressed in blocks, to a table in the shared
   folder. The tasks' counts, one number each, give every task the index of its first sequence.
2. The sequences of the table are sent to their global slots: a keyed Feistel network over
   the smallest even number of bits, walked along its cycle until it falls below the number of sequences,
   is a permutation of the indices that anyone can compute for one index, either way.
3. Slots are dealt to range partitions of `per_shard` slots, those that a task has for one shard together
   and compressed together. A partition puts its sequences into their places and writes one shard, `length`
   ids of two bytes each from slot to slot, under a temporary name first, so a task that runs again only
   replaces a file by its equal. A slot's shard and byte are plain arithmetic; reading is sequential and
   can resume at any slot.
4. When all shards are there, a manifest is put beside them; a folder without one is not whole. The
   sequences' table is removed, and the table of slots, written with the shards, is returned.

The shards are written by the call, once, not when the result is used. Texts are tokenized once, and later
steps read the table, so a step that runs again sees the same sequences. Memory is bounded by a group of
documents, the sequences that are dealt together, and a shard. PAD_ID is no id of the vocabulary, so an end
is told from what fills the last sequence of a task. Null texts count as empty; null and repeated doc_id
are kept; extra columns are ignored; an empty table has no sequence, no shard and a manifest.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_ids import Encoder, ranks_path, tokenizer_path
from .common import arrow, checkpoint_dir, remove_folder
from .packing import groups

LENGTH, PER_SHARD = 2048, 8192
END_ID, PAD_ID = 50256, 65535
MANIFEST = "_MANIFEST.json"
KEY = 0x5DEECE66D
ROUNDS = 6
#: Sequences that are compressed together in the table, and that are dealt together.
BLOCK, DEALT = 64, 4096
ZSTD = 9
SCHEMA = "slot long, shard long, byte_offset long, sequence_index long, n_tokens long, first_doc_id long, first_start long, n_docs long, ids_crc32 long"


class Permutation:
    """A keyed permutation of 0..n-1; `forward` gives slots of indices, `back` indices of slots."""

    def __init__(self, n: int, key: int = KEY):
        self.n = n
        self.half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = self._mix(np.uint64(key & (1 << 64) - 1) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def _network(self, x: np.ndarray, keys, back: bool) -> np.ndarray:
        shift = np.uint64(self.half)
        left, right = x >> shift, x & self.mask
        for k in keys:
            if back:
                left, right = right ^ (self._mix(left ^ k) & self.mask), left
            else:
                left, right = right, left ^ (self._mix(right ^ k) & self.mask)
        return left << shift | right

    def _walk(self, values, back: bool) -> np.ndarray:
        keys = self.keys[::-1] if back else self.keys
        x = np.asarray(values, np.uint64).copy()
        todo = np.arange(len(x))
        while len(todo):
            x[todo] = self._network(x[todo], keys, back)
            todo = todo[x[todo] >= np.uint64(self.n)]
        return x.astype(np.int64)

    def forward(self, indices) -> np.ndarray:
        return self._walk(indices, False)

    def back(self, slots) -> np.ndarray:
        return self._walk(slots, True)


def _sequences(batches, path: str, ranks: str | None, length: int):
    """(first doc_id, its start there, documents, ids as bytes without padding)"""
    encode, end, stride = Encoder(path, ranks), np.array([END_ID], "<u2").tobytes(), 2 * length
    if encode.tokenizer.get_vocab_size() > PAD_ID:
        raise ValueError("ids do not fit two bytes")
    held, size, spans = [], 0, []
    for group in groups(batches):
        ids, edges = encode.of(group.column(1))
        ids = ids.astype("<u2")
        for doc, a, b in zip(group.column(0).to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            data = ids[a:b].tobytes() + end
            start = 0
            while start < len(data):
                part = data[start : start + stride - size]
                held.append(part)
                spans.append((doc, start // 2))
                size += len(part)
                start += len(part)
                if size == stride:
                    yield *spans[0], len(spans), b"".join(held)
                    held, size, spans = [], 0, []
    if held:
        yield *spans[0], len(spans), b"".join(held)


TABLE = "part int, local long, n long, first_doc_id array<long>, first_start array<long>, n_docs array<long>, n_tokens array<long>, ids binary"


def _make(path: str, ranks: str | None, length: int):
    def block(codec, local, rows):
        doc, start, n_docs, ids = zip(*rows, strict=True)
        longs = lambda x: pa.array([list(x)], pa.list_(pa.int64()))
        part = TaskContext.get().partitionId()
        return pa.record_batch(
            [pa.array([part], pa.int32()), pa.array([local]), pa.array([len(rows)]), longs(doc), longs(start), longs(n_docs), longs(len(x) // 2 for x in ids), pa.array([codec.compress(b"".join(ids), asbytes=True)], pa.binary())],
            names=[c.split()[0] for c in TABLE.split(", ")],
        )

    def run(batches):
        codec = pa.Codec("zstd", compression_level=ZSTD)
        local, rows = 0, []
        for row in _sequences(batches, path, ranks, length):
            rows.append(row)
            if len(rows) == BLOCK:
                yield block(codec, local, rows)
                local, rows = local + BLOCK, []
        if rows:
            yield block(codec, local, rows)

    return run


REPORT = ["sequence_index", "n_tokens", "first_doc_id", "first_start", "n_docs"]
PARCEL = "shard int, slot array<long>, " + ", ".join(f"{c} array<long>" for c in REPORT) + ", ids binary"


def _emit(per_shard: int, first: np.ndarray, order: Permutation):
    """Rows of PARCEL: the sequences of some blocks that go to one shard, in the order of their slots."""

    def parcels(codec, held) -> Iterator[pa.RecordBatch]:
        columns, data = list(zip(*(h[:-1] for h in held), strict=True)), [d for h in held for d in h[-1]]
        index, n_tokens, doc, start, n_docs = (np.concatenate(c) for c in columns)
        slots = order.forward(index)
        by = np.argsort(slots)
        shard = slots[by] // per_shard
        edges = np.r_[np.flatnonzero(np.diff(shard, prepend=-1)), len(by)]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            some = by[a:b]
            longs = [pa.array([x[some]], pa.list_(pa.int64())) for x in (slots, index, n_tokens)] + [pa.array([[x[i] for i in some]], pa.list_(pa.int64())) for x in (doc, start, n_docs)]
            ids = codec.compress(b"".join([data[i] for i in some]), asbytes=True)
            yield pa.record_batch([pa.array([int(shard[a])], pa.int32()), *longs, pa.array([ids], pa.binary())], names=[c.split()[0] for c in PARCEL.split(", ")])

    def run(batches):
        codec, held, size = pa.Codec("zstd", compression_level=ZSTD), [], 0
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.cumsum(2 * np.array(row["n_tokens"]))
                raw = codec.decompress(row["ids"], int(ends[-1]), asbytes=True)
                data = [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                named = [np.array(row[k], object) for k in ("first_doc_id", "first_start", "n_docs")]  # doc_id may be null
                held.append((int(first[row["part"]]) + row["local"] + np.arange(row["n"]), np.array(row["n_tokens"], np.int64), *named, data))
                size += row["n"]
                if size >= DEALT:
                    yield from parcels(codec, held)
                    held, size = [], 0
        if held:
            yield from parcels(codec, held)

    return run


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, data: bytes) -> None:
    """A file that is there whole or not at all."""
    store, base = _store(folder)
    part = f"{base}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, f"{base}/{name}")


def _shard_name(number: int) -> str:
    return f"shard-{number:08d}.bin"


def _write(folder: str, length: int, per_shard: int, total: int):
    stride = 2 * length

    def shard(number: int, parcels: list[dict]) -> pa.RecordBatch:
        begin = number * per_shard
        n = min(per_shard, total - begin)
        out, columns = np.full((n, length), PAD_ID, "<u2"), {c: [None] * n for c in REPORT}
        there = np.zeros(n, bool)
        for p in parcels:
            sizes = 2 * np.array(p["n_tokens"])
            raw = pa.decompress(p["ids"], decompressed_size=int(sizes.sum()), codec="zstd", asbytes=True)
            at = 0
            for k, (slot, size) in enumerate(zip(p["slot"], sizes.tolist(), strict=True)):
                i = slot - begin
                if there[i]:
                    raise RuntimeError(f"slot {slot} came twice")
                there[i] = True
                out[i, : size // 2] = np.frombuffer(raw, "<u2", size // 2, at)
                at += size
                for c in REPORT:
                    columns[c][i] = p[c][k]
        if not there.all():
            raise RuntimeError(f"{n - int(there.sum())} sequences of shard {number} are missing")
        _put(folder, _shard_name(number), out.tobytes())
        where = np.arange(n)
        return pa.record_batch(
            {
                "slot": pa.array(begin + where),
                "shard": pa.array(np.full(n, number)),
                "byte_offset": pa.array(where * stride),
                **{c: pa.array(columns[c], pa.int64()) for c in REPORT},
                "ids_crc32": pa.array([zlib.crc32(x) for x in out], pa.int64()),
            }
        ).select([c.split()[0] for c in SCHEMA.split(", ")])

    def run(batches):
        parcels: dict[int, list[dict]] = {}
        for b in batches:
            for p in b.to_pylist():
                parcels.setdefault(p["shard"], []).append(p)
        for number, some in parcels.items():
            yield shard(number, some)

    return run


def materialise(docs: DataFrame, folder: str | None = None, path: str | None = None, ranks: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """Writes the shards and their manifest; one row for each slot. `folder` must be shared by all machines (default: one in the checkpoint folder)."""
    spark = docs.sparkSession
    if path is None:
        path, ranks = tokenizer_path(), ranks_path()
    work = f"{checkpoint_dir(spark)}/training-order-{uuid.uuid4().hex}"
    folder = folder or f"{work}/shards"
    arrow(docs.select(F.col("doc_id").cast("long"), "text"), _make(path, ranks, length), TABLE).write.option("compression", "none").parquet(f"{work}/sequences")
    table = spark.read.schema(TABLE).parquet(f"{work}/sequences")
    counted = table.groupBy("part").agg(F.sum("n").alias("n")).collect()  # one number for each input partition
    counts = np.zeros(max((r.part for r in counted), default=-1) + 1, np.int64)
    for r in counted:
        counts[r.part] = r.n
    total = int(counts.sum())
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    shards = -(-total // per_shard)
    if total:
        emitted = table.mapInArrow(_emit(per_shard, np.cumsum(counts) - counts, Permutation(total, key)), PARCEL)
        written = emitted.repartitionById(shards, F.col("shard")).mapInArrow(_write(folder, length, per_shard, total), SCHEMA)
    else:
        written = spark.createDataFrame([], SCHEMA)
    written.write.parquet(f"{work}/slots")
    about = {"sequences": total, "length": length, "shards": shards, "per_shard": per_shard, "key": key, "end_id": END_ID, "pad_id": PAD_ID}
    _put(folder, MANIFEST, json.dumps(about).encode())
    remove_folder(spark, f"{work}/sequences")
    return spark.read.schema(SCHEMA).parquet(f"{work}/slots")


def manifest(folder: str) -> dict:
    """What the folder's shards are; raises where they are not all there."""
    store, base = _store(folder)
    with store.open_input_file(f"{base}/{MANIFEST}") as f:
        return json.loads(f.read())


def read_slots(folder: str, start: int, stop: int):
    """Sequences of the slots start..stop-1, read one after the other; resume with a later start."""
    about = manifest(folder)
    store, base = _store(folder)
    length, per_shard = about["length"], about["per_shard"]
    slot, stop = start, min(stop, about["sequences"])
    while slot < stop:
        number = slot // per_shard
        with store.open_input_file(f"{base}/{_shard_name(number)}") as f:
            f.seek((slot - number * per_shard) * 2 * length)
            for _ in range(slot, min(stop, (number + 1) * per_shard)):
                yield slot, np.frombuffer(f.read(2 * length), "<u2")
                slot += 1
