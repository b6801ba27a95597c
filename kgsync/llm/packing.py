"""Packing of documents into sequences of fixed length by the sum-of-squares rule.

A document's ids (and an end id) fill whole sequences of their own as far as they reach; the rest, shorter
than a sequence, is placed online: of all fill levels h that can take it (level 0: a new window), the one
after which the sum over the levels of squared counts of partially filled windows is least. A level array
holds the counts, a stack for each level the windows. When a task's documents end, the emptiest windows
are cut to fill the fullest, so a task leaves one padded sequence at most.

Placement is local to a task, so nothing is shuffled; memory is bounded by an Arrow batch, a group of
texts and the windows that are partially filled. A task that runs again on the same rows gives the same rows.

Null texts count as empty (one end id). Null and repeated doc_id are packed like others. Extra columns
are ignored. An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_ids import Encoder, ranks_path, tokenizer_path
from .common import arrow

LENGTH = 2048
END_ID = 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Texts that are tokenized together, so that a batch of long ones is never held as ids at once.
GROUP_CHARS = 4 << 20


class Packer:
    """Pieces are (doc_id, start, ids as bytes, doc_tokens); `closed` takes (pieces of one window)."""

    def __init__(self, length: int = LENGTH, width: int = 4):
        self.length, self.width = length, width
        self.levels = np.zeros(length + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(length)]

    def place(self, piece: tuple) -> list | None:
        """The window that this piece completes, if it completes one."""
        size, n, levels = len(piece[2]) // self.width, self.length, self.levels
        if size == n:
            return [piece]
        # change of the sum of squares, less a constant: from level h to h + size; full windows count nothing
        gain = 2 * (levels[size:] - levels[: n - size + 1]) + 2
        gain[n - size] = 1 - 2 * levels[n - size]
        gain[levels[: n - size + 1] == 0] = np.iinfo(np.int64).max
        gain[0] = 2 * levels[size] + 1
        h = n - size - int(np.argmin(gain[::-1]))  # of equals the fullest
        window = [] if h == 0 else self.windows[h].pop()
        levels[h] -= h > 0
        window.append(piece)
        if h + size == n:
            return window
        levels[h + size] += 1
        self.windows[h + size].append(window)
        return None

    def finish(self) -> Iterator[list]:
        """The remaining windows, all full but the last one."""
        left = [[self.length - h, w] for h in range(self.length - 1, 0, -1) for w in self.windows[h]]
        i, j, width = 0, len(left) - 1, self.width
        while i < j:
            room, window = left[i]
            doc, start, ids, total = left[j][1][-1]
            have = len(ids) // width
            if have <= room:
                window.append(left[j][1].pop())
                left[j][0] += have
                left[i][0] -= have
            else:
                window.append((doc, start + have - room, ids[(have - room) * width :], total))
                left[j][1][-1] = (doc, start, ids[: (have - room) * width], total)
                left[j][0] += room
                left[i][0] = 0
            j -= not left[j][1]
            if not left[i][0]:
                yield left[i][1]
                i += 1
        if i == j and left[i][1]:
            yield left[i][1]


def groups(batches, limit: int = GROUP_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts (second column) have a bounded number of bytes, or one row."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def _rows(windows: list[tuple[int, list]], width: int) -> pa.RecordBatch:
    rows = []
    for number, window in windows:
        offset = 0
        for doc, start, ids, total in window:
            rows.append((doc, start, len(ids) // width, zlib.crc32(ids), total, number, offset))
            offset += len(ids) // width
    cols = list(zip(*rows, strict=True)) or [[]] * 7
    return pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=[c.split()[0] for c in SCHEMA.split(", ")])


def _pack(path: str, ranks: str | None, length: int, end_id: int):
    def run(batches):
        encode, packer = Encoder(path, ranks), Packer(length)
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 36
        done: list[tuple[int, list]] = []
        for group in groups(batches):
            ids, edges = encode.of(group.column(1))
            for doc, a, b in zip(group.column(0).to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                data = ids[a:b].tobytes() + end
                total = len(data) // 4
                for start in range(0, total, length):
                    if window := packer.place((doc, start, data[4 * start : 4 * (start + length)], total)):
                        done.append((number, window))
                        number += 1
            if done:
                yield _rows(done, 4)
                done = []
        for window in packer.finish():
            done.append((number, window))
            number += 1
        yield _rows(done, 4)

    return run


def pack(docs: DataFrame, path: str | None = None, ranks: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: its document, place in it and checksum, and its place in a sequence of `length` ids.

    `path` is a tokenizer's file and `ranks`, if given, the same vocabulary for tiktoken, on every machine.
    """
    if path is None:
        path, ranks = tokenizer_path(), ranks_path()
    return arrow(docs.select(F.col("doc_id").cast("long"), "text"), _pack(path, ranks, length, end_id), SCHEMA)
