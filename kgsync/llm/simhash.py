"""SimHash near-duplicates: every pair of fingerprints within a Hamming radius, by bit-sliced comparison.

1. A fingerprint is made of each whole text; equal fingerprints are one node.
2. The 64 bits are cut into `blocks` blocks, as many as the number of nodes asks for. Two fingerprints within the radius agree in at least
   blocks - radius of them, so a node goes into one bucket for each choice of that many blocks, and no
   link is lost. A bucket over BUCKET nodes is cut into groups, and one cell made of each pair of groups:
   cells are of bounded size, whatever the bucket.
3. In a cell (or a slab of many small ones) bit planes lie vertically: plane p holds bit p of all nodes.
   Shifting the planes by k compares each node with its k-th follower, 64 pairs in a word: the differing
   bits are added up by carry-save counters that start so that the top carry means "over the radius", and
   a block of pairs is given up once it is set for all of them.
4. A cell passes on a spanning star of each of its components, not its pairs. Components of all stars
   are found by joins.

Null and empty texts have fingerprint zero and are linked like others. A doc_id is one document: rows that
share it are linked, whatever their texts, and get one component_id. Rows without doc_id link nothing:
they get the component of their fingerprint, or null. Repeated rows are kept. Extra columns are ignored.
An empty table gives an empty table.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, cut_lineage, lanes
from .components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
BUCKET = 2048
#: Expected nodes in a bucket from which on buckets get longer keys.
DENSE = 512
SLAB = 1 << 16
STEP_BYTES = 4 << 20
#: Words of 64 pairs that are given up together.
PAIR_WORDS = 512
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _words(raw: bytes):
    """Lists of words, each with the last SHINGLE - 1 words of the one before it in front."""
    at, tail = 0, []
    while at < len(raw):
        end = at + STEP_BYTES
        cut = _SPACE.search(raw, end) if end < len(raw) else None
        end = cut.start() if cut else len(raw)
        words = tail + raw[at:end].split()
        yield words
        at, tail = end, words[len(words) - min(SHINGLE - 1, len(words)) :]


def shingles(text: str | None):
    """Lists of the text's shingles as bytes, repeats included."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    several, last = False, []
    for words in _words(raw):
        last = words
        if len(words) >= SHINGLE:
            several = True
            yield list(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)))
    if last and not several:
        yield [b" ".join(last)]


def _majority(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64), np.diff(np.r_[starts, len(hashes)])


def fingerprints_of(texts) -> np.ndarray:
    """uint64 for each text."""
    from xxhash import xxh64_intdigest

    held, owner, size = [], [], 0

    def flush():
        nonlocal held, owner, size
        if size:
            one, n = _majority(np.concatenate(held), np.cumsum([0] + [len(h) for h in held[:-1]]))
            np.add.at(ones_a, owner, one)
            np.add.at(counts_a, owner, n)
        held, owner, size = [], [], 0

    texts = list(texts)
    ones_a, counts_a = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    for d, text in enumerate(texts):
        for part in shingles(text):
            held.append(np.fromiter([xxh64_intdigest(s, SEED) for s in part], np.uint64, len(part)))
            owner.append(d)
            size += len(part)
            if size > SLAB:
                flush()
    flush()
    set_bits = 2 * ones_a > counts_a[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").reshape(-1).view(np.uint64)


def _fingerprint(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            *others, _ = part.schema.names
            fp = fingerprints_of(x.as_py() for x in part.column("text"))
            yield pa.record_batch({**{c: part.column(c) for c in others}, "fp": pa.array(fp.view(np.int64))})


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long)."""
    return arrow(docs.select(F.col("doc_id").cast("long"), "text"), _fingerprint, "doc_id long, fp long")


def _planes(fp: np.ndarray) -> np.ndarray:
    """64 planes of the bits of all fingerprints, in words with one word of zeros behind them."""
    n = len(fp)
    bits = np.unpackbits(fp.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    out = np.zeros((64, (n + 63) // 64 * 8 + 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def _shifted(planes: np.ndarray, k: int, a: int, b: int) -> np.ndarray:
    """Words a..b-1 of a plane from which the first k bits are gone."""
    q, r = divmod(k, 64)
    w = planes[a + q : b + q + 1]
    out = np.zeros(b - a, np.uint64)
    low = w[: b - a]
    out[: len(low)] = low >> np.uint64(r)
    if r:
        high = w[1 : b - a + 1]
        out[: len(high)] |= high << np.uint64(64 - r)
    return out


def close_followers(planes: np.ndarray, same: np.ndarray, k: int, radius: int = RADIUS) -> np.ndarray:
    """Positions i of `same` (booleans) for which the fingerprints i and i + k differ in at most `radius` bits."""
    n = len(same)
    wanted = np.zeros(planes.shape[1] * 8, np.uint8)
    packed = np.packbits(same, bitorder="little")
    wanted[: len(packed)] = packed
    wanted = wanted.view(np.uint64)
    width = (radius + 1).bit_length()
    start = (1 << width) - 1 - radius
    found = []
    for a in range(0, (n + 63) // 64, PAIR_WORDS):
        b = min(a + PAIR_WORDS, (n + 63) // 64)
        over = ~wanted[a:b]
        if not (~over).any():
            continue
        counter = [np.full(b - a, ~np.uint64(0) if start >> i & 1 else np.uint64(0)) for i in range(width)]
        for p in range(64):
            carry = planes[p, a:b] ^ _shifted(planes[p], k, a, b)
            for i in range(width):
                counter[i], carry = counter[i] ^ carry, counter[i] & carry
            over |= carry
            if p >= radius and p % 4 == 3 and (over == ~np.uint64(0)).all():
                break
        else:
            hits = np.flatnonzero(np.unpackbits((~over).view(np.uint8), bitorder="little")) + 64 * a
            found.append(hits)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def link_slab(bucket: np.ndarray, fp: np.ndarray, node: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of the components inside each bucket. Equal numbers in `bucket` lie together."""
    n = len(fp)
    comp = np.arange(n)

    def roots(x):
        while True:
            y = comp[comp[x]]
            if (y == comp[x]).all():
                return y
            comp[x] = y

    rows, k, span = np.arange(n), 1, 0
    while True:
        if k >= span:  # keep the buckets that are long enough and not one component yet
            own = bucket[rows]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
            size = np.diff(np.r_[first, len(own)])
            r = roots(rows)
            parts = np.maximum.reduceat(r, first) != np.minimum.reduceat(r, first) if len(first) else np.zeros(0, bool)
            rows = rows[np.repeat((size > k) & parts, size)]
            if not len(rows):
                break
            planes, span = _planes(fp[rows]), 2 * k
            own = bucket[rows]
        same = np.zeros(len(rows), bool)
        same[:-k] = own[:-k] == own[k:]
        i = close_followers(planes, same, k, radius)
        a, b = roots(rows[i]), roots(rows[i + k])
        for x, y in zip(a[a != b].tolist(), b[a != b].tolist(), strict=True):
            while comp[x] != x:
                x = comp[x]
            while comp[y] != y:
                y = comp[y]
            comp[max(x, y)] = min(x, y)
        k += 1
    r = roots(np.arange(n))
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, r, node)
    root = least[r]
    linked = root != node
    return node[linked], root[linked]


def _link(radius: int):
    def edges(bucket, fp, node):
        a, b = link_slab(np.asarray(bucket), fp, node, radius)
        return pa.record_batch({"a": pa.array(a), "b": pa.array(b)})

    def run(batches):
        held: list[list[np.ndarray]] = []
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(5)]
            held.append([np.stack(cols[:3], axis=1), cols[3], cols[4]])
            if sum(len(h[1]) for h in held) < SLAB:
                continue
            keys, fp, node = (np.concatenate(x) for x in zip(*held, strict=True))
            new = np.r_[0, (keys[1:] != keys[:-1]).any(axis=1)].astype(np.int64)
            bucket = np.cumsum(new)
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            if cut:
                yield edges(bucket[:cut], fp[:cut].view(np.uint64), node[:cut])
            held = [[keys[cut:], fp[cut:], node[cut:]]]
        if held:
            keys, fp, node = (np.concatenate(x) for x in zip(*held, strict=True))
            bucket = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).any(axis=1)].astype(np.int64)) if len(fp) else np.zeros(0, np.int64)
            yield edges(bucket, fp.view(np.uint64), node)

    return run


def masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of all choices of blocks - radius blocks."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:], strict=False)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(c)) for c in combinations(one, blocks - radius)]


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """The fewest blocks, two more than the radius at least, whose keys leave some DENSE of n random nodes in a bucket."""
    blocks = radius + 2
    while n > DENSE << 64 * (blocks - radius) // blocks and blocks < 2 * radius:
        blocks += 1
    return blocks


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """(a, b): stars that join the nodes (node, fp; distinct fp) within the radius, some of them more than once."""
    n, blocks = lanes(nodes.sparkSession), blocks or blocks_for(nodes.count(), radius)
    keys = F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(blocks, radius))))
    rows = nodes.select("node", "fp", F.explode(keys).alias("k")).select("k.choice", "k.key", "fp", "node")
    sizes = rows.groupBy("choice", "key").agg(F.count("*").alias("size")).where(F.col("size") > BUCKET)
    hot = cut_lineage(sizes.select("choice", "key", F.ceil(F.col("size") * 2 / BUCKET).cast("int").alias("groups")))
    group = F.pmod(F.xxhash64("fp"), F.col("groups")).cast("int")
    grid = F.transform(F.sequence(F.lit(0), F.col("groups") - 1), lambda j: F.least(j, group).cast("long") * F.col("groups") + F.greatest(j, group))
    dealt = rows.join(hot, ["choice", "key"], "left").withColumn("groups", F.coalesce("groups", F.lit(1))).select("choice", "key", F.explode(grid).alias("cell"), "fp", "node")
    # choice, key and cell as longs, so that a batch's keys are one array
    cells = dealt.select(F.col("choice").cast("long"), "key", "cell", "fp", "node").repartition(n, "choice", "key", "cell").sortWithinPartitions("choice", "key", "cell")
    return arrow(cells, _link(radius), "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    printed = cut_lineage(fingerprints(docs))
    named = printed.where("doc_id is not null")
    nodes = cut_lineage(named.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = links(nodes.select(F.col("fp").alias("node"), "fp"), radius, blocks)
    # fingerprints of one doc_id: a star, too
    same = named.groupBy("doc_id").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b <> top").select("doc_id", "b")
    shared = named.join(same, "doc_id").select(F.col("fp").alias("a"), "b")
    roots = nodes.join(components(found.union(shared)).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = roots.select("fp", "root").join(least, "root").select("fp", "component_id")
    return printed.join(by_fp, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of fingerprints, with all its columns: one with the least doc_id, nulls last.

    Here rows are what is linked, so that no text goes but for one like it: rows that share a doc_id are
    told apart by their texts, and each stands for its own component. Of several texts with the least
    doc_id in one component, the one with the least hash stays.
    """
    doc, key = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("key")
    printed = arrow(docs.select(doc, key, "text"), _fingerprint, "doc long, key long, fp long")
    nodes = cut_lineage(printed.groupBy("fp").agg(F.min(F.struct("doc", "key")).alias("least")).select("fp", F.col("fp").alias("node"), "least"))
    found = components(links(nodes.select("node", "fp")))
    kept = nodes.join(found, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("least").alias("least")).select("least.*")
    # of rows with the same doc_id and text one stays
    by = Window.partitionBy("doc", "key").orderBy(F.col("text").asc_nulls_first())
    taken = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), doc, key, "text")
    chosen = taken.join(kept, ["doc", "key"], "left_semi").withColumn("n", F.row_number().over(by)).where("n = 1")
    return chosen.select("row.*")
