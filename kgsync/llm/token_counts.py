"""Token counts under a sentencepiece BPE model, without token ids.

Pieces of the model never hold its space mark anywhere but at their start, so a text falls apart into
pre-tokens (a run of space marks and what follows up to the next run) that are segmented independently
of each other. Pieces are therefore counted once per distinct pre-token and joined to the documents'
pre-token frequencies:

1. `_postings`: each Arrow batch of documents (a block) becomes, for every lane (a hash of the
   pre-token), one compressed posting block: distinct pre-tokens with their (document, frequency) pairs.
   A word that is in every document is one entry in a block, so frequent words do not make hot keys.
2. `_lookups`: all occurrences of a pre-token meet in the partition of its lane, and lanes come one after
   the other; a pre-token's pieces are counted once there, joined to the postings, and summed by document
   into one vector for each block and lane.
3. `_totals`: the vectors of a block are summed.

There are as many lanes as the input asks for (`common.deal`), MOST_LANES at most, as distinct pre-tokens
grow more slowly than text. Memory is bounded by a block and a lane's distinct pre-tokens. Blocks are named by partition
and number and carry a checksum of their documents; the input must be a deterministic scan (a table),
as Spark's own recomputation of lost tasks presumes.

Null texts count as empty. Null and repeated doc_id are kept as rows of their own. Extra columns are
ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MOST_LANES, arrow, deal, text_bytes

#: Documents of a block, and the bytes after which it is closed early.
BLOCK_DOCS, BLOCK_BYTES = 10_000, 32 << 20
MARK = "▁"
_PRE = re.compile(f"{MARK}+[^{MARK}]*")


def model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def check_model(sp) -> None:
    """Pre-tokens are independent only if no piece has a space mark after another character, and texts reach the pieces unchanged."""
    inner = [p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if MARK in p.lstrip(MARK)]
    probe = "  aﬁ  b\t\n "
    if inner or sp.normalize(probe) != MARK + probe.replace(" ", MARK):
        raise ValueError("this model's pieces cross pre-tokens or it rewrites texts")


def pretokens(text: str) -> list[str]:
    """Without the first mark of each, which the model itself puts before every text it is given."""
    if not text:
        return []
    if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [x[1:].replace(MARK, " ") for x in _PRE.findall(MARK + text.replace(" ", MARK))]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(i)
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _pack(*arrays: np.ndarray) -> bytes:
    body = b"".join(struct.pack("<q", len(a)) + a.astype("<u4").tobytes() for a in arrays)
    return struct.pack("<q", len(body)) + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> list[np.ndarray]:
    n = struct.unpack_from("<q", data)[0]
    body, at, out = pa.decompress(data[8:], decompressed_size=n, codec="zstd", asbytes=True), 0, []
    while at < n:
        k = struct.unpack_from("<q", body, at)[0]
        out.append(np.frombuffer(body, "<u4", k, at + 8))
        at += 8 + 4 * k
    return out


def _postings(n_lanes: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(_blocks(batches)):
            seen: dict[str, int] = {}
            words, freqs, sizes, n_bytes = [], [], [], []
            for t in texts:
                counts = Counter(pretokens(t))
                words += [seen.setdefault(w, len(seen)) for w in counts]
                freqs += counts.values()
                sizes.append(len(counts))
                n_bytes.append(len(t.encode("utf-8", "surrogatepass")))
            head = pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema) as w:
                w.write_batch(head)
            header = sink.getvalue().to_pybytes()
            block = f"{part}-{number}-{zlib.crc32(header):08x}"
            out = [(zlib.crc32(block.encode()) % n_lanes, True, header, b"")]
            word, freq = np.array(words, np.int64), np.array(freqs, np.uint32)
            doc = np.repeat(np.arange(len(ids), dtype=np.uint32), sizes)
            vocab = [w.encode("utf-8", "surrogatepass") for w in seen]
            lane_of = np.fromiter((zlib.crc32(w) % n_lanes for w in vocab), np.int64, len(vocab))
            order = np.argsort(lane_of, kind="stable")  # words by lane
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            by = np.argsort(rank[word], kind="stable")  # postings by lane and word
            doc, freq = doc[by], freq[by]
            per_word = np.bincount(rank[word], minlength=len(vocab))
            first_word = np.searchsorted(lane_of[order], np.arange(n_lanes + 1))
            first_posting = np.concatenate(([0], np.cumsum(per_word)))
            lengths = np.array([len(vocab[i]) for i in order], np.int64)
            for lane in range(n_lanes):
                a, b = first_word[lane], first_word[lane + 1]
                if a < b:
                    x, y = first_posting[a], first_posting[b]
                    blob = b"".join(vocab[i] for i in order[a:b])
                    out.append((lane, False, _pack(lengths[a:b], per_word[a:b], doc[x:y], freq[x:y], np.array([len(ids)])), pa.compress(blob, codec="zstd", asbytes=True) + struct.pack("<q", len(blob))))
            for k in range(0, len(out), 256):
                lane, header_row, data, blob = zip(*out[k : k + 256], strict=True)
                yield pa.record_batch({"block": pa.array([block] * len(lane)), "lane": pa.array(lane, pa.int32()), "is_header": pa.array(header_row), "data": pa.array(data, pa.binary()), "words": pa.array(blob, pa.binary())})

    return run


def _lookups(path: str):
    def run(batches):
        sp = model(path)
        check_model(sp)
        known: dict[bytes, int] = {}
        now = None
        for batch in batches:
            rows = []
            for block, lane, header, data, words in zip(*(batch.column(k).to_pylist() for k in ("block", "lane", "is_header", "data", "words")), strict=True):
                if lane != now:
                    known, now = {}, lane
                if header:
                    rows.append((block, True, data))
                    continue
                lengths, per_word, doc, freq, n_docs = _unpack(data)
                blob = pa.decompress(words[:-8], decompressed_size=struct.unpack("<q", words[-8:])[0], codec="zstd", asbytes=True)
                ends = np.cumsum(lengths, dtype=np.int64).tolist()
                vocab = [blob[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                new = [w for w in vocab if w not in known]
                # a pre-token whose first mark was cut off and that is empty is a lone mark, which only a longer text shows
                known.update(zip(new, _count(sp, new), strict=True))
                pieces = np.fromiter(map(known.__getitem__, vocab), np.int64, len(vocab))
                sums = np.bincount(doc, weights=np.repeat(pieces, per_word) * freq, minlength=int(n_docs[0]))
                rows.append((block, False, _pack(sums.astype(np.int64))))
            block, header, data = zip(*rows, strict=True)
            yield pa.record_batch({"block": pa.array(block), "is_header": pa.array(header), "data": pa.array(data, pa.binary())})

    return run


def _count(sp, words: list[bytes]) -> list[int]:
    texts = [w.decode("utf-8", "surrogatepass") for w in words]
    lone = len(sp.encode("a ")) - len(sp.encode("a"))
    return [len(x) if t else lone for t, x in zip(texts, sp.encode(texts, num_threads=1), strict=True)] if texts else []


def _totals(limit: int):
    def finish(block, head, total):
        if head is None:
            raise RuntimeError(f"block {block} has counts but no documents: the input is not deterministic")
        b = pa.ipc.open_stream(head).read_next_batch()
        total = np.zeros(b.num_rows, np.int64) if total is None else total
        return pa.record_batch({"doc_id": b.column(0), "n_bytes": b.column(1), "n_tokens": pa.array(total), "over_limit": pa.array(total > limit)})

    def run(batches):
        now, head, total = None, None, None
        for batch in batches:
            for block, header, data in zip(*(batch.column(k).to_pylist() for k in ("block", "is_header", "data")), strict=True):
                if block != now:
                    if now is not None:
                        yield finish(now, head, total)
                    now, head, total = block, None, None
                if header:
                    head = data
                else:
                    v = _unpack(data)[0].astype(np.int64)
                    total = v if total is None else total + v
        if now is not None:
            yield finish(now, head, total)

    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; `path` is the model's file on every machine."""
    parts, n = deal(docs.sparkSession, text_bytes(docs))
    path = path or model_path()
    posted = arrow(docs.select(F.col("doc_id").cast("long"), "text"), _postings(min(n, MOST_LANES)), "block string, lane int, is_header boolean, data binary, words binary")
    dealt = posted.repartition(min(parts, MOST_LANES), "lane").sortWithinPartitions("lane")
    counted = dealt.mapInArrow(_lookups(path), "block string, is_header boolean, data binary")
    by_block = counted.repartition(parts, "block").sortWithinPartitions("block")
    return by_block.mapInArrow(_totals(limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
