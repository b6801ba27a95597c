"""Sentencepiece (merge type) encoding with seeded merge-dropout, and decoding.

`Model` reads the pieces and scores of a model file through the public library and segments itself: an
agenda holds the candidate merges of neighbouring symbols, best score first and leftmost of equals; each
candidate that comes up (the t-th of a pre-token) is skipped if its keyed hash, of seed, doc_id, the
pre-token's number in the text and t, falls below the dropout rate. So a word varies from one occurrence
to the next, within a text and between texts, and the same text of the same doc_id always comes out
alike. With rate 0 the result is the library's own.

Characters without a piece become byte pieces, so decoding gives back the text whatever was skipped. With
dropout a space mark in a text becomes byte pieces, too, and reads back; at rate 0 it is a space, as in
the library, and `lossless` is false for its text.

The words of a group of texts are dictionary-encoded. A segmentation depends on a word and on which of
its candidates are skipped, nothing else; so all distinct words are segmented without a skip first, which
tells how many candidates come up. The occurrences whose hashes skip one are segmented again, once for
each distinct (word, candidates skipped so far), which tells how many come up then, and so on until no
occurrence has a further skip. `segment` works on one pre-token with a heap; `segment_all` has the same
agenda for many words of one length at once, as rows of arrays that take one candidate in each round.

Memory is bounded by an Arrow batch and a group of texts; nothing is shuffled. Null texts count as empty;
null and repeated doc_id are kept, null ones keyed alike; extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import heapq
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_ids import gather, spaced_words
from .common import arrow
from .packing import groups
from .token_counts import MARK, _PRE, check_model, model, model_path

#: Words up to this length are segmented many at a time, so many rows of them; of their candidates this many may be skipped.
ROW, ROWS, STEPS = 32, 1 << 16, 64
#: Stands for a space mark in a text; no valid text holds it.
LITERAL = "\udc81"
_NONE = np.int32(2**31 - 1)
SEED, RATE = 20_240_601, 0.1
SCHEMA = "doc_id long, n_bytes long, n_tokens long, n_skipped long, ids_crc32 long, lossless boolean"
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _utf8(s: str) -> bytes:
    return s.replace(LITERAL, MARK).encode("utf-8", "surrogatepass")


class Model:
    def __init__(self, path: str, seed: int = SEED, rate: float = RATE):
        sp = model(path)
        check_model(sp)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.byte = [0] * 256
        normal = {}
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte[int(p[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal[p] = i
        self.ids = normal
        self.score = {p: -sp.get_score(i) for p, i in normal.items()}
        self.text = [bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() if p in normal else b"" for i, p in enumerate(self.pieces)]
        self.seed = (seed * 0xD6E8FEB86659FD93 + 1) & _MASK
        self.below = int(rate * (1 << 32))
        self.literal = MARK if not self.below else LITERAL
        self._tables()

    def keys(self, docs: list[int | None], numbers: np.ndarray, each: np.ndarray) -> np.ndarray:
        """Keys of pre-tokens: their numbers in the texts, and how many belong to each doc_id."""
        doc = np.array([0 if d is None else d for d in docs], np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        doc = _mix(doc + np.array([d is None for d in docs], np.uint64) ^ np.uint64(self.seed))
        return _mix(np.repeat(doc, each) + numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def skips(self, key: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Whether candidates are skipped, given their occurrences' keys."""
        return _mix(key + step.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)) >> np.uint64(32) < np.uint64(self.below)

    def segment(self, pre: str, key: int | None = None) -> tuple[list[int], int, int]:
        """Ids of a pre-token (marks instead of spaces), how many candidates came up, and how many of them were skipped; none without a key."""
        score = self.score
        sym: list[str | None] = list(pre)
        n, step, skipped, draws = len(sym), 0, 0, np.zeros(0, bool)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(score[m], i, m) for i, m in enumerate(map(str.__add__, sym, sym[1:])) if m in score]
        heapq.heapify(agenda)
        while agenda:
            _, i, m = heapq.heappop(agenda)
            if sym[i] is None or (j := after[i]) >= n or len(sym[i]) + len(sym[j]) != len(m) or sym[i] + sym[j] != m:
                continue
            if key is not None:
                if step == len(draws):
                    draws = np.r_[draws, self.skips(np.uint64(key), np.arange(step, 2 * step + 16))]
                if draws[step]:
                    step, skipped = step + 1, skipped + 1
                    continue
            step += 1
            sym[i], sym[j] = m, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := m + sym[k]) in score:
                    heapq.heappush(agenda, (score[x], i, x))
            if (b := before[i]) >= 0 and (x := sym[b] + m) in score:
                heapq.heappush(agenda, (score[x], b, x))
        out = []
        for s in sym:
            if s is not None:
                i = self.ids.get(s)
                out += [self.byte[c] for c in _utf8(s)] if i is None else [i]
        return out, step, skipped

    def _tables(self) -> None:
        size = len(self.pieces)
        order = sorted(self.ids, key=self.score.get)
        self.by_rank = np.array([self.ids[p] for p in order], np.int32)
        rank = {p: r for r, p in enumerate(order)}
        # characters: their piece, or beyond the pieces their code point
        self.first = np.arange(0x110000, dtype=np.int32) + size
        pairs = {}
        for p, i in self.ids.items():
            if len(p) == 1:
                self.first[ord(p)] = i
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank[p]
        bits = max(4, (8 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.pair_key = np.full(1 << bits, -1, np.int64)
        self.pair_rank = np.full(1 << bits, _NONE, np.int32)
        self.probes = 1
        for key, r in pairs.items():
            h, n = (key * 0x9E3779B97F4A7C15 & _MASK) >> (64 - bits), 1
            while self.pair_key[h] >= 0:
                h, n = (h + 1) & ((1 << bits) - 1), n + 1
            self.pair_key[h], self.pair_rank[h] = key, r
            self.probes = max(self.probes, n)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the merges of neighbouring symbols, _NONE where there is no such piece."""
        key = a.astype(np.int64) << 32 | b
        h = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        found = self.pair_key[h]
        out = np.where(found == key, self.pair_rank[h], _NONE)
        todo = np.flatnonzero((found != key) & (found >= 0))
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            h[todo] = (h[todo] + 1) & (len(self.pair_key) - 1)
            found = self.pair_key[h[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.pair_rank[h[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out

    def _rows(self, sym: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of words of one length (rows), how many are left of each, and how many candidates came up; bit t of `skip`: skip the t-th."""
        n, width = sym.shape
        size, steps = np.full(n, width), np.zeros(n, np.int64)
        out = np.zeros_like(sym)
        cand = np.full(sym.shape, _NONE, np.int32)
        cand[:, :-1] = self._ranks(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(n, -1)
        live, column, step = np.arange(n), np.arange(width), 0
        while True:
            best = cand.argmin(axis=1)
            row = np.arange(len(live))
            rank = cand[row, best]
            ended = rank == _NONE
            if ended.any():
                out[live[ended]] = sym[ended]
                steps[live[ended]] = step
                go = ~ended
                live, sym, cand, skip, best, rank = (x[go] for x in (live, sym, cand, skip, best, rank))
                row = np.arange(len(live))
            if not len(live):
                return out, size, steps
            merged = self.by_rank[rank]
            if step < STEPS:
                drop = skip >> np.uint64(step) & np.uint64(1) == 1
                cand[row[drop], best[drop]] = _NONE
                take, best, merged = row[~drop], best[~drop], merged[~drop]
            else:
                take = row
            step += 1
            if not len(take):
                continue
            moved = np.minimum(column + (column > best[:, None]), width - 1)
            for x in (sym, cand):
                x[take] = np.take_along_axis(x[take], moved, axis=1)
            sym[take, best] = merged
            size[live[take]] -= 1
            cand[take, -1] = _NONE
            left = size[live[take]]
            cand[take, np.minimum(left, width) - 1] = _NONE
            ok = best + 1 < left
            cand[take[ok], best[ok]] = self._ranks(sym[take[ok], best[ok]], sym[take[ok], best[ok] + 1])
            ok = best > 0
            cand[take[ok], best[ok] - 1] = self._ranks(sym[take[ok], best[ok] - 1], sym[take[ok], best[ok]])

    def segment_all(self, words: list[str], skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in one array, how many each has, and how many candidates came up. Longer ones than ROW: none, if `skip` is given."""
        counts, steps = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        given = np.zeros(len(words), np.uint64) if skip is None else skip
        by = np.argsort(lengths, kind="stable")
        edges = np.searchsorted(lengths[by], np.arange(ROW + 2))
        parts, order = [], []
        for n in range(1, ROW + 1):
            for a in range(edges[n], edges[n + 1], ROWS):
                some = by[a : min(a + ROWS, edges[n + 1])]
                points = np.frombuffer("".join([words[i] for i in some]).encode("utf-32-le", "surrogatepass"), np.uint32)
                sym, size, came = self._rows(self.first[points].reshape(-1, n), given[some])
                flat = sym[np.arange(n) < size[:, None]]
                ids, width = self._bytes(flat)
                parts.append(ids)
                counts[some] = np.add.reduceat(width, np.cumsum(size) - size)
                steps[some] = came
                order.append(some)
        for i in by[edges[ROW + 1] :].tolist() if skip is None else ():
            ids, steps[i], _ = self.segment(words[i])
            parts.append(np.array(ids, np.int32))
            counts[i] = len(ids)
            order.append(np.array([i]))
        ids = np.concatenate(parts or [np.zeros(0, np.int32)]).astype(np.uint16)
        order = np.concatenate(order or [np.zeros(0, np.int64)]).astype(np.int64)
        start = np.zeros(len(words), np.int64)
        start[order] = np.cumsum(counts[order]) - counts[order]
        return ids[gather(start, counts, np.arange(len(words)))[0]], counts, steps

    def _bytes(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols with byte pieces in place of characters that have no piece, and how many ids each symbol became."""
        width = np.ones(len(sym), np.int64)
        alone = np.flatnonzero(sym >= len(self.pieces))
        if not len(alone):
            return sym, width
        data = [[self.byte[c] for c in _utf8(chr(x - len(self.pieces)))] for x in sym[alone].tolist()]
        width[alone] = [len(d) for d in data]
        out = np.repeat(sym, width)
        at = np.cumsum(width) - width
        for i, d in zip(at[alone].tolist(), data, strict=True):
            out[i : i + len(d)] = d
        return out, width

    def _occurrences(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens, the number of each occurrence's one in the texts' order, and the texts' edges in those."""
        words, index, edges, texts = spaced_words(texts)
        loose = pc.or_(pc.equal(words, ""), pc.match_substring(words, MARK)).to_numpy(zero_copy_only=False)
        odd = np.add.reduceat(loose[index].astype(np.int64), edges[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        plain = [texts[i].as_py() for i in np.flatnonzero(odd).tolist()]
        more = [_PRE.findall(MARK + t.replace(MARK, self.literal).replace(" ", MARK)) if t else [] for t in plain]
        known = [MARK + w for w in words.to_pylist()]
        names = {p: len(known) + i for i, p in enumerate(dict.fromkeys(p for m in more for p in m))}
        per_text = np.diff(edges)
        if odd.any():
            rest = iter(more)
            index = np.concatenate([np.array([names[p] for p in next(rest)], np.int64) if o else index[a:b] for o, a, b in zip(odd.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)])
            per_text[odd] = [len(m) for m in more]
        known += names
        used = np.flatnonzero(np.bincount(index, minlength=len(known)))
        number = np.zeros(len(known), np.int64)
        number[used] = np.arange(len(used))
        return [known[i] for i in used.tolist()], number[index], np.r_[0, np.cumsum(per_text)]

    def _states(self, words: list[str], index: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Segmentations one after the other, where each starts, its size, each occurrence's one, and how many candidates were skipped there."""
        ids, sizes, steps = self.segment_all(words, np.zeros(len(words), np.uint64) if self.below else None)
        parts, sizes = [ids], [sizes]
        state, skipped = index.copy(), np.zeros(len(index), np.int64)
        if self.below:
            short = np.fromiter(map(len, words), np.int64, len(words)) <= ROW
            live = np.flatnonzero(short[index])
            word, mask, begin = np.arange(len(words)), np.zeros(len(words), np.uint64), np.zeros(len(live), np.int64)
            over = [np.flatnonzero(~short[index])]
            while len(live):
                at, step = self._next_skip(keys[live], begin, steps[state[live]])
                live = live[at]
                far = step >= STEPS  # more candidates than a mask has bits
                over.append(live[far])
                live, step = live[~far], step[~far]
                made, mine = np.unique(state[live] * STEPS + step, return_inverse=True)
                old, bit = made // STEPS, np.uint64(1) << (made % STEPS).astype(np.uint64)
                state[live] = len(word) + mine
                skipped[live] += 1
                new_mask = mask[old] | bit
                got, size, came = self.segment_all([words[w] for w in word[old].tolist()], new_mask)
                word, mask, steps = np.r_[word, word[old]], np.r_[mask, new_mask], np.r_[steps, came]
                parts.append(got)
                sizes.append(size)
                begin = step + 1
            alone = np.concatenate(over)
            single = [self.segment(words[index[i]], int(keys[i])) for i in alone.tolist()]
            state[alone] = len(word) + np.arange(len(alone))
            skipped[alone] = [x[2] for x in single]
            parts += [np.array(x[0], np.uint16) for x in single]
            sizes.append(np.array([len(x[0]) for x in single], np.int64))
        size = np.concatenate(sizes)
        return np.concatenate(parts), np.cumsum(size) - size, size, state, skipped

    def _next_skip(self, keys: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which occurrences skip one of their candidates begin..end-1, and the first one they skip."""
        n = np.maximum(end - begin, 0)
        owner = np.repeat(np.arange(len(keys)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n - begin, n)
        hit = np.flatnonzero(self.skips(keys[owner], step))
        first = hit[np.r_[True, owner[hit][1:] != owner[hit][:-1]]] if len(hit) else hit
        return owner[first], step[first]

    def encode_group(self, texts: pa.Array, docs: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids (uint16) of a group of texts, the texts' edges in them, and the skipped candidates of each text."""
        words, index, bounds = self._occurrences(texts)
        number = np.arange(len(index)) - np.repeat(bounds[:-1], np.diff(bounds))
        ids, start, size, state, skipped = self._states(words, index, self.keys(docs, number, np.diff(bounds)))
        place, last = gather(start, size, state)
        ends, skips = np.r_[0, last], np.r_[0, np.cumsum(skipped)]
        return ids[place], ends[bounds].astype(np.int64), np.diff(skips[bounds])

    def encode(self, text: str, doc: int | None = None) -> list[int]:
        return self.encode_group(pa.array([text]), [doc])[0].tolist()

    def decode(self, ids) -> str:
        """The text; the space that stands for the leading mark is dropped."""
        return self.decode_bytes(np.asarray(ids, np.int64)).decode("utf-8", "surrogatepass")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        if not hasattr(self, "flat"):
            self.flat = np.frombuffer(b"".join(self.text), np.uint8)
            self.text_size = np.array([len(t) for t in self.text], np.int64)
            self.text_start = np.cumsum(self.text_size) - self.text_size
        return self.flat[gather(self.text_start, self.text_size, ids)[0]].tobytes()[1:]


@lru_cache(maxsize=2)
def shared_model(path: str, seed: int, rate: float) -> Model:
    """One model for each Python worker."""
    return Model(path, seed, rate)


def _encode(path: str, seed: int, rate: float):
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        m = shared_model(path, seed, rate)
        for group in groups(batches):
            ids, edges, skipped = m.encode_group(group.column(1), group.column(0).to_pylist())
            rows = []
            for doc, t, a, b, skip in zip(group.column(0).to_pylist(), group.column(1), edges[:-1].tolist(), edges[1:].tolist(), skipped.tolist(), strict=True):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                rows.append((doc, len(raw), b - a, skip, zlib.crc32(ids[a:b].astype("<u2").tobytes()), m.decode_bytes(ids[a:b]) == raw))
            cols = list(zip(*rows, strict=True))
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.bool_())], names=names)

    return run


def encode_documents(docs: DataFrame, path: str | None = None, seed: int = SEED, rate: float = RATE) -> DataFrame:
    """Encodes every whole text, decodes it again and compares."""
    return arrow(docs.select(F.col("doc_id").cast("long"), "text"), _encode(path or model_path(), seed, rate), SCHEMA)


def token_ids(docs: DataFrame, path: str | None = None, seed: int = SEED, rate: float = RATE) -> DataFrame:
    """doc_id and the ids themselves."""

    def run(batches):
        m = shared_model(path or model_path(), seed, rate)
        for group in groups(batches):
            yield pa.record_batch({"doc_id": group.column(0), "ids": pa.array([m.encode(t.as_py() or "", d) for d, t in zip(group.column(0).to_pylist(), group.column(1), strict=True)], pa.list_(pa.int32()))})

    return arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids array<int>")
