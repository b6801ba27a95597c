"""Plain versions of operators, written from their descriptions alone: no import from the operators but of fixed values."""

from collections import Counter, defaultdict

import numpy as np

SPACES = b" \t\n\x0b\x0c\r"
GEAR = np.random.default_rng(7).integers(0, 1 << 16, 256, dtype=np.uint16).tolist()


# ---- substring dedup

def some_least(hashes, fits, reach):
    """Of each `reach` in a row the least, those that fit being less than all others."""
    chosen = {i for i, f in enumerate(fits) if f}
    for i in range(len(hashes) - reach + 1):
        rank = [0 if fits[j] else hashes[j] for j in range(i, i + reach)]
        chosen |= {i + k for k, r in enumerate(rank) if r == min(rank)}
    return sorted(chosen)


def chunk_ends(raw):
    h, words, runs, run = 0, [], [], 0
    for i, c in enumerate(raw):
        h = (h << 1) + GEAR[c] & 0xFFFF
        if c in SPACES:
            if run:
                words.append((i + 1, h))
            run = 0
            continue
        run += 1
        if run > 32 and (i + 1 == len(raw) or raw[i + 1] & 0xC0 != 0x80):
            runs.append((i + 1, h))
    hashes = [x for _, x in words]
    ends = {words[i][0] for i in some_least(hashes, [x // 256 % 4 == 0 for x in hashes], 6)}
    hashes = [x for _, x in runs]
    last = group = None
    for i in some_least(hashes, [x // 256 % 16 == 0 for x in hashes], 32):
        if last is not None and hashes[i] == hashes[last] and i - last < 32:
            if (i - group) // 32 != (last - group) // 32:
                ends.add(runs[i][0])
        else:
            group = i
            ends.add(runs[i][0])
        last = i
    return sorted(ends | {len(raw)})


def pieces(raw):
    """(start, end) of the windows, in order, as bytes."""
    size, run = [0], 0
    for i, c in enumerate(raw):
        run = 0 if c in SPACES else run + 1
        size.append(size[-1] + 6 * (run == 1) + (run > 32))
    edges = [0, *chunk_ends(raw)]
    found = set()
    for i, a in enumerate(edges):
        after = next((j for j in range(i, len(edges)) if size[edges[j]] - size[a] >= 192), None)
        before = next((j for j in range(i, -1, -1) if size[a] - size[edges[j]] >= 192), None)
        if after is not None:
            found.add((i, after))
        if before is not None:
            found.add((before, i))
    return [(edges[a], edges[b]) for a, b in sorted(found)]


def cut_repeats(docs):
    """{(doc_id, text): text that stays} of the distinct (doc_id, text). Texts of one doc_id must not share passages."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: -(1 << 63) if x[0] is None else x[0]):
        if not t:
            out[d, t] = t
            continue
        raw = t.encode()
        gone = bytearray(len(raw))
        for a, b in pieces(raw):
            if raw[a:b] in seen:
                gone[a:b] = b"x" * (b - a)
            seen.add(raw[a:b])
        out[d, t] = bytes(c for c, g in zip(raw, gone, strict=True) if not g).decode()
    return out


# ---- quality rules

def words(t):
    out = [""]
    for c in t or "":
        if c in SPACES.decode():
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def quality(docs):
    """Whether each (doc_id, text, lang, source) is kept."""
    values, failed = [], []
    for _, t, _, _ in docs:
        w = words(t)
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        repeated = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        chars = sum(map(len, w))
        failed.append(len(w) < 10 or 100 * len(repeated) > 20 * len(w))
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        values.append((symbols * 10000 // chars if chars else 0, chars * 100 // len(w) if w else 0, (len(lines) - len(set(lines))) * 10000 // len(lines) if lines else 0))

    def low(v):
        while_bits = max(0, v.bit_length() - 7)
        return v >> while_bits << while_bits

    def fence(some):
        s = sorted(map(low, some))
        at = lambda p: next(x for i, x in enumerate(s, 1) if 100 * i >= p * len(s))
        a, b = at(25), at(75)
        return max(0, 64 * a - 96 * (b - a)), 64 * b + 96 * (b - a), len(s)

    groups = defaultdict(list)
    for (_, _, lang, source), v, f in zip(docs, values, failed, strict=True):
        if not f:
            for key in ((), (lang or "",), (lang or "", source or "")):
                groups[key].append(v)
    kept = []
    for (_, _, lang, source), v, f in zip(docs, values, failed, strict=True):
        votes = 0
        for m in range(3):
            if f:
                continue
            lo, hi, _ = fence([x[m] for x in groups[()]])
            for key in ((lang or "",), (lang or "", source or "")):
                a, b, n = fence([x[m] for x in groups[key]])
                lo, hi = (n * a + 50 * lo) // (n + 50), (n * b + 50 * hi) // (n + 50)
            votes += not lo <= 64 * v[m] <= hi
        kept.append(not f and votes < 2)
    return kept


# ---- merge-dropout

def merge(pre, score, skip):
    """Symbols of a pre-token; `skip(t)` says whether the t-th candidate that comes up is skipped."""
    sym, refused, t = [[c] for c in pre], set(), 0
    held = list(sym)  # so that no two symbols get one id
    while True:
        found = [(score[m], k) for k in range(len(sym) - 1) if (m := sym[k][0] + sym[k + 1][0]) in score and (id(sym[k]), id(sym[k + 1])) not in refused]
        if not found:
            return [s[0] for s in sym]
        k = min(found)[1]
        if skip(t):
            refused.add((id(sym[k]), id(sym[k + 1])))
        else:
            sym[k : k + 2] = [[sym[k][0] + sym[k + 1][0]]]
            held.append(sym[k])
        t += 1
