import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from kgsync.llm import common, components, simhash, substring_dedup

from . import brute
from .helpers import SCHEMA, edge_docs, edge_rows, empty_docs, text

SF = "/root/testdata/sf0.001"


# ---- SimHash

def fingerprint(t):
    w = (t or "").encode().lower().split()
    s = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    ones = [0] * 64
    for x in s:
        h = xxhash.xxh64_intdigest(x, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(s))


def join(pairs, n):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def brute_components(rows):
    """rows: (doc_id, fingerprint)"""
    ids = sorted({d for d, _ in rows if d is not None})
    fps = {}
    for d, f in rows:
        if d is not None:
            fps.setdefault(d, set()).add(f)
    pairs = [(i, j) for i in range(len(ids)) for j in range(i) if any((a ^ b).bit_count() <= 4 for a in fps[ids[i]] for b in fps[ids[j]])]
    return {d: ids[r] for d, r in zip(ids, join(pairs, len(ids)), strict=True)}


def test_near_duplicates(spark):
    base = text(50, 400)
    near = [(200 + i, base[: -3 - i] + " tail" * (i % 3), "en", "a") for i in range(12)]
    shared = [(7, base, "en", "a"), (7, text(61, 200), "en", "a"), (400, text(62, 200), "en", "a"), (400, text(61, 200) + " x", "en", "a"), (400, None, "en", "a")]
    docs = spark.createDataFrame(edge_rows() + near + shared, SCHEMA).union(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 1000", "text", "lang", "source"))
    rows = simhash.near_duplicates(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter((d, f"{fingerprint(t):016x}") for d, t in texts)
    want = brute_components([(d, fingerprint(t)) for d, t in texts])
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == want
    assert len(set(want.values())) < len(want)


def test_edges_of_simhash(spark):
    rows = simhash.near_duplicates(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[3].fingerprint == by[4].fingerprint == "0" * 16 and by[4].component_id == by[10].component_id == 3
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
    kept = simhash.keep_one(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[None] == 1 and max(n for d, n in ids.items() if d is not None) == 1 and 6 not in ids and 7 not in ids
    assert simhash.keep_one(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_slab_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = 400
    fp = rng.integers(0, 2**63, 6, dtype=np.uint64)[rng.integers(0, 6, n)]
    for _ in range(6):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) * (rng.random(n) < 0.6).astype(np.uint64)
    bucket, node = np.sort(rng.integers(0, 3, n)), rng.permutation(n)
    a, b = simhash.link_slab(bucket, fp, node)
    found = dict(zip(a.tolist(), b.tolist(), strict=True))
    roots = join([(i, j) for i in range(n) for j in range(i) if bucket[i] == bucket[j] and int(fp[i] ^ fp[j]).bit_count() <= 4], n)
    groups = {}
    for i, r in enumerate(roots):
        groups.setdefault(r, []).append(int(node[i]))
    mine = {}
    for v in node.tolist():
        mine.setdefault(found.get(v, v), []).append(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_hot_bucket_is_cut_without_loss(spark, monkeypatch):
    """One bucket over BUCKET nodes in every choice of blocks, cut into cells."""
    monkeypatch.setattr(simhash, "BUCKET", 40)
    rng = np.random.default_rng(3)
    fp = np.unique((0x1234 << 20) ^ (rng.integers(0, 1 << 9, 300) << 3)).astype(np.int64)
    nodes = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fp)], "node long, fp long")
    links = [(r.a, r.b) for r in simhash.links(nodes).collect()]
    want = join([(i, j) for i in range(len(fp)) for j in range(i) if (int(fp[i]) ^ int(fp[j])).bit_count() <= 4], len(fp))
    assert join(links, len(fp)) == want


def test_long_text_is_cut_between_words(monkeypatch):
    t = text(8, 500)
    whole = simhash.fingerprints_of([t, "a b", "", None])
    monkeypatch.setattr(simhash, "STEP_BYTES", 50)
    assert (simhash.fingerprints_of([t, "a b", "", None]) == whole).all()
    assert int(whole[0]) == fingerprint(t) and int(whole[1]) == fingerprint("a b")


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (3, 2)]
    rng = random.Random(1)
    names = list(range(200))
    rng.shuffle(names)
    df = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    for group in (range(61), range(100, 150)):
        members = [names[i] for i in group]
        assert {got.get(m, m) for m in members} == {min(members)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hubs_neighbours_are_dealt(spark):
    """No (node, salt) has more than its share of a hub's edges."""
    edges = spark.range(1, 5001).selectExpr("id as a", "0L as b").union(spark.range(1, 5001).selectExpr("0L as a", "id as b"))
    met = components._with_least(edges, 16)
    assert met.count() == 10_000 and met.where("a = 0 and m <> 1 or a > 0 and m <> 0").count() == 0
    assert {r.root for r in components.components(edges).collect()} == {0}


def test_more_nodes_ask_for_more_blocks():
    assert [simhash.blocks_for(n) for n in (0, 10**9, 10**10, 10**11, 10**15)] == [6, 6, 7, 8, 8]


# ---- substring dedup

def test_substring_dedup(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    passages = [words(60) for _ in range(40)]
    rows = [(i * 3 + j, words(rng.randint(20, 200)) + "\n" + p + "\n" + words(rng.randint(5, 60)), "en", "a") for i, p in enumerate(passages) for j in range(3)]
    clean = [(500 + i, words(150), "en", "a") for i in range(60)]
    df = spark.createDataFrame(rows + clean + [(1000 + (r[0] or 0), *r[1:]) for r in edge_rows()] + [(None, passages[0], "en", "a")], SCHEMA)
    got = [(r.doc_id, r.text) for r in substring_dedup.documents(df).select("doc_id", "text").collect()]
    given = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute.cut_repeats(set(given))
    assert Counter(got) == Counter((d, want[d, t]) for d, t in given)
    by = dict(got)
    assert all(by[d] == t for d, t, *_ in clean)
    assert all(p in by[3 * i] for i, p in enumerate(passages) if i)
    assert not [1 for i, p in enumerate(passages) for j in (1, 2) if p in by[3 * i + j]]


def test_edges_of_substring_dedup(spark):
    docs = edge_docs(spark)
    out = substring_dedup.documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert by[3] is None and by[4] == "" and by[6] == "" and len(by[5]) > 10_000 and 32 < len(by[9]) < 400
    assert substring_dedup.documents(empty_docs(spark)).count() == 0
    r = {x.doc_id: x for x in substring_dedup.report(docs).collect() if x.doc_id is not None}
    assert r[6].n_removed == r[6].n_bytes and r[5].n_removed == 0 and r[3].n_bytes == 0


def test_chunks_fall_into_step_after_an_insertion():
    t = text(3, 2000).encode()
    a, b = ({bytes(x[p:q]) for p, q in zip([0, *substring_dedup.cuts(x)], substring_dedup.cuts(x), strict=False)} for x in (t, b"some new words " + t))
    assert len(a - b) <= 2


HAN = [chr(0x4E00 + i) for i in range(2000)]
KINDS = {
    "words": lambda rng, n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n)),
    "han": lambda rng, n: "".join(rng.choices(HAN, k=2 * n)),
    "code": lambda rng, n: "".join(rng.choices("abcdef(){};=.0123", k=6 * n)),
    "one": lambda rng, n: rng.choice(HAN) * 2 * n,
    "period": lambda rng, n: "".join(rng.choices(HAN, k=7)) * (n // 3),
    "lines": lambda rng, n: "\n".join(["".join(rng.choices(HAN, k=40))] * (n // 8)),
}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_chunks_and_windows_are_the_described_ones(kind):
    rng = random.Random(kind)
    for n in (0, 1, 30, 200, 900):
        raw = KINDS[kind](rng, n).encode()
        raw = raw + b" some words after it " + raw[: len(raw) // 2].decode("utf-8", "ignore").encode()
        ends = substring_dedup.cuts(raw)
        assert ends.tolist() == brute.chunk_ends(raw)
        starts = np.r_[0, ends].tolist()
        assert [(starts[a], starts[b]) for a, b in zip(*substring_dedup.windows(raw, ends), strict=True)] == brute.pieces(raw)
        for a, b in zip(starts, starts[1:], strict=False):
            raw[a:b].decode()


def test_chunks_of_text_without_spaces_fall_into_step():
    t = KINDS["han"](random.Random(3), 2000)
    a, b = ({x[p:q] for p, q in zip([0, *substring_dedup.cuts(x)], substring_dedup.cuts(x), strict=False)} for x in (t.encode(), ("新字" + t).encode()))
    assert len(a) > 100 and len(a - b) <= 2


@pytest.mark.parametrize("kind", ["han", "code", "one", "period", "lines"])
def test_passages_without_spaces_go(spark, kind):
    """Three texts with one passage each of some 80 words' length: the first stays, most of it goes from the others, and nothing else."""
    rng = random.Random(kind)
    passages = [KINDS[kind](rng, 80) for _ in range(10)]
    around = lambda: KINDS["han" if kind != "code" else "code"](rng, rng.randint(30, 60))
    rows = [(3 * i + j, around() + p + around(), "zh", "a") for i, p in enumerate(passages) for j in range(3)]
    got = {r.doc_id: r for r in substring_dedup.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {d: r.text for d, r in got.items()} == {d: t for (d, _), t in brute.cut_repeats({r[:2] for r in rows}).items()}
    for i, p in enumerate(passages):
        size = len(p.encode())
        inside = kind in ("one", "period", "lines")  # repeats itself, so the first one goes in part, too
        assert inside or got[3 * i].n_removed == 0
        for r in (got[3 * i + 1], got[3 * i + 2]):
            assert 0.5 * size < r.n_removed <= size
            raw, at, kept = rows[r.doc_id][1].encode(), 0, b""
            for a, n in zip(r.starts, r.lengths, strict=True):
                kept, at = kept + raw[at:a], a + n
            assert (kept + raw[at:]).decode() == r.text and r.n_removed == sum(r.lengths)


def test_lanes_dealt_twice_give_the_same(spark, monkeypatch):
    rng = random.Random(9)
    passages = [KINDS["words"](rng, 60) for _ in range(6)]
    rows = [(i, KINDS["words"](rng, 80) + "\n" + rng.choice(passages) + "\n" + KINDS["words"](rng, 30), "en", "a") for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    places = lambda n: {(r.doc, r.key): sorted(r.places) for r in substring_dedup.repeated_places(docs, n).collect()}
    want = places(4096)
    assert want
    monkeypatch.setattr(common, "LANE_BYTES", 3000)
    monkeypatch.setattr(common, "PARTITION_BYTES", 9000)
    assert places(4096) == want and places(7) == want
