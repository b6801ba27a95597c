import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kgsync.llm import bpe_ids, media, merge_dropout, packing, quality_rules, token_counts, training_order

from . import brute
from .helpers import edge_docs, edge_rows, empty_docs, text

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def small(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# ---- token counts

def test_a_pre_token_is_counted_once(monkeypatch):
    """In a partition with several lanes and blocks, each distinct pre-token goes to the model once."""
    class Part:
        get = staticmethod(lambda: Part)
        partitionId = staticmethod(lambda: 0)  # noqa: N815

    monkeypatch.setattr(token_counts, "TaskContext", Part)
    monkeypatch.setattr(token_counts, "BLOCK_DOCS", 7)
    asked, count = [], token_counts._count
    monkeypatch.setattr(token_counts, "_count", lambda sp, words: asked.extend(words) or count(sp, words))
    texts = [text(i % 30, 50) for i in range(90)]
    posted = pa.Table.from_batches(token_counts._postings(5)([pa.record_batch({"doc_id": list(range(90)), "text": texts})])).sort_by("lane")
    counted = list(token_counts._lookups(token_counts.model_path())(posted.to_batches(max_chunksize=4)))
    assert len(asked) == len(set(asked)) == len({w for t in texts for w in t.split(" ")})
    got = pa.Table.from_batches(token_counts._totals(4096)(pa.Table.from_batches(counted).sort_by("block").to_batches()))
    sp = token_counts.model(token_counts.model_path())
    assert dict(zip(got["doc_id"].to_pylist(), got["n_tokens"].to_pylist(), strict=True)) == {i: len(sp.encode(t)) for i, t in enumerate(texts)}


def test_token_counts(spark):
    sp = token_counts.model(token_counts.model_path())
    for df in (small(spark), edge_docs(spark)):
        got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df).collect())
        want = Counter((r.doc_id, len((r.text or "").encode()), n := len(sp.encode(r.text or "")), n > 4096) for r in df.select("doc_id", "text").collect())
        assert got == want
    assert token_counts.token_counts(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("t", ["  a  b ", " ", "   ", "▁x ▁", "a\n b  ", "<s> x</s>  \x00", "", "a", " a", "a "])
def test_pretokens(t):
    sp = token_counts.model(token_counts.model_path())
    assert sum(token_counts._count(sp, [p.encode() for p in token_counts.pretokens(t)])) == len(sp.encode(t))


# ---- quality rules

def base(t):
    w = WORD.findall(t or "")
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    words = len(w)
    return words, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), words < 10 or 100 * len(covered) > 20 * words


def test_quality_base(spark):
    more = spark.createDataFrame([(100, "a b c d e a b c d e x y z", "en", "a"), (101, "a a a a a a a a a a a", "en", "a"), (102, text(5, 50) + " " + text(5, 7) + " end", "en", "a")], "doc_id long, text string, lang string, source string")
    df = edge_docs(spark).select("doc_id", "text", "lang", "source").union(more).union(small(spark).select("doc_id", "text", "lang", "source"))
    got = Counter(tuple(r)[:7] for r in quality_rules.quality(df).collect())
    assert got == Counter((r.doc_id, *base(r.text)) for r in df.collect())
    assert quality_rules.quality(empty_docs(spark)).count() == 0


def test_quality_sketch_buckets(spark):
    rows = spark.range(5000).select("id", quality_rules.bucket_low(F.col("id")).alias("low")).collect()
    for r in rows:
        assert r.low <= r.id and (r.low == r.id if r.id < 128 else r.id - r.low < r.id / 64)
        shift = max(0, int(math.log2(r.id)) - 6) if r.id else 0
        assert r.low == r.id >> shift << shift


def test_quality_filter_keeps_columns_and_clean_documents(spark):
    clean = [(i, text(i, 120), "en", "a") for i in range(300)]
    junk = [(1000 + i, " ".join(w + "###" for w in text(i, 120).split()), "en", "a") for i in range(20)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as q", "2 as f", "3 as q0")
    got = quality_rules.filter_documents(df)
    assert got.columns == df.columns
    assert {r.doc_id for r in got.collect()} == set(range(300))
    assert quality_rules.filter_documents(edge_docs(spark)).columns == edge_docs(spark).columns
    assert quality_rules.filter_documents(empty_docs(spark)).count() == 0


def test_verdict_against_brute_force(spark):
    rows = small(spark).select("doc_id", "text", "lang", "source").collect() + [r for r in edge_rows() if r[0] != 7]
    rows += [(5000 + i, text(i, 40) + " #" * (i % 4) + " longerword" * (i % 9), "en", f"s{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = Counter((r.doc_id, r.kept) for r in quality_rules.quality(df).collect())
    want = brute.quality(rows)
    assert got == Counter((r[0], k) for r, k in zip(rows, want, strict=True)) and len(set(want)) == 2


def test_fences_follow_the_data(spark):
    """No fence holds a number in a metric's unit: with all values times seven, every fence is seven times as far."""
    rows = [("en", f"s{g}", "symbols", v, 1 + (v * 7 + g) % 5) for g in range(4) for v in range(10 + g, 60 + 9 * g)]
    schema = "lang string, source string, metric string, low long, n long"
    one, seven = ({r.source: (r.symbols_lo, r.symbols_hi) for r in quality_rules.fences(spark.createDataFrame([(*r[:3], k * r[3], r[4]) for r in rows], schema)).collect()} for k in (1, 7))
    assert len(set(one.values())) == 4
    for g, (lo, hi) in one.items():
        assert abs(seven[g][0] - 7 * lo) <= 14 and abs(seven[g][1] - 7 * hi) <= 14


def test_values_on_a_fence_lie_inside(spark):
    """A document with a vote for its symbols, and mean word lengths on a fence and beside it."""
    names = [f"{m}_{e}" for m in quality_rules.METRICS for e in ("lo", "hi")]
    limits = spark.createDataFrame([("en", "a", 0, 0, 400 * 64, 500 * 64, 0, 0)], "lang string, source string, " + ", ".join(f"{n} long" for n in names))
    q = "select 'en' lang, 'a' source, struct(100L n_words, {}L word_chars, 1L n_symbols, 0L n_dup_lines, 0L n_repeat_words, 1L n_lines) q"
    rows = spark.sql(" union all ".join(q.format(n) for n in (399, 400, 500, 501)))
    assert {r.q.word_chars: r.kept for r in quality_rules.judge(rows, limits).collect()} == {399: False, 400: True, 500: True, 501: False}


# ---- token ids and packing

TRICKY = ["", " ", "  a  b ", "it's  'll \n\n 12 \t x", "<|endoftext|> x  <|endoftext|>y", "x\x1c y \x85 z 漢字", "a b c", " lead", "trail ", "two\n lines", None, "a <|endoftext|> b a"]


@pytest.mark.parametrize("ranks", [None, "yes"])
def test_ids_are_the_librarys(ranks):
    e = bpe_ids.Encoder(bpe_ids.tokenizer_path(), bpe_ids.ranks_path() if ranks else None)
    texts = TRICKY + [r[1] for r in edge_rows()]
    ids, edges = e.of(pa.array(texts, pa.string()))
    tok = bpe_ids.load(bpe_ids.tokenizer_path())
    for t, a, b in zip(texts, edges, edges[1:], strict=False):
        assert ids[a:b].tolist() == tok.encode(t or "", add_special_tokens=False).ids
    assert e.of(pa.array([], pa.string()))[1].tolist() == [0]


def test_another_split_rule_is_refused():
    bpe_ids.check_tokenizer(bpe_ids.load(bpe_ids.tokenizer_path()))
    for name in ("word_bpe_49k.json",):
        with pytest.raises(ValueError):
            bpe_ids.Encoder(bpe_ids.tokenizer_path(name))
    from tokenizers import Tokenizer, pre_tokenizers

    other = Tokenizer.from_str(bpe_ids.load(bpe_ids.tokenizer_path()).to_str())
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    with pytest.raises(ValueError):
        bpe_ids.check_tokenizer(other)


def check_pieces(rows, docs, length=2048):
    tok = bpe_ids.load(bpe_ids.tokenizer_path())
    want = Counter((d, tuple(np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))) for d, t in docs)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d in {d for d, _ in want}:
        whole = [np.array(ids, "<u4") for (k, ids), n in want.items() if k == d for _ in range(n)]
        pieces = by_doc[d]
        assert sum(p.length for p in pieces) == sum(map(len, whole))
        for p in pieces:
            assert any(len(w) == p.doc_tokens and zlib.crc32(w[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for w in whole)
        if len(whole) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    for s in by_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
    return by_seq


def test_packing(spark):
    for df in (small(spark), edge_docs(spark)):
        df = df.coalesce(1)
        rows = packing.pack(df).collect()
        seqs = check_pieces(rows, [(r.doc_id, r.text) for r in df.collect()])
        assert sum(sum(p.length for p in s) < 2048 for s in seqs.values()) <= 1
    assert packing.pack(empty_docs(spark)).count() == 0


def test_sum_of_squares_rule():
    """Each placement is one after which the squared counts have the least sum."""
    rng = np.random.default_rng(2)
    p, levels = packing.Packer(20, 4), Counter()
    for i, size in enumerate(rng.integers(1, 20, 500).tolist()):
        options = {}
        for h in [0, *(h for h, n in levels.items() if n)]:
            if h + size <= 20:
                after = levels.copy()
                if h:
                    after[h] -= 1
                if h + size < 20:
                    after[h + size] += 1
                options[h] = sum(n * n for n in after.values())
        done = p.place((i, 0, b"\0\0\0\0" * size, size))
        now = Counter({h: int(n) for h, n in enumerate(p.levels) if n})
        assert sum(n * n for n in now.values()) == min(options.values())
        assert done is None or sum(len(x[2]) for x in done) == 80
        levels = now


# ---- training order

@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000])
def test_permutation(n):
    p = training_order.Permutation(n, 7)
    f = p.forward(np.arange(n))
    assert sorted(f.tolist()) == list(range(n)) and (p.back(f) == np.arange(n)).all()
    if n == 1000:
        assert (f != training_order.Permutation(n, 8).forward(np.arange(n))).any() and abs(np.corrcoef(f, np.arange(n))[0, 1]) < 0.1


def test_materialise(spark, tmp_path):
    df = edge_docs(spark).select("doc_id", "text").coalesce(2)
    folder = str(tmp_path / "shards")
    rows = {r.slot: r for r in training_order.materialise(df, folder, length=64, per_shard=50).collect()}
    assert sorted(rows) == list(range(len(rows)))
    tok = bpe_ids.load(bpe_ids.tokenizer_path())
    stream = list(training_order.read_slots(folder, 0, len(rows)))
    assert training_order.manifest(folder)["sequences"] == len(rows) == len(stream)
    assert {x for slot, ids in stream for x in ids[rows[slot].n_tokens :]} == {training_order.PAD_ID}
    for slot, ids in stream:
        r = rows[slot]
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.shard == slot // 50 and r.byte_offset == slot % 50 * 128
    by_index = sorted(((rows[s].sequence_index, ids[: rows[s].n_tokens].tolist()) for s, ids in stream))
    got = Counter(x for _, ids in by_index for x in ids)
    want = Counter(x for r in df.collect() for x in [*tok.encode(r.text or "", add_special_tokens=False).ids, 50256])
    assert got == want
    assert [s for s, _ in training_order.read_slots(folder, 49, 53)] == [49, 50, 51, 52]
    again = str(tmp_path / "again")
    training_order.materialise(df, again, length=64, per_shard=50).limit(1).collect()  # whatever is asked of the result
    assert all((a == b).all() for (_, a), (_, b) in zip(stream, training_order.read_slots(again, 0, len(rows)), strict=True))
    empty = str(tmp_path / "empty")
    assert training_order.materialise(empty_docs(spark), empty).count() == 0 and training_order.manifest(empty)["sequences"] == 0
    assert list(training_order.read_slots(empty, 0, 10)) == []


def test_shards_that_are_not_whole_are_refused(tmp_path):
    with pytest.raises(FileNotFoundError):
        list(training_order.read_slots(str(tmp_path), 0, 1))
    write = training_order._write(str(tmp_path), 4, 3, 3)
    parcel = lambda *slots: pa.record_batch({"shard": pa.array([0], pa.int32()), "slot": [list(slots)], **{c: [[4] * len(slots)] for c in training_order.REPORT}, "ids": [pa.compress(b"\1\0" * 4 * len(slots), codec="zstd", asbytes=True)]})
    for given in ([parcel(0, 1)], [parcel(0, 1), parcel(1, 2)]):
        with pytest.raises(RuntimeError):
            list(write(given))
    assert len(list(write([parcel(2, 0), parcel(1)]))) == 1


# ---- media

def test_png_round_trip_and_damage():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (70, 64), dtype=np.uint8)
    data = media.encode_png(image)
    assert (media.decode_png(data) == image).all()
    for at in (3, 20, 40, len(data) // 2, len(data) - 6):
        with pytest.raises(media.PngError):
            media.decode_png(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    for n in (0, 8, 30, len(data) - 1):
        with pytest.raises(media.PngError):
            media.decode_png(data[:n])
    with pytest.raises(media.PngError):
        media.decode_png(data + b"x")


def test_bands_make_no_difference(monkeypatch):
    image = np.frombuffer(text(6, 4000).encode().ljust(32_000)[:32_000], np.uint8).reshape(-1, 64)
    whole = media.encode_png(image)
    monkeypatch.setattr(media, "BAND_BYTES", 640)
    assert media.encode_png(image) == whole and (media.decode_png(whole) == image).all()


def test_all_row_filters():
    rng = np.random.default_rng(5)
    image = rng.integers(0, 256, (60, 9), dtype=np.uint8)
    lines = np.zeros((60, 10), np.uint8)
    for i in range(60):
        k = int(rng.integers(0, 5))
        a = np.r_[0, image[i, :-1]].astype(int)
        b = (image[i - 1] if i else np.zeros(9)).astype(int)
        c = np.r_[0, b[:-1]]
        p = a + b - c
        near = np.where((abs(p - a) <= abs(p - b)) & (abs(p - a) <= abs(p - c)), a, np.where(abs(p - b) <= abs(p - c), b, c))
        lines[i, 0] = k
        lines[i, 1:] = (image[i] - [0, a, b, (a + b) // 2, near][k]) & 255
    assert (media.unfilter(lines) == image).all()


def test_dct_hash_is_perceptual():
    rng = np.random.default_rng(0)
    k = np.arange(8)
    y, x = (np.cos(np.pi * (2 * np.arange(n)[:, None] + 1) * k / (2 * n)) for n in (200, 64))
    smooth = lambda: np.clip(128 + 12 * y @ rng.normal(size=(8, 8)) @ x.T, 0, 255)
    image, other = smooth(), smooth()
    noisy = np.clip(image + rng.integers(-6, 7, image.shape), 0, 255)
    h = [media.dct_hash(i.astype(np.uint8)) for i in (image, noisy, other)]
    assert (h[0] ^ h[1]).bit_count() <= 8 < 16 < (h[0] ^ h[2]).bit_count()


def test_media_digests(spark):
    import hashlib

    for df in (small(spark), edge_docs(spark)):
        texts = df.select("doc_id", "text").collect()
        got = Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in media.media_digests(df).collect())
        want = Counter()
        for d, t in texts:
            raw = (t or "").encode()
            full = raw + b"\0" * (-len(raw) % 64 if raw else 64)
            want[d, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:])] += 1
        assert got == want
    stored = {r.doc_id: r for r in media.media_columns(edge_docs(spark).where("doc_id = 11")).collect()}
    assert media.decode_png(bytes(stored[11].media)).tobytes().rstrip(b"\0").decode() == [r[1] for r in edge_rows() if r[0] == 11][0]
    assert media.media_digests(empty_docs(spark)).count() == 0


# ---- merge dropout

def test_rate_zero_is_the_library():
    sp, m = token_counts.model(token_counts.model_path()), merge_dropout.Model(merge_dropout.model_path(), rate=0.0)
    for t in [*(t for t in TRICKY if t), *(r[1] for r in edge_rows() if r[1])]:
        assert m.encode(t) == sp.encode(t)


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
def test_dropout_against_brute_force(rate):
    """Every occurrence by a plain agenda of its own, with the same draws."""
    m = merge_dropout.Model(merge_dropout.model_path(), 5, rate)
    for doc, t in enumerate([*(t for t in TRICKY if t), *(r[1][:9000] for r in edge_rows() if r[1]), "a▁b ▁ c", "x" * 200]):
        pre = re.findall("▁+[^▁]*", "▁" + t.replace("▁", merge_dropout.LITERAL).replace(" ", "▁"))
        want = []
        keys = m.keys([doc], np.arange(len(pre)), np.array([len(pre)]))
        for p, key in zip(pre, keys, strict=True):
            draws = m.skips(key, np.arange(3 * len(p) + 1)).tolist()
            symbols = brute.merge(p, m.score, draws.__getitem__)
            want += [i for s in symbols for i in ([m.ids[s]] if s in m.ids else [m.byte[c] for c in s.replace(merge_dropout.LITERAL, "▁").encode()])]
        ids = m.encode(t, doc)
        assert ids == want
        assert m.decode(ids) == t


def test_a_word_varies_within_a_text_and_between_texts():
    m = merge_dropout.Model(merge_dropout.model_path(), 1, 0.3)
    pieces = lambda t, d: Counter(tuple(m.encode_group(pa.array([t]), [d])[0].tolist()) for _ in range(1))
    alone = {tuple(m.encode("wonderful", d)) for d in range(40)}
    assert len(alone) > 4 and {m.decode(x) for x in alone} == {"wonderful"}
    ids, n = m.encode(" ".join(["wonderful"] * 40), 7), m.encode("wonderful", 7)
    starts = [i for i, x in enumerate(ids) if m.pieces[x].startswith("▁")]
    forms = {tuple(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)}
    assert len(forms) > 4 and ids[: len(n)] == n
    assert pieces("wonderful words", 3) == pieces("wonderful words", 3)


def test_rate_is_the_share_of_skipped_candidates():
    m = merge_dropout.Model(merge_dropout.model_path(), 3, 0.1)
    words = text(77, 20_000)
    skipped = int(m.encode_group(pa.array([words]), [1])[2][0])
    merges = len(words.replace(" ", "")) + words.count(" ") + 1 - len(m.encode(words, 1))  # one for each symbol less
    assert 0.09 < skipped / (skipped + merges) < 0.11


def test_seeds_vary():
    t = text(4, 300)
    a, b = (merge_dropout.Model(merge_dropout.model_path(), s, 0.3).encode(t) for s in (1, 2))
    assert a != b and a == merge_dropout.Model(merge_dropout.model_path(), 1, 0.3).encode(t)


def test_encode_documents(spark):
    for df in (small(spark), edge_docs(spark)):
        rows = merge_dropout.encode_documents(df).collect()
        assert len(rows) == df.count() and all(r.lossless for r in rows)
    marked = merge_dropout.encode_documents(edge_docs(spark), rate=0.0).where("not lossless").collect()
    assert [r.doc_id for r in marked] == [11]
    assert merge_dropout.encode_documents(empty_docs(spark)).count() == 0
    ids = merge_dropout.token_ids(edge_docs(spark).where("doc_id = 1")).first().ids
    assert merge_dropout.Model(merge_dropout.model_path()).decode(ids) == edge_rows()[0][1]
