import html
import re
import sys
import time
import zlib
from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest

from kgsync.llm import bpe_ids, html_extract, html_tree, queries, simhash, url_filters

from . import brute
from .helpers import edge_docs, empty_docs
from .test_dedup_operators import brute_components, fingerprint

SF = "/root/testdata/sf0.001"


# ---- HTML extraction

@pytest.fixture(scope="module")
def model():
    return html_extract.train()


def article(page):
    body = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(b for b in blocks if b)


def test_pages_of_the_table(spark, model):
    rows = html_extract.main_text(spark.read.parquet(f"{SF}/pages.parquet"), model).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id]) and r.n_chars == len(r.text)


def test_held_out_accuracy(model):
    maker, right, total = html_tree.Maker(4242), 0, 0
    for _ in range(150):
        nodes, _ = html_tree.parse(maker.page())
        y, keep = html_extract.labels(nodes), html_extract.decode(nodes, model.predict(html_extract.features(nodes)))
        own = np.array([n.own > 0 for n in nodes])
        right, total = right + (y == keep)[own].sum(), total + own.sum()
    assert right / total > 0.98


def test_decoding_has_no_contradiction(model):
    maker = html_tree.Maker(7)
    rng = np.random.default_rng(0)
    for _ in range(20):
        nodes, _ = html_tree.parse(maker.page())
        keep = html_extract.decode(nodes, rng.normal(0, 3, len(nodes)))
        assert not [n for n in nodes[1:] if keep[n.number] and not keep[n.parent.number]]


PAGE = (
    "<html><head><title>T</title><script>if (a < b) { '</p>' }</script></head><body><div class='cookie-notice'><p>We use cookies, do you agree?</p><button>OK</button></div>"
    "<header class=site-header><h1>Site name</h1><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav></header><div class=wrapper><main><article>"
    "<h1>A&nbsp;title &amp; more</h1><p>First <b>bold</b>\n  words, of a paragraph that is long enough to be read.<br>Second line &#233;.</p><div class='ad-slot'>Buy now!</div>"
    "<p>Another paragraph, with a <a href=/x>link</a> in it and some more words to read.</p><ul><li>item one</li><li>item two</li></ul></article></main>"
    "<aside class=sidebar><h3>Related</h3><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul></aside><section id=comments><h2>Comments</h2><div class=comment><p>I do not agree with this at all, sorry.</p></div></section></div>"
    "<form class=newsletter><label>Mail</label><input name=m></form><footer>&copy; 2024 Site</footer></body></html>"
)


def test_a_page_with_everything(model):
    assert html_extract.extract([PAGE], model) == ["A title & more\n\nFirst bold words, of a paragraph that is long enough to be read. Second line é.\n\nAnother paragraph, with a link in it and some more words to read.\n\nitem one\n\nitem two"]


@pytest.mark.parametrize("page", ["", "<", "<p", "<p>a<p", "x</b></p></div>y", "<!-- a", "<script>x", '<div class="a>b', "plain", "<table><tr><td>1<td>2<tr><td>3</table>", "<a" * 500, "<div>" * 3000 + "deep", "</p>" * 100])
def test_damaged_pages(page, model):
    assert len(html_extract.extract([page], model)) == 1


LONG = "a paragraph that is long enough to be taken for the text of an article, with a few more words in it."


@pytest.mark.parametrize("inner", ["<math><mi>x</mi><mo>=</mo></math>", "<svg><text>x =</text></svg>", "<noscript>x =</noscript>", "<object data=f>x =</object>", "<svg>x =", "<object>x =", "<template>gone</template>x =", "<iframe>x =", "<textarea>x =", "<xmp>x =</xmp>"])
def test_nothing_else_is_dropped(inner, model):
    page = f"<body><article><h1>A title</h1><p>One: {LONG}</p><p>{inner} two, {LONG}</p><p>Three, {LONG}</p></article></body>"
    text = html_extract.extract([page], model)[0].split("\n\n")
    assert text[:2] == ["A title", f"One: {LONG}"] and text[3] == f"Three, {LONG}"
    assert re.sub(" ", "", text[2]) == re.sub(" ", "", f"x= two, {LONG}")


def test_many_siblings_make_no_switch(model):
    for n in (2, 199, 200, 201, 1000):
        nodes, _ = html_tree.parse("<div>" + "<p>x</p><h2>y</h2>" * (n // 2) + "</div>")
        assert {float(v) for v in html_extract.features(nodes)[2:, 2 * len(html_extract.TAGS) + 2 * len(html_extract.KINDS) + 13]} == {0.5}


HOSTILE = ["<b>{n}</i>", "<div>{n}</article>", "<i><div>{o}<b>{n}</i>", "<b>{n}<p></p>", "<li><ul>{o}<div>{n}<li></li>", "<title>{n}", "<svg>{n}", "<a \"'>{n}", "<div class='{n}", "<!--{n}"]


@pytest.mark.parametrize("shape", HOSTILE)
def test_time_is_in_proportion_to_the_page(shape):
    """Tags read, counted by the work they make: elements pushed and dropped, never looked through."""
    def cost(n):
        once, _, rest = shape.rpartition("{o}")
        parts = rest.split("{n}")
        page, steps = once + "".join(p * n for p in parts), [0]
        count = lambda *_: steps.__setitem__(0, steps[0] + 1)
        sys.setprofile(count)
        try:
            html_tree.parse(page)
        finally:
            sys.setprofile(None)
        return steps[0] + 1

    assert cost(4000) <= 4.5 * cost(1000)
    began = time.process_time()
    html_tree.parse("".join(p * 60_000 for p in shape.replace("{o}", "").split("{n}")))
    assert time.process_time() - began < 10


def test_edges_of_pages(spark, model):
    df = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE)], "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    rows = html_extract.main_text(df, model).collect()
    assert Counter((r.page_id, r.url, r.n_chars > 0) for r in rows) == Counter({(1, None, False): 1, (None, "u", False): 1, (2, "u", True): 2})
    assert html_extract.main_text(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0


# ---- URL filters

DAY = date(2024, 1, 1)
ENTRIES = [
    ("domain", "bad.org", "block", 10), ("host", "ok.bad.org", "allow", 20), ("host", "ok.bad.org", "remove", 40), ("prefix", "a.com/x", "block", 0), ("url", "a.com/x/y", "allow", 5),
    ("host", "b.com", "block", 10), ("host", "b.com", "remove", 20), ("host", "b.com", "block", 30), ("host", "tie.com", "allow", 10), ("host", "tie.com", "block", 10), ("host", None, "block", 1),
    ("host", "q.com", "block", 0), ("url", "q.com/x?id=1", "allow", 5), ("url", "q.com/x?id=2", "block", 5), ("host", "[::1]", "block", 5), ("domain", "com", "block", 35),
]


def brute_verdict(url, day):
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)[^/?#]*([^?#]*)(\?[^#]*)?", url or "")
    if not m or day is None or not m[1]:
        return True
    host, path = m[1].lower(), m[2].rstrip("/")
    labels, parts = host.split("."), path.split("/")
    names = [("url", host + path), ("url", host + path + (m[3] or "")), ("host", host), *(("domain", ".".join(labels[i:])) for i in range(len(labels))), *(("prefix", host + "/".join(parts[: i + 1])) for i in range(len(parts)))]
    best = None
    for scope, pattern in names:
        past = [(d, {"remove": 0, "allow": 1, "block": 2}[a], a) for s, p, a, d in ENTRIES if (s, p) == (scope, pattern) and d <= day]
        if past and max(past)[2] != "remove":
            key = ({"domain": 1, "host": 2, "prefix": 3, "url": 4}[scope], len(pattern))
            best = max(best or (key, ""), (key, max(past)[2]))
    return not best or best[1] != "block"


def test_url_filters(spark, tmp_path):
    urls = ["http://bad.org/", "https://www.bad.org/a", "http://OK.bad.org/z?q", "http://a.com/x", "http://a.com/x/y/", "http://a.com/x/y/z", "http://a.com/xx", "ftp://u@b.com:21/f", "http://tie.com", "http://notbad.org", "nonsense", "", None]
    urls += ["http://q.com/x?id=1", "http://q.com/x/?id=1#f", "http://q.com/x?id=2", "http://q.com/x", "http://[::1]:80/a", "http://[::1", "http://a.com/x" + "/y" * 2000, "http://a.com/x?" + "q" * 50_000]
    rows = [(i, u, DAY + timedelta(d) if d is not None else None) for i, u in enumerate(urls) for d in (0, 5, 10, 15, 20, 25, 30, 40, 100, None)]
    captures = spark.createDataFrame(rows + rows[:3], "page_id int, url string, fetched date").selectExpr("*", "1 as Scope", "'x' as kept", "2 as entry", "3 as row", "4 as pattern", "5 as listed", "6 as bucket", "7 as salt", "8 as j1")
    entries = spark.createDataFrame([(s, p, a, DAY + timedelta(d)) for s, p, a, d in ENTRIES], "scope string, pattern string, action string, listed date")
    got = url_filters.judge(captures, entries)
    assert got.columns == ["page_id", "url", "fetched", "entry", "row", "bucket", "salt", "j1", *url_filters.RESULT]
    got.write.parquet(str(tmp_path / "judged"))
    want = Counter((i, u, d, brute_verdict(u, (d - DAY).days if d else None)) for i, u, d in rows + rows[:3])
    assert Counter((r.page_id, r.url, r.fetched, r.kept) for r in got.collect()) == want
    assert url_filters.judge(captures, entries.limit(0)).where("kept").count() == captures.count()
    assert url_filters.judge(captures.limit(0), entries).count() == 0


# ---- the pipeline

def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    kept = [r for r, k in zip(docs, brute.quality(docs), strict=True) if k]
    assert 0 < len(kept) < len(docs)
    comp = brute_components([(r.doc_id, fingerprint(r.text)) for r in kept])
    one = [(r.doc_id, r.text) for r in kept if comp[r.doc_id] == r.doc_id]
    cut = brute.cut_repeats(one)
    assert sum(len(t) for _, t in one) > sum(map(len, cut.values()))
    tok = bpe_ids.load(bpe_ids.tokenizer_path())
    want = {d: np.array(tok.encode(cut[d, t] or "", add_special_tokens=False).ids + [1], "<u4") for d, t in one}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(want)
    assert Counter(r.doc_id for r in rows for _ in range(r.length)) == Counter({d: len(x) for d, x in want.items()})
    assert all(zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)


def test_stages_keep_the_columns(spark):
    import corpus_pipeline

    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.dtypes == docs.dtypes, name


def test_queries_are_registered():
    names = [n for n in queries.queries() if re.match(r"op\d+_", n)]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 11))
    assert set(queries.oracle_sql()) <= set(names)


def test_simhash_keeps_one_of_each(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    comp = brute_components([(r.doc_id, fingerprint(r.text)) for r in docs.collect()])
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == set(comp.values())
