"""Main text of web pages: boosted trees over features of DOM nodes, and hierarchical decoding.

The model says of each block node whether its subtree holds main text. It is trained when first used, in
some ten seconds on the driver, on TRAIN_PAGES generated pages of many layouts (`html_tree.Maker`), whose main text is
known; nothing of it comes from the tables. Scores of nodes alone can contradict each other; the decoder
picks the best labelling of the whole tree in which no node below a rejected one is accepted. The text
blocks of accepted nodes, white space normalised, are the text.

Pages are independent: nothing is shuffled, memory is bounded by an Arrow batch and a group of pages. Null, empty and damaged
html give what can be read, or the empty text. Null page_id or url and repeated rows are kept; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow
from .html_tree import Maker, Node, parse
from .packing import groups

TRAIN_PAGES, SEED = 2500, 11
TREES, DEPTH, BINS, RATE = 80, 5, 32, 0.25
#: The splits of a tree are sought in one of so many nodes, drawn anew for each tree; its leaves are fitted to all.
DRAWN = 4
SCHEMA = "page_id long, url string, text string, n_chars long"

TAGS = ["nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "li", "ul", "table", "figure", "blockquote", "body", "button", "h1", "h"]
_ALIKE = {
    "ul": "ol dl",
    "nav": "menu",
    "li": "dt dd",
    "table": "td th tr tbody thead",
    "button": "label select option",
    "form": "fieldset",
    "aside": "dialog",
    "body": "html",
    "p": "pre",
    "h": "h2 h3 h4 h5 h6",
}
_GROUP = {t: group for group, tags in _ALIKE.items() for t in tags.split()}
#: Attribute tokens that speak for one kind of content, by kind.
TOKENS = {
    "nav": "nav navbar navigation menu topnav breadcrumb breadcrumbs pager pagination toc skip",
    "header": "header masthead top topbar branding logo banner",
    "footer": "footer bottom copyright colophon credits legal",
    "side": "sidebar side aside widget widgets related rail recommended popular trending complementary more",
    "notice": "cookie cookies notice consent gdpr alert message privacy popup modal overlay dialog warning toast",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adbox adslot banner dfp teaser outbrain taboola",
    "form": "form search login newsletter subscribe subscription signup register contact",
    "comments": "comment comments replies reply responses response discussion disqus reader respond feedback",
    "share": "share sharing social tools tags follow meta print",
    "main": "content article post entry story main text body articlebody",
    "hidden": "hidden none",
}
_KIND = {t: k for k, ts in TOKENS.items() for t in ts.split()}
KINDS = list(TOKENS)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
N_FEATURES = 2 * len(TAGS) + 2 * len(KINDS) + 20


def _kinds(node: Node) -> set[int]:
    if not node.attrs:
        return set()
    text = " ".join(v for k, v in node.attrs.items() if k in ("class", "id", "role", "aria-label", "itemprop"))
    out = {KINDS.index(_KIND[t]) for t in _SPLIT.split(_CAMEL.sub(" ", text).lower()) if t in _KIND}
    style = node.attrs.get("style", "").replace(" ", "")
    if "hidden" in node.attrs or "display:none" in style or node.attrs.get("aria-hidden") == "true":
        out.add(KINDS.index("hidden"))
    return out


def features(nodes: list[Node]) -> np.ndarray:
    """One row for each node: tag, attribute tokens, both of the ancestors, subtree density, depth, place, siblings."""
    out = np.zeros((len(nodes), N_FEATURES), np.float32)
    total = max(1, nodes[0].chars)
    above_tags: list[set[int]] = [set()] * len(nodes)
    above_kinds: list[set[int]] = [set()] * len(nodes)
    start, alike = np.zeros(len(nodes)), np.ones(len(nodes))
    a, b, c, d = len(TAGS), 2 * len(TAGS), 2 * len(TAGS) + len(KINDS), 2 * len(TAGS) + 2 * len(KINDS)
    own_kinds = [_kinds(n) for n in nodes]
    own_tag = [TAGS.index(g) if (g := _GROUP.get(n.tag, n.tag)) in TAGS else -1 for n in nodes]
    for i, n in enumerate(nodes):
        row = out[i]
        if own_tag[i] >= 0:
            row[own_tag[i]] = 1
        for k in own_kinds[i]:
            row[b + k] = 1
        p = n.parent
        siblings, prev, following = 1, 0, 0
        if p:
            j = p.number
            above_tags[i] = above_tags[j] | {own_tag[j]} if own_tag[j] >= 0 else above_tags[j]
            above_kinds[i] = above_kinds[j] | own_kinds[j]
            for k in above_tags[i]:
                row[a + k] = 1
            for k in above_kinds[i]:
                row[c + k] = 1
            siblings = len(p.children)
        n_children = len(n.children)
        row[d : d + 14] = (
            n.depth,
            np.log1p(n.chars),
            np.log1p(n.own),
            n.link_chars / max(1, n.chars),
            n.marks / max(1, n.words),
            n.controls,
            n_children,
            n.chars / (n_children + 1),
            n.chars / total,
            n.chars / max(1, p.chars) if p else 1,
            siblings,
            n.words,
            n.chars / max(1, n.words),
            alike[i],
        )
        at = start[i]
        row[d + 14] = at / total
        row[d + 15] = (at + n.chars) / total
        tags = Counter(x.tag for x in n.children)
        for x in n.children:
            alike[x.number] = tags[x.tag] / n_children
            start[x.number] = at
            at += x.chars
            out[x.number, d + 16] = np.log1p(prev)
            prev = x.chars
        for x in reversed(n.children):
            out[x.number, d + 17] = np.log1p(following)
            following = x.chars
        row[d + 18] = max((x.chars for x in n.children), default=0) / max(1, n.chars)
        row[d + 19] = sum(x.tag == "p" for x in n.children)
    return out


class Boosted:
    """Gradient-boosted regression trees for the logistic loss, on binned features, by stochastic gradients."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, f = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)
        flat = binned + np.arange(f) * BINS
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        score = np.full(n, self.base)
        inner, rng = (1 << DEPTH) - 1, np.random.default_rng(SEED)
        self.feature = np.zeros((TREES, inner), np.int32)
        self.cut = np.full((TREES, inner), np.inf, np.float32)
        self.leaf = np.zeros((TREES, 1 << DEPTH), np.float32)
        for t in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            at, some = np.zeros(n, np.int64), rng.choice(n, -(-n // DRAWN), replace=False)
            held = np.stack([g[some], h[some]])
            sums = self._sums(flat[some], held, np.zeros(len(some), np.int64), 1, f)
            for level in range(DEPTH):
                width = 1 << level
                if level:  # of two siblings the smaller one is summed up, the other is what is left of their parent
                    side, parent = at[some] & 1, at[some] >> 1
                    right = np.bincount(parent, side, width // 2) * 2 < np.bincount(parent, minlength=width // 2)
                    less = np.flatnonzero(side == right[parent])
                    small = self._sums(flat[some[less]], held[:, less], parent[less], width // 2, f)
                    both = np.stack([small, sums - small], axis=2)  # the smaller one, the other
                    both[:, right] = both[:, right][:, :, ::-1]
                    sums = both.reshape(2, width, f, BINS)
                gs, hs = sums.cumsum(axis=3)
                g_all, h_all = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + 1) + (g_all - gs) ** 2 / (h_all - hs + 1) - g_all**2 / (h_all + 1)
                gain[(hs < 1) | (h_all - hs < 1)] = 0
                best = gain.reshape(width, -1).argmax(axis=1)
                go = np.zeros(n, bool)
                for k in range(width):
                    j, bin_ = divmod(int(best[k]), BINS)
                    if gain[k, j, bin_] <= 1e-6 or bin_ >= len(self.edges[j]):
                        continue
                    self.feature[t, width - 1 + k], self.cut[t, width - 1 + k] = j, self.edges[j][bin_]
                    mine = at == k
                    go[mine] = binned[mine, j] > bin_
                at = 2 * at + go
            gl, hl = np.bincount(at, g, 1 << DEPTH), np.bincount(at, h, 1 << DEPTH)
            self.leaf[t] = RATE * gl / (hl + 1)
            score += self.leaf[t][at]
        return self

    @staticmethod
    def _sums(flat: np.ndarray, held: np.ndarray, slot: np.ndarray, slots: int, f: int) -> np.ndarray:
        """Sums of both rows of `held` by slot, feature and bin."""
        place = (slot[:, None] * (f * BINS) + flat).ravel()
        return np.stack([np.bincount(place, np.repeat(x, f), slots * f * BINS) for x in held]).reshape(2, slots, f, BINS)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - (len(cut))]
        return out


def labels(nodes: list[Node]) -> np.ndarray:
    y = np.array(["data-y" in n.attrs for n in nodes])
    for n in reversed(nodes):
        if n.parent and y[n.number]:
            y[n.parent.number] = True
    return y


@lru_cache(maxsize=4)
def train(pages: int = TRAIN_PAGES, seed: int = SEED) -> Boosted:
    maker, xs, ys = Maker(seed), [], []
    for _ in range(pages):
        nodes, _ = parse(maker.page())
        xs.append(features(nodes))
        ys.append(labels(nodes))
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Accepted nodes of the best labelling in which nothing below a rejected node is accepted."""
    s = np.clip(odds, -6, 6)
    rejected = -s.copy()  # value of the subtree if its node is rejected
    accepted = s.copy()
    for n in reversed(nodes[1:]):
        i, p = n.number, n.parent.number
        rejected[p] += rejected[i]
        accepted[p] += max(rejected[i], accepted[i])
    keep = np.zeros(len(nodes), bool)
    keep[0] = True
    for n in nodes[1:]:
        i = n.number
        keep[i] = keep[n.parent.number] and accepted[i] >= rejected[i]
    return keep


def extract(pages: list[str | None], model: Boosted) -> list[str]:
    parsed = [parse(p or "") for p in pages]
    odds = model.predict(np.concatenate([features(nodes) for nodes, _ in parsed])) if parsed else []
    out, at = [], 0
    for nodes, texts in parsed:
        keep = decode(nodes, odds[at : at + len(nodes)])
        at += len(nodes)
        out.append("\n\n".join(t for n, t in texts if keep[n.number]))
    return out


def _extract(model: Boosted):
    def run(batches):
        for part in groups(batches):
            texts = extract(part.column(1).to_pylist(), model)
            yield pa.record_batch({"page_id": part.column(0), "url": part.column(2), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return run


def main_text(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return arrow(pages.select(F.col("page_id").cast("long"), "html", "url"), _extract(model or train()), SCHEMA)
