"""A tolerant reader of HTML into block nodes, and pages with known main text to learn from.

Never fails: damaged, truncated and empty pages give what can be read, in time proportional to their size:
no tag looks through the elements that are open, as the places of each name in the stack are known.
Elements that are neither blocks nor RAW (formulas, drawings, objects, noscript among them) are inline:
their text belongs to the block around them.
"""

from __future__ import annotations

import random
import re
from html import unescape

# Element names of HTML by how their content is treated.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What stands in these is no text of the page. Without a closing tag scripts and styles reach to the page's end; of the others only the opening tag counts.
RAW = frozenset("script style iframe noembed noframes template textarea title".split())
TO_THE_END = frozenset(("script", "style"))
#: An opening tag ends an open one of these, up to the given container.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
NOT_IN_P = BLOCKS - {"button", "label", "option", "select", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "legend"}

_NOT_A_TAG = r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
_TOKEN = re.compile(_NOT_A_TAG + r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
#: For a tag whose quotes never close, and what follows it: tags end at the next ">".
_LOOSE = re.compile(_NOT_A_TAG + r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)", re.S)
_BEGIN = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style|aria-label|itemprop|data-y)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+))?", re.I)


class Node:
    __slots__ = ("attrs", "chars", "children", "controls", "depth", "first", "last", "link_chars", "marks", "number", "own", "parent", "tag", "words")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []
        self.own = self.chars = self.link_chars = self.marks = self.controls = self.words = 0
        self.number = self.first = self.last = 0
        if parent:
            parent.children.append(self)


class _Reader:
    """The elements that are open, as (name, block): inline ones stand with the block around them."""

    def __init__(self):
        root = Node("#root", {}, None)
        self.nodes, self.texts = [root], []
        self.stack: list[tuple[str, Node]] = [("#root", root)]
        self.open: dict[str, list[int]] = {}  # places in the stack by name, the last one on top
        self.block_at = [0]  # places of blocks in the stack
        self.buffer: list[str] = []
        self.links = self.link_chars = 0  # open links, characters of links in the buffer

    def flush(self) -> None:
        node = self.stack[-1][1]
        text = " ".join("".join(self.buffer).split())
        self.buffer.clear()
        if text:
            self.texts.append((node, text))
            node.own += len(text)
            node.link_chars += min(self.link_chars, len(text))
            node.marks += sum(map(text.count, ".,;:!?"))
            node.words += text.count(" ") + 1
        self.link_chars = 0

    def add(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self.buffer.append(text)
            if self.links and not text.isspace():
                self.link_chars += len(text)

    def top(self, *names: str) -> int:
        """The topmost place of an open element of one of these names; -1 if there is none."""
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=-1)

    def push(self, name: str, node: Node) -> None:
        self.open.setdefault(name, []).append(len(self.stack))
        if node is not self.stack[-1][1]:
            self.block_at.append(len(self.stack))
        self.stack.append((name, node))
        self.links += name == "a"

    def drop(self, at: int) -> None:
        """Take the stack down to and with place `at`."""
        while len(self.stack) > at:
            name, _ = self.stack.pop()
            self.open[name].pop()
            self.links -= name == "a"
        while self.block_at[-1] >= at:
            self.block_at.pop()

    def close(self, at: int) -> None:
        self.flush()
        self.drop(at)

    def end_tag(self, name: str) -> None:
        at = self.top(name)
        if at > 0 and name in BLOCKS:
            self.close(at)
        elif at > self.block_at[-1]:  # inline elements end in their block
            self.drop(at)

    def block(self, name: str, attr_text: str) -> None:
        self.flush()
        if name in NOT_IN_P and self.stack[self.block_at[-1]][0] == "p":
            self.close(self.block_at[-1])
        if name in CLOSES:
            ends, stops = CLOSES[name]
            if (at := self.top(*ends)) > self.top(*stops):
                self.close(at)
        attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attr_text)} if attr_text else {}
        node = Node(name, attrs, self.stack[-1][1])
        node.number = len(self.nodes)
        self.nodes.append(node)
        node.first = len(self.texts)
        node.controls += name in ("button", "select", "option", "label")
        self.push(name, node)

    def void(self, name: str) -> None:
        if name == "hr":
            self.flush()
        elif name == "br":
            self.buffer.append(" ")
        elif name == "input":
            self.stack[-1][1].controls += 1

    def finish(self) -> None:
        """Sums over subtrees."""
        self.close(1)
        for node in reversed(self.nodes):
            node.chars += node.own
            if p := node.parent:
                p.chars += node.chars
                p.link_chars += node.link_chars
                p.marks += node.marks
                p.controls += node.controls
                p.words += node.words


def parse(html: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Block nodes in page order (the first is the root) and the text blocks with their nodes."""
    reader, pos, end = _Reader(), 0, len(html)
    unclosed: set[str] = set()  # names without a closing tag in the rest of the page
    token = _TOKEN
    while pos < end:
        at = _BEGIN.search(html, pos)
        if not at:
            reader.add(html[pos:])
            break
        m = token.match(html, at.start())
        if not m:
            token = _LOOSE
            m = token.match(html, at.start())
        reader.add(html[pos : m.start()])
        pos = m.end()
        name, attr_text = (m[2] or "").lower(), m[3] or ""
        if not name:
            continue
        if m[1]:
            reader.void(name) if name == "br" else reader.end_tag(name)
        elif name in RAW:
            if name in ("textarea", "iframe"):
                reader.stack[-1][1].controls += 1
            tail = None if name in unclosed or attr_text.endswith("/") else re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, pos)
            if tail:
                pos = tail.end()
            elif not attr_text.endswith("/"):
                unclosed.add(name)
                pos = end if name in TO_THE_END else pos
        elif name in VOID:
            reader.void(name)
        elif name in BLOCKS:
            reader.block(name, attr_text)
        elif not attr_text.endswith("/"):
            reader.push(name, reader.stack[-1][1])
    reader.finish()
    return reader.nodes, reader.texts


# ---- pages to learn from -------------------------------------------------------------------------------

_SYLLABLES = "an be co da el fo gi ha in jo ka le mi no or pa qu re st ti un ve wo xi ya zu é ö ñ ß th sch tion".split()


class Maker:
    """Random pages of many layouts; elements with main text carry data-y."""

    NAMES = {
        "nav": "nav menu navigation navbar main-nav topnav breadcrumb breadcrumbs site-nav".split(),
        "header": "header site-header masthead top banner topbar page-header branding".split(),
        "footer": "footer site-footer bottom copyright page-footer colophon credits".split(),
        "side": "sidebar side aside widget widgets related rail right-column recommended popular trending".split(),
        "notice": "cookie cookie-notice notice consent gdpr alert banner message privacy popup modal".split(),
        "ad": "ad ads advert advertisement sponsor sponsored promo adbox ad-slot banner-ad promotion".split(),
        "form": "form search login newsletter subscribe signup contact-form search-form".split(),
        "comments": "comments comment-list responses discussion disqus replies comment reader-comments".split(),
        "share": "share social sharing share-bar tools tags social-links".split(),
        "main": "content article post entry story main main-content article-body post-content entry-content text body-text".split(),
        "wrap": "page wrapper container site layout row col inner outer grid".split(),
    }

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r, out, n = self.r, [], self.r.randint(low, high)
        while n > 0:
            k = min(n, r.randint(1, 14))
            s = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(k)]
            rest = "".join(" " + w + ("," if r.random() < 0.1 else "") for w in s[1:])
            out.append(s[0].capitalize() + rest + r.choice(("." if r.random() < 0.9 else "", ".", "!", "?")))
            n -= k
        return " ".join(out)

    def title(self, low: int, high: int) -> str:
        """Words of a heading, mostly without a mark at their end."""
        text = self.words(low, high)
        return text.rstrip(".!?") if self.r.random() < 0.6 else text

    def tag(self, name: str, body: str, kind: str = "", y: bool = False) -> str:
        r, attrs = self.r, ""
        if kind:
            p = r.random()
            if p < 0.62:
                picked = r.choice(self.NAMES[kind])
                if r.random() < 0.25:
                    picked += " " + r.choice(("clearfix", "x" + str(r.randint(1, 99)), "block", "js-" + r.choice(_SYLLABLES)))
                attrs = f' {r.choice(("class", "class", "id"))}="{picked}"'
            elif p < 0.75:
                attrs = f' class="{r.choice(("css", "sc", "c", "el"))}-{r.randrange(16**5):x}"'
        return f"<{name}{attrs}{' data-y=1' if y else ''}>{body}" + ("" if name in ("p", "li") and r.random() < 0.1 else f"</{name}>")

    def links(self, n: int, listed: bool | None = None) -> str:
        items = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(n)]
        if listed if listed is not None else self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items)

    def inline(self, text: str) -> str:
        r, w = self.r, text.split(" ")
        for _ in range(r.choice((0, 0, 1, 2))):
            i = r.randrange(len(w))
            w[i] = r.choice(("<b>%s</b>", "<i>%s</i>", '<a href="/x">%s</a>', "<em>%s</em>", "<span>%s</span>", "<b>%s", "%s<br>")) % w[i]
        return " ".join(w)

    def main_blocks(self) -> list[str]:
        r, out = self.r, []
        if r.random() < 0.85:
            out.append(self.tag("h1", self.title(1, 12), y=True))
        count, short = r.choice((1, 1, 1, 2, 2, 3, 5, 8, 12, 20)), r.random() < 0.25
        sizes = ((1, 3), (2, 8), (3, 14)) if short else ((1, 4), (5, 30), (20, 90), (40, 160))
        text = lambda: self.inline(self.words(*r.choice(sizes)))
        for _ in range(count):
            p = r.random() * (0.78 if count == 1 else 1)
            if p < 0.74:
                out.append(self.tag("p", text(), y=True))
            elif p < 0.8:
                out.append(self.tag(r.choice(("h2", "h3")), self.title(1, 8), y=True))
            elif p < 0.86:
                out.append(f"<{(t := r.choice(('ul', 'ol')))}>" + "".join(self.tag("li", text(), y=True) for _ in range(r.randint(2, 6))) + f"</{t}>")
            elif p < 0.9:
                out.append("<blockquote>" + self.tag("p", text(), y=True) + "</blockquote>")
            elif p < 0.93:
                out.append("<table>" + "".join("<tr>" + "".join(self.tag("td", self.words(1, 4), y=True) for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif p < 0.96:
                out.append(self.tag("figure", '<img src="x">' + self.tag("figcaption", self.words(2, 15), y=True)))
            else:
                out.append(self.tag("pre" if r.random() < 0.5 else "div", text(), y=True))
        return out

    def boiler(self, kind: str) -> str:
        r, t = self.r, self.r.random() < 0.5
        if kind == "nav":
            return self.tag("nav" if t else "div", self.links(r.randint(3, 12)), "nav")
        if kind == "header":
            inner = r.choice(("", self.tag("div", self.words(1, 4)), self.tag("h1", self.title(1, 3)), self.tag("p", self.words(2, 8)))) + (self.boiler("nav") if r.random() < 0.6 else "")
            return self.tag("header" if t else "div", inner or self.words(1, 3), "header")
        if kind == "footer":
            inner = r.choice(("&copy; " + self.words(1, 12), self.tag("p", "&copy; 2024 " + self.words(1, 8)), self.links(4) + self.tag("p", self.words(3, 20))))
            return self.tag("footer" if r.random() < 0.7 else "div", inner, "footer")
        if kind == "side":
            parts = [r.choice((self.tag("h3", self.title(1, 3)) + self.links(r.randint(2, 8)), self.tag("p", self.words(3, 25)), self.boiler("form"), self.boiler("ad"))) for _ in range(r.randint(1, 4))]
            return self.tag("aside" if t else "div", "".join(parts), "side")
        if kind == "notice":
            return self.named(r.choice(("div", "section", "aside", "dialog")), self.tag("p", self.words(4, 30)) + r.choice(("", "<button>OK</button>")) if t else self.words(4, 25) + " <button>OK</button>", "notice")
        if kind == "ad":
            return self.named(r.choice(("div", "div", "aside", "section", "p")), r.choice((self.words(2, 18), self.tag("span", self.words(2, 12)), f'<a href="/a">{self.words(2, 10)}</a>')), "ad")
        if kind == "form":
            inner = r.choice(("", self.tag("label", self.words(1, 3)), self.tag("p", self.words(2, 14)))) + "<input name=q>"
            inner += r.choice(("<button>Go</button>", "<select><option>A</option><option>B</option></select>", "<textarea>x</textarea>", ""))
            return self.tag("form", inner, "form")
        if kind == "share":
            return self.named("div", self.links(r.randint(2, 5)), "share")

        def item() -> str:
            outer, head = r.choice(("li", "div", "article")), r.choice(("", self.tag("span", self.words(1, 2)), self.tag("h4", self.title(1, 2))))
            return self.named(outer, head + self.tag("p", self.words(*r.choice(((1, 8), (5, 40), (20, 80))))), "comments")

        body = r.choice(("", self.tag("h2", self.title(1, 3)), self.tag("h3", self.title(1, 3))))
        body += "".join(item() for _ in range(r.randint(1, 6))) + (self.boiler("form") if r.random() < 0.3 else "")
        return self.named(r.choice(("section", "div", "ol", "ul", "aside")), body, "comments")

    def named(self, tag: str, body: str, kind: str) -> str:
        """What tells these apart is their name, so they have one."""
        picked = self.r.choice(self.NAMES[kind])
        return f'<{tag} {self.r.choice(("class", "class", "id"))}="{picked}">{body}</{tag}>'

    def page(self) -> str:
        r = self.r
        blocks = self.main_blocks()
        for kind in ("ad", "share", "ad", "form", "side"):
            if r.random() < 0.22:
                blocks.insert(r.randint(0, len(blocks)), self.boiler(kind))
        if r.random() < 0.2:
            blocks.append(self.boiler("comments"))
        inner = "".join(blocks)
        for _ in range(r.choice((0, 0, 1, 2))):
            inner = self.tag("div", inner, r.choice(("main", "wrap")))
        holder = r.choice(("article", "article", "main", "div", "div", "section", ""))
        inner = self.tag(holder, inner, "main") if holder else inner
        after = [self.boiler(k) for k in ("comments", "side", "ad", "share", "side") if r.random() < 0.3]
        before = [self.boiler(k) for k in ("ad", "nav", "notice", "side") if r.random() < 0.3]
        body = "".join(before) + inner + "".join(after)
        for _ in range(r.choice((0, 0, 1, 2))):
            body = self.tag(r.choice(("div", "main", "section")) if holder not in ("main",) else "div", body, "wrap")
        top = [self.boiler(k) for k in ("notice", "header", "nav", "ad", "form") if r.random() < 0.5]
        end = [self.boiler(k) for k in ("notice", "footer", "nav") if r.random() < (0.8 if k == "footer" else 0.2)]
        return f"<html><head><title>{self.words(1, 6)}</title><style>p{{}}</style></head><body>" + "".join(top) + body + "".join(end) + "</body></html>"
