"""Readers of RDF files. N-Triples are read line by line by Spark; documents of the other syntaxes are
parsed whole, one task for each file.

A term is (text, kind, datatype, language), a triple (s, s_kind, p, o, o_kind, o_datatype, o_lang).
Lexical forms of literals stay as they are written.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from io import BytesIO
from itertools import count, islice
from urllib.parse import urljoin
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from ..terms import RDF, RDF_TYPE, TRIPLES
from ..written import new_folder, remove
from .triples import TableSource

XML = "{http://www.w3.org/XML/1998/namespace}"
_R = "{" + RDF + "}"
XSD = "http://www.w3.org/2001/XMLSchema#"
# Syntaxes by ending, and the order in which unknown ones are tried.
BY_ENDING = {"owl": "xml", "rdf": "xml", "xml": "xml", "ttl": "turtle", "n3": "n3", "nt": "nt", "jsonld": "json-ld", "json": "json-ld"}
ORDER = ["xml", "turtle", "n3", "nt", "json-ld"]
NAMES = [c.split()[0] for c in TRIPLES.split(", ")]


class OntologyLoadError(RuntimeError):
    pass


# ---- N-Triples, in columns

_TERM = r'(<[^>]*>|_:\S+|"(?:[^"\\]|\\.)*"(?:\^\^<[^>]*>|@[A-Za-z0-9-]+)?)'
_LINE = rf"^\s*(<[^>]*>|_:\S+)\s*<([^>]*)>\s*{_TERM}\s*\.\s*(?:#.*)?$"


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    return ntriples(spark.read.text(path))


def ntriples(lines: DataFrame) -> DataFrame:
    """Lines that are no triples (empty ones, comments, damaged ones) give none."""
    g = lambda i: F.regexp_extract("value", _LINE, i)
    split = lines.where(F.col("value").rlike(_LINE)).select(g(1).alias("a"), g(2).alias("p"), g(3).alias("b"))
    # escapes of N-Triples strings are those of JSON strings
    unescaped = lambda t: F.when(t.contains("\\"), F.get_json_object(F.concat(F.lit('{"v":"'), F.replace(F.replace(t, F.lit("\t"), F.lit("\\t")), F.lit("\\'"), F.lit("'")), F.lit('"}')), "$.v")).otherwise(t)
    kind = lambda c: F.when(F.col(c).startswith("<"), "iri").when(F.col(c).startswith("_:"), "bnode").otherwise("literal")
    inner = lambda c: F.when(F.col(c).startswith("<"), F.expr(f"substring({c}, 2, length({c}) - 2)")).when(F.col(c).startswith("_:"), F.expr(f"substring({c}, 3)"))
    literal = lambda i: F.regexp_extract("b", r'(?s)^"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>)?(?:@(.*))?$', i)
    return split.select(inner("a").alias("s"), kind("a").alias("s_kind"), "p", F.coalesce(inner("b"), unescaped(literal(1))).alias("o"), kind("b").alias("o_kind"), F.nullif(literal(2), F.lit("")).alias("o_datatype"), F.nullif(literal(3), F.lit("")).alias("o_lang"))


# ---- RDF/XML

def parse_xml(data: bytes, base: str = "") -> Iterator[tuple]:
    root = ElementTree.fromstring(data)
    names = (f"x{i}" for i in count())
    base = root.get(XML + "base", base)

    def iri(ref: str, at: str) -> str:
        return ref if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", ref) else (at.split("#")[0] + ref if ref.startswith("#") else urljoin(at, ref) if at else ref)

    def tag_iri(tag: str) -> str:
        return tag[1:].replace("}", "", 1)

    def node(e, at: str, lang: str | None) -> Iterator:
        """Yields triples; the first value is the node's own (text, kind)."""
        at, lang = e.get(XML + "base", at), e.get(XML + "lang", lang)
        if (about := e.get(_R + "about")) is not None:
            me = (iri(about, at), "iri")
        elif (name := e.get(_R + "ID")) is not None:
            me = (iri("#" + name, at), "iri")
        else:
            me = (e.get(_R + "nodeID") or next(names), "bnode")
        yield me
        if e.tag != _R + "Description":
            yield (*me, RDF_TYPE, tag_iri(e.tag), "iri", None, None)
        for k, v in e.attrib.items():
            if k == _R + "type":
                yield (*me, RDF_TYPE, iri(v, at), "iri", None, None)
            elif k.startswith("{") and not k.startswith((_R, XML)):
                yield (*me, tag_iri(k), v, "literal", None, lang)
        members = count(1)
        for c in e:
            p = RDF + f"_{next(members)}" if c.tag == _R + "li" else tag_iri(c.tag)
            yield from value(me, p, c, at, lang)

    def value(me, p: str, c, at: str, lang: str | None) -> Iterator[tuple]:
        at, lang = c.get(XML + "base", at), c.get(XML + "lang", lang)
        kind = c.get(_R + "parseType")
        if (ref := c.get(_R + "resource")) is not None:
            yield (*me, p, iri(ref, at), "iri", None, None)
        elif (ref := c.get(_R + "nodeID")) is not None:
            yield (*me, p, ref, "bnode", None, None)
        elif kind == "Literal":
            inner = (c.text or "") + "".join(ElementTree.tostring(x, encoding="unicode") for x in c)
            yield (*me, p, inner, "literal", RDF + "XMLLiteral", None)
        elif kind == "Resource":
            b = (next(names), "bnode")
            yield (*me, p, *b, None, None)
            for x in c:
                yield from value(b, tag_iri(x.tag), x, at, lang)
        elif kind == "Collection":
            items = []
            for x in c:
                inner = node(x, at, lang)
                items.append(next(inner))
                yield from inner
            cells = [(next(names), "bnode") for _ in items] + [(RDF + "nil", "iri")]
            yield (*me, p, *cells[0], None, None)
            for cell, item, rest in zip(cells, items, cells[1:], strict=False):
                yield (*cell, RDF + "first", *item, None, None)
                yield (*cell, RDF + "rest", *rest, None, None)
        elif len(c):
            inner = node(c[0], at, lang)
            yield (*me, p, *next(inner), None, None)
            yield from inner
        else:
            datatype = c.get(_R + "datatype")
            yield (*me, p, c.text or "", "literal", iri(datatype, at) if datatype else None, None if datatype else lang)

    for e in root if root.tag == _R + "RDF" else [root]:
        inner = node(e, base, root.get(XML + "lang"))
        next(inner)
        yield from inner


# ---- Turtle (and what N3 shares with it)

_TURTLE = re.compile(
    r"""(?P<space>\s+|\#[^\n]*)|(?P<iri><[^<>"\s]*>)|(?P<long>\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?''')|(?P<str>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<lang>@[A-Za-z][A-Za-z0-9-]*)|(?P<type>\^\^)"""
    r"""|(?P<bnode>_:[\w.-]*[\w-])|(?P<num>[+-]?(?:\d+\.\d*|\.\d+|\d+)(?:[eE][+-]?\d+)?(?=[\s;,.\])]|$))|(?P<name>[^\s<>"'(){}\[\];,^@]*:(?:[^\s<>"'(){}\[\];,^@\\]|\\.)*(?<!\.))|(?P<word>[A-Za-z]+)|(?P<mark>[.;,\[\]()])""",
    re.S,
)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.S)
_CHARS = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}


def _unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _CHARS.get(m[1], m[1]), text)


class _Turtle:
    def __init__(self, text: str, base: str):
        self.tokens, self.at, self.base, self.prefixes = self._split(text), 0, base, {}
        self.names = (f"t{i}" for i in count())
        self.out: list[tuple] = []

    @staticmethod
    def _split(text: str) -> list[tuple[str, str]]:
        out, at = [], 0
        while at < len(text):
            m = _TURTLE.match(text, at)
            if not m:
                raise ValueError(f"not Turtle at {text[at : at + 30]!r}")
            at = m.end()
            if m.lastgroup != "space":
                out.append((m.lastgroup, m[0]))
        return out

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, mark: str | None = None) -> tuple[str, str]:
        t = self.peek()
        if t[0] == "end" or mark and t[1] != mark:
            raise ValueError(f"{mark or 'more'} expected, not {t[1]!r}")
        self.at += 1
        return t

    def run(self) -> list[tuple]:
        while self.peek()[0] != "end":
            kind, text = self.peek()
            if text.lower() in ("@prefix", "@base", "prefix", "base"):
                self.take()
                if text.lower().endswith("prefix"):
                    name = self.take()[1]
                    self.prefixes[name[:-1]] = self.iri(self.take()[1])
                else:
                    self.base = self.iri(self.take()[1])
                if text.startswith("@"):
                    self.take(".")
                continue
            me = self.term()
            if self.peek()[1] != ".":
                self.properties(me)
            self.take(".")
        return self.out

    def iri(self, text: str) -> str:
        ref = _unescape(text[1:-1])
        return ref if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", ref) else (self.base.split("#")[0] + ref if ref.startswith("#") else urljoin(self.base, ref))

    def properties(self, me: tuple) -> None:
        while True:
            kind, text = self.peek()
            if kind == "word" and text == "a":
                self.take()
                p = RDF_TYPE
            else:
                p = self.term()[0]
            while True:
                o = self.term()
                self.out.append((me[0], me[1], p, *o))
                if self.peek()[1] != ",":
                    break
                self.take()
            if self.peek()[1] != ";":
                return
            while self.peek()[1] == ";":
                self.take()
            if self.peek()[1] in (".", "]"):
                return

    def term(self) -> tuple:
        kind, text = self.take()
        if kind == "iri":
            return self.iri(text), "iri", None, None
        if kind == "name":
            prefix, _, name = text.partition(":")
            if prefix not in self.prefixes:
                raise ValueError(f"unknown prefix {prefix!r}")
            return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", name), "iri", None, None
        if kind == "bnode":
            return text[2:], "bnode", None, None
        if text == "[":
            me = (next(self.names), "bnode", None, None)
            if self.peek()[1] != "]":
                self.properties(me)
            self.take("]")
            return me
        if text == "(":
            items = []
            while self.peek()[1] != ")":
                items.append(self.term())
            self.take()
            rest = (RDF + "nil", "iri", None, None)
            for item in reversed(items):
                cell = (next(self.names), "bnode", None, None)
                self.out += [(*cell[:2], RDF + "first", *item), (*cell[:2], RDF + "rest", *rest)]
                rest = cell
            return rest
        if kind in ("str", "long"):
            n = 3 if kind == "long" else 1
            value = _unescape(text[n:-n])
            if self.peek()[0] == "lang":
                return value, "literal", None, self.take()[1][1:]
            if self.peek()[0] == "type":
                self.take()
                return value, "literal", self.term()[0], None
            return value, "literal", None, None
        if kind == "num":
            return text, "literal", XSD + ("double" if "e" in text.lower() else "decimal" if "." in text else "integer"), None
        if text in ("true", "false"):
            return text, "literal", XSD + "boolean", None
        raise ValueError(f"no term: {text!r}")


def parse_turtle(data: bytes, base: str = "") -> Iterator[tuple]:
    return iter(_Turtle(data.decode("utf-8"), base).run())


# ---- JSON-LD with contexts inside the document

def parse_jsonld(data: bytes, base: str = "") -> Iterator[tuple]:
    names = (f"j{i}" for i in count())

    def expand(name: str, ctx: dict) -> str:
        if name.startswith("@"):
            return name
        given = ctx.get(name)
        if isinstance(given, dict):
            given = given.get("@id")
        if given and given != name:
            return expand(given, ctx)
        prefix, sep, rest = name.partition(":")
        if sep and prefix in ctx and not rest.startswith("//"):
            return expand(prefix, ctx) + rest
        return name if sep else ctx.get("@vocab", "") + name

    def subject(ref: str, ctx: dict) -> tuple:
        return (ref[2:], "bnode") if ref.startswith("_:") else (urljoin(base, expand(ref, ctx) if ":" in ref else ref), "iri")

    def node(value: dict, ctx: dict) -> Iterator:
        own = value.get("@context", {})
        ctx = ctx | {k: v for c in (own if isinstance(own, list) else [own]) if isinstance(c, dict) for k, v in c.items()}
        me = subject(value["@id"], ctx) if "@id" in value else (next(names), "bnode")
        yield me
        for k, v in value.items():
            values = v if isinstance(v, list) else [v]
            if k == "@graph":
                for x in values:
                    inner = node(x, ctx)
                    next(inner)
                    yield from inner
            elif k == "@type":
                for x in values:
                    yield (*me, RDF_TYPE, expand(x, ctx), "iri", None, None)
            elif not k.startswith("@") and ":" in (p := expand(k, ctx)):
                rule = ctx.get(k) if isinstance(ctx.get(k), dict) else {}
                for x in values:
                    if isinstance(x, dict) and "@value" in x:
                        yield (*me, p, str(x["@value"]), "literal", expand(x["@type"], ctx) if "@type" in x else None, x.get("@language"))
                    elif isinstance(x, dict):
                        inner = node(x, ctx)
                        yield (*me, p, *next(inner), None, None)
                        yield from inner
                    elif rule.get("@type") == "@id":
                        yield (*me, p, *subject(x, ctx), None, None)
                    elif isinstance(x, bool):
                        yield (*me, p, str(x).lower(), "literal", XSD + "boolean", None)
                    elif isinstance(x, (int, float)):
                        yield (*me, p, str(x), "literal", XSD + ("integer" if isinstance(x, int) else "double"), None)
                    elif x is not None:
                        yield (*me, p, x, "literal", rule.get("@type"), rule.get("@language", ctx.get("@language") if not rule.get("@type") else None))

    document = json.loads(data)
    for top in document if isinstance(document, list) else [document]:
        inner = node(top, {})
        next(inner)
        yield from inner


PARSERS = {"xml": parse_xml, "turtle": parse_turtle, "n3": parse_turtle, "json-ld": parse_jsonld}


# ---- files

def read_documents(spark: SparkSession, path: str, syntax: str) -> DataFrame:
    """Triples of whole documents. Blank nodes carry their file's name, as they mean nothing outside it."""
    parse = PARSERS[syntax]
    ship(spark)

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                scope = f"{name.rsplit('/', 1)[-1]}-"
                named = (tuple(scope + x if k in (0, 3) and t[k + 1] == "bnode" else x for k, x in enumerate(t)) for t in parse(data, name))
                while rows := list(islice(named, 50_000)):
                    yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=NAMES)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, TRIPLES)


def load_ontology(spark: SparkSession, path: str, syntax: str | None = None, folder: str | None = None) -> TableSource:
    """A graph of a file, or of the files in a folder, parsed once and written down as a table at `folder` (default: in the shared one).

    Without a syntax, that of its ending is tried first, then all in turn; the first that reads it counts.
    """
    try:
        files = spark.read.format("binaryFile").load(path).select("length").collect()
    except AnalysisException as e:
        raise OntologyLoadError(f"no file at {path}") from e
    if not files:
        raise OntologyLoadError(f"no file at {path}")
    if not any(f.length for f in files):
        raise OntologyLoadError(f"{path} is empty")
    guessed = BY_ENDING.get(path.rsplit(".", 1)[-1].lower())
    tried, errors = [syntax] if syntax else list(dict.fromkeys([guessed, *ORDER] if guessed else ORDER)), []
    folder = folder or new_folder(spark, "triples")
    for s in tried:
        triples = read_ntriples(spark, path) if s == "nt" else read_documents(spark, path, s)
        try:
            source = TableSource.written(triples, folder)
            if not source.triples.isEmpty():
                return source
            errors.append(f"{s}: no triple")
        except Exception as e:  # noqa: BLE001  the next syntax may do
            errors.append(f"{s}: {str(e).strip().splitlines()[-1][:200]}")
        remove(spark, folder)
    raise OntologyLoadError(f"{path} can't be read: " + "; ".join(errors))


def declared_prefixes(spark: SparkSession, path: str, syntax: str) -> DataFrame:
    """(prefix, namespace) that the files declare; N-Triples declare none."""
    ship(spark)

    def found(data: bytes) -> set[tuple[str, str]]:
        if syntax == "xml":
            return {tuple(x) for _, x in ElementTree.iterparse(BytesIO(data), ["start-ns"])}
        if syntax in ("turtle", "n3"):
            reader = _Turtle(data.decode("utf-8"), "")
            reader.run()
            return set(reader.prefixes.items())
        if syntax == "json-ld":
            document = json.loads(data)
            contexts = [d.get("@context", {}) for d in (document if isinstance(document, list) else [document])]
            return {(k, v) for c in contexts if isinstance(c, dict) for k, v in c.items() if isinstance(v, str) and v.endswith(("#", "/"))}
        return set()

    def run(batches):
        for batch in batches:
            rows = sorted(set().union(*map(found, batch.column("content").to_pylist())))
            yield pa.record_batch({"prefix": pa.array([r[0] for r in rows], pa.string()), "namespace": pa.array([r[1] for r in rows], pa.string())})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "prefix string, namespace string").distinct().orderBy("prefix", "namespace")
