"""Column functions on identifiers and text. No UDF: all of it stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..terms import RDF_TYPE, SUB_CLASS_OF

WELL_FORMED = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://\S+$"
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://"
_URI = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


# White space, as text is split and stripped by it.
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_RUN = f"[{_SPACES}]+"


def strip(text: Column) -> Column:
    """White space in the Unicode sense, at both ends."""
    return F.trim(text, F.lit(_SPACES))


def squeeze(text: Column) -> Column:
    """White space in the Unicode sense to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def normalize(identifier: Column) -> Column:
    """An absolute identifier inside another one stands for the whole; http before https, each the first after the start."""
    t = strip(identifier)
    # nearly all identifiers have none inside, which a plain search tells
    return F.when(F.locate("http", t, 2) > 0, F.regexp_replace(t, r"(?s)^(?:.+?(?=http://)|.+?(?=https://))", "")).otherwise(t)


def _local(t: Column) -> Column:
    part = lambda pattern: F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))
    return F.coalesce(part("#([^#]+)$"), part("([^/]+)/*$"), t)


def local_name(identifier: Column) -> Column:
    """What follows the last #, or else the last slash that is not at the end, or else all."""
    return _local(strip(identifier))


def normalized_local_name(identifier: Column) -> Column:
    """`local_name` of `normalize`, which has no white space at its ends."""
    return _local(normalize(identifier))


def term_local_name(kind: Column, term: Column) -> Column:
    return F.when(kind == "bnode", F.concat(F.lit("_:"), term)).otherwise(normalized_local_name(term))


def is_malformed(identifier: Column) -> Column:
    """More than one absolute identifier in it."""
    return F.size(F.regexp_extract_all(strip(identifier), F.lit("https?://"), 0)) > 1


def let(value: Column, body) -> Column:
    """Evaluate `value` once for all its uses in `body`."""
    return F.transform(F.array(value), body)[0]


def comparable_uri(uri: Column) -> Column:
    return let(squeeze(uri), comparable_squeezed_uri)


def comparable_squeezed_uri(t: Column) -> Column:
    """Scheme and authority in lower case, without one slash at the path's end, an empty query or fragment."""
    part = lambda i: F.regexp_extract(t, _URI, i)
    without = lambda pattern, i: F.regexp_replace(part(i), pattern, "")
    return F.when(t.rlike(_URI), F.concat(F.lower(part(1)), F.lit(":"), F.lower(without("^//$", 2)), without("(?<=.)/$", 3), without(r"^\?$", 4), without("^#$", 5))).otherwise(t)


def property_key(predicate: Column) -> Column:
    """The predicate's key in the property map."""
    return F.when(predicate == RDF_TYPE, "rdf:type").when(predicate == SUB_CLASS_OF, "rdfs:subClassOf").otherwise(normalized_local_name(predicate))


def qid_of(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def entity_uri(base: Column, qid: Column) -> Column:
    """Where an installation names its item."""
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/entity/"), qid)


def direct_predicate_uri(base: str, pid: str) -> str:
    """By which its query service knows a property's plain values."""
    return "/".join((base.rstrip("/"), "prop", "direct", pid))


def escape_sparql(value: str) -> str:
    return value.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")


def quoted(text: Column) -> Column:
    """As messages show a value: in single quotes, or double ones if it has single ones only."""
    double = text.contains("'") & ~text.contains('"')
    return F.when(double, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'")))
