"""Conversion of statement values to typed values of the knowledge base, as column expressions.

Functions with a leading underscore take text whose white space is squeezed already; a plan that has it
as a column of its own (`convert(..., squeezed=...)`) keeps all of this in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..terms import CALENDAR, DATATYPES
from .identifiers import SCHEME, comparable_squeezed_uri, comparable_uri, let, quoted, squeeze

# What a day, a month, a year and a quantity look like.
_FULL = r"^([+-]?[0-9]{1,9})-([0-9]{2})-([0-9]{2})(?:T.*)?$"
_MONTH = r"^([+-]?[0-9]{1,9})-([0-9]{2})$"
_YEAR = r"^[+-]?[0-9]{1,9}$"
_QUANTITY = r"^([+-]?[0-9]+(?:\.[0-9]+)?)\s*(.*)$"


def _zeros(digits: Column, width: int) -> Column:
    """Zeros in front up to a width; longer digits stay whole."""
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(width) - F.length(digits))), digits)


def _result(ok: Column, datavalue: Column, comparable: Column, error: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(ok.alias("success"), F.when(ok, datavalue).otherwise(none).alias("datavalue"), F.when(ok, comparable).otherwise(none).alias("comparable_value"), F.when(ok, none).otherwise(error).alias("error"))


def _json(kind: str, value: Column) -> Column:
    return F.to_json(F.struct(F.lit(kind).alias("type"), value.alias("value")))


def failure(error: Column) -> Column:
    return _result(F.lit(False), F.lit(""), F.lit(""), error)


def to_time(value: Column) -> Column:
    return let(squeeze(value), _time)


def _time(t: Column) -> Column:
    """Years of up to nine digits, with a month and a day if given; no test of the calendar. A plus sign stays beside the one that is added."""
    full, month, year = t.rlike(_FULL), t.rlike(_MONTH), t.rlike(_YEAR)
    y = F.when(full, F.regexp_extract(t, _FULL, 1)).when(month, F.regexp_extract(t, _MONTH, 1)).otherwise(t)
    m = F.when(full, F.regexp_extract(t, _FULL, 2)).when(month, F.regexp_extract(t, _MONTH, 2)).otherwise("00")
    d = F.when(full, F.regexp_extract(t, _FULL, 3)).otherwise("00")
    rest = F.substring(y, F.lit(2), F.length(y))
    padded = F.when(y.startswith("-"), F.concat(F.lit("-"), _zeros(rest, 4))).when(y.startswith("+"), F.concat(F.lit("++"), _zeros(rest, 3))).otherwise(F.concat(F.lit("+"), _zeros(y, 4)))
    text = F.concat(padded, F.lit("-"), m, F.lit("-"), d, F.lit("T00:00:00Z"))
    precision = F.when(full, 11).when(month, 10).otherwise(9)
    value = F.struct(F.lit(0).alias("after"), F.lit(0).alias("before"), F.lit(CALENDAR).alias("calendarmodel"), precision.alias("precision"), text.alias("time"), F.lit(0).alias("timezone"))
    return _result(full | month | year, _json("time", value), text, F.concat(F.lit("unparseable_time_value:"), quoted(t)))


def to_quantity(value: Column) -> Column:
    return let(squeeze(value), _quantity)


def _quantity(t: Column) -> Column:
    amount = F.regexp_extract(t, _QUANTITY, 1)
    signed = F.when(amount.rlike("^[+-]"), amount).otherwise(F.concat(F.lit("+"), amount))
    unit = F.coalesce(F.nullif(F.trim(F.regexp_extract(t, _QUANTITY, 2)), F.lit("")), F.lit("1"))
    return _result(t.rlike(_QUANTITY), _json("quantity", F.struct(signed.alias("amount"), unit.alias("unit"))), F.concat(signed, F.lit("|"), unit), F.concat(F.lit("unparseable_quantity_value:"), quoted(t)))


def to_item(qid: Column) -> Column:
    return let(squeeze(qid), _item)


def _item(t: Column) -> Column:
    return _result(t.rlike(r"\AQ[0-9]+\z"), _json("wikibase-entityid", F.struct(F.lit("item").alias("entity-type"), t.alias("id"))), t, F.concat(F.lit("invalid_qid:"), quoted(t)))


def to_text(value: Column) -> Column:
    return let(squeeze(value), _text)


def _text(t: Column) -> Column:
    return _result(t != "", _json("string", t), t, F.lit("empty_string_value"))


def to_url(value: Column) -> Column:
    return let(squeeze(value), _url)


def _url(t: Column) -> Column:
    return _result(t.rlike(SCHEME), _json("string", t), comparable_squeezed_uri(t), F.concat(F.lit("not_a_uri:"), quoted(t)))


def to_monolingual(value: Column, language: Column, default_language: str) -> Column:
    return let(squeeze(value), lambda t: _monolingual(t, language, default_language))


def _monolingual(t: Column, language: Column, default_language: str) -> Column:
    lang = F.coalesce(F.nullif(language, F.lit("")), F.lit(default_language))
    return _result(t != "", _json("monolingualtext", F.struct(lang.alias("language"), t.alias("text"))), F.concat(lang, F.lit(":"), t), F.lit("empty_monolingualtext_value"))


def datavalue(datatype: Column, value: Column, language: Column, default_language: str = "en") -> Column:
    """struct(success, datavalue as JSON, comparable_value, error) of a value that is final."""
    return let(squeeze(value), lambda t: _datavalue(datatype, t, language, default_language))


def _datavalue(datatype: Column, t: Column, language: Column, default_language: str) -> Column:
    return (
        F.when(datatype == "wikibase-item", _item(t))
        .when(datatype.isin("string", "external-id", "commonsMedia"), _text(t))
        .when(datatype == "url", _url(t))
        .when(datatype == "monolingualtext", _monolingual(t, language, default_language))
        .when(datatype == "time", _time(t))
        .when(datatype == "quantity", _quantity(t))
        .otherwise(failure(F.concat(F.lit("unsupported_wikibase_datatype:"), datatype)))
    )


def convert(kind: Column, value: Column, datatype: Column, language: Column, qid: Column, default_language: str = "en", squeezed: Column | None = None) -> Column:
    """The same for a statement's value; an item takes the resolved `qid`. Blank nodes are text like any other unless a caller keeps them away."""
    return (
        F.when((datatype == "wikibase-item") & (kind != "resource"), failure(F.concat(F.lit("datatype_mismatch: wikibase-item property received value_kind="), quoted(kind))))
        .when((datatype == "wikibase-item") & (F.coalesce(qid, F.lit("")) == ""), failure(F.lit("unresolved_target_qid")))
        .when(datatype == "wikibase-item", _item(qid) if squeezed is not None else to_item(qid))
        .when((kind == "resource") & ~datatype.isin("url", "string", "external-id"), failure(F.concat(F.lit("datatype_mismatch: resource value cannot populate "), quoted(datatype))))
        .otherwise(_datavalue(datatype, squeezed, language, default_language) if squeezed is not None else datavalue(datatype, value, language, default_language))
    )


def comparable(datatype: Column, value: Column) -> Column:
    """The form in which existing values are compared."""
    return F.when(datatype == "url", comparable_uri(value)).otherwise(squeeze(value))


def is_supported(datatype: Column) -> Column:
    return datatype.isin(DATATYPES)
