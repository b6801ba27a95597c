"""Content hashes over canonical JSON: keys in order, no spaces, no null fields left out.

Text is hashed as UTF-8 as it is. A hash is compared with hashes made here only, so what counts is that
equal content has equal hashes; the digest of ASCII content is that of ASCII-escaped JSON too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WITH_NULLS = {"ignoreNullFields": "false"}


def canonical_json(**fields: Column) -> Column:
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), _WITH_NULLS)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def statement_hash(subject: Column, predicate: Column, value_kind: Column, value: Column, datatype: Column, language: Column) -> Column:
    empty = lambda c: F.coalesce(c, F.lit(""))
    return sha256(canonical_json(subject=subject, predicate=predicate, value_kind=value_kind, value=value, datatype=empty(datatype), language=empty(language)))


def statement_json(s: Column) -> Column:
    names = "subject_canonical_id predicate_original predicate_local_name value_kind value literal_datatype language statement_hash".split()
    return canonical_json(**{n: s[n] for n in names})


def entity_hash(canonical_id: Column, entity_type: Column, labels: Column, descriptions: Column, aliases: Column, statements: Column) -> Column:
    """Maps come with their keys in order, `aliases` with sorted values, `statements` as sorted JSON strings."""
    return sha256(canonical_json(canonical_id=canonical_id, entity_type=entity_type, labels=labels, descriptions=descriptions, aliases=aliases, statements=statements))
