"""Rows that share a doc_id but not their text."""

from kgsync.llm import simhash

from .helpers import SCHEMA, text


def test_each_component_keeps_a_row(spark):
    a, b, c, d = (text(k, 300) for k in (70, 71, 72, 73))
    rows = [(1, a), (2, b), (2, a), (3, c), (3, d), (3, d), (4, b), (None, a), (None, text(74, 300)), (None, text(74, 300))]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], SCHEMA)
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(1, a), (2, b), (3, c), (3, d), (None, text(74, 300))], key=repr)
