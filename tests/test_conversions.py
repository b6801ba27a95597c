"""A catalogued query converts every statement, not a part of them."""

from kgsync.catalog.queries import QUERIES, onto

SF = "/root/testdata/sf0.001"


def test_all_statements_are_converted(spark):
    statements = onto(spark, SF).statements.select("s", "map_key", "value")
    out = QUERIES["convert_values"](spark, SF).cache()
    assert out.count() == 9 * statements.count()
    assert out.select("s", "map_key", "value").distinct().exceptAll(statements.distinct()).count() == 0
    assert out.where("dt = 'time' and error is null").count() and out.where("dt = 'quantity' and error is null").count()
    out.unpersist()
