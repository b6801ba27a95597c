"""Execution of a plan: late binding of items, what is written, and the run's result.

Writes go through a connector (`sources.remote`); everything that can be known without it is a plan here.
Values are those that the plan converted; they are not converted a second time from their comparable form.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.values import to_item
from ..operators.numbering import numbered
from .plan import Planner

METADATA = ["UPDATE_LABEL", "ADD_DESCRIPTION", "UPDATE_DESCRIPTION", "ADD_ALIAS"]


class DryRunError(RuntimeError):
    pass


def guard(config: Config) -> None:
    if config.dry_run:
        raise DryRunError("a live run was asked for while dry_run is set")


def number_new_items(first: int):
    """A stand-in for a knowledge base: new items are numbered in the order of entities."""

    def create(new: DataFrame) -> DataFrame:
        return numbered(new, F.col("is_thing").desc(), F.col("s")).withColumn("qid", F.concat(F.lit("Q"), F.col("n") + (first - 1)))

    return create


class Execution:
    """`create` gives new entities (with s, is_thing, canonical_id, ...) their `qid` and a number `n` in the order of creation."""

    def __init__(self, planner: Planner, create):
        self.planner, self.create = planner, create
        planner.settle()

    @cached_property
    def created(self) -> DataFrame:
        return self.create(self.planner.resolution.where("is_new").drop("qid"))

    def cache_entries(self, timestamp: str) -> DataFrame:
        """What the cache takes up for each item made."""
        return self.created.select("canonical_id", "qid", "entity_type", F.col("s").alias("source_identifier"), "label", F.lit(timestamp).alias("last_synced_at"))

    @cached_property
    def qids(self) -> DataFrame:
        """(canonical_id, qid): what was resolved, and what was made; of an identifier made twice the later one."""
        made = self.created.groupBy("canonical_id").agg(F.max_by("qid", "n").alias("qid"))
        return self.planner.resolution.where("qid is not null").select("canonical_id", "qid").distinct().unionByName(made)

    # ---- metadata

    def metadata_rows(self) -> DataFrame:
        """Metadata of items that were there before: those made now have theirs already. (source_identifier, action, field, lang, new_value)"""
        rows = self.planner.metadata_rows("label", "description", "alias")
        rows = rows.join(self.created.select(F.col("canonical_id").alias("source_identifier")), "source_identifier", "left_anti")
        return rows.select("source_identifier", "action", F.substring_index("property_name", "@", 1).alias("field"), F.expr("substr(property_name, locate('@', property_name) + 1)").alias("lang"), "new_value")

    def metadata_updates(self) -> DataFrame:
        """One row for each item: its labels and descriptions by language (the greatest, should there be two), its aliases."""
        c = F.col
        one = self.metadata_rows().groupBy("source_identifier", "field", "lang").agg(F.max("new_value").alias("text"), F.collect_list("new_value").alias("texts"))
        pick = lambda f: F.map_from_entries(F.array_sort(F.collect_list(F.when(c("field") == f, F.struct("lang", "text")))))
        named = F.transform("texts", lambda t: F.struct("lang", t.alias("text")))
        aliases = F.array_sort(F.flatten(F.collect_list(F.when(c("field") == "alias", named))))
        out = one.groupBy("source_identifier").agg(pick("label").alias("labels"), pick("description").alias("descriptions"), aliases.alias("aliases"))
        return out.join(self.qids.withColumnRenamed("canonical_id", "source_identifier"), "source_identifier", "left").select("source_identifier", "qid", "labels", "descriptions", "aliases")

    # ---- statements

    @cached_property
    def judged(self) -> DataFrame:
        """All statement rows with the items of their subject and object, and what becomes of those that are to be added."""
        c = F.col
        rows = self.planner.statement_rows()
        subject = self.qids.select(c("canonical_id").alias("source_identifier"), c("qid").alias("subject_qid"))
        target = self.qids.select(c("canonical_id").alias("target_key"), c("qid").alias("target_qid"))
        is_item = c("target_source_identifier") != ""
        key = F.when(is_item, c("target_source_identifier")).otherwise(F.concat(F.lit(" "), c("source_identifier")))
        out = rows.join(subject, "source_identifier", "left").withColumn("target_key", key).join(target, "target_key", "left")
        datavalue = F.when(is_item, to_item(c("target_qid"))["datavalue"]).otherwise(c("datavalue"))
        status = F.when(c("subject_qid").isNull(), "error").when(is_item & c("target_qid").isNull(), "unresolved_target").when(datavalue.isNull(), "error").otherwise("added")
        return out.withColumn("datavalue", datavalue).withColumn("status", F.when(c("action") == "ADD_STATEMENT", status).otherwise(""))

    @property
    def bound(self) -> DataFrame:
        """The statements to add."""
        names = ["source_identifier", "subject_qid", "pid", "property_name", "target_source_identifier", "target_qid", "datavalue", "status"]
        return self.judged.where("action = 'ADD_STATEMENT'").select(*names)

    # ---- the result

    def result(self, run_id: str) -> DataFrame:
        """One row of counters. Unresolved entities are those of the plan, as reports count them; objects that had no item at write time are a column of their own."""
        count = lambda *a: F.count_if(F.col("action").isin(*a))
        status = lambda s: F.count_if(F.col("status") == s)
        planned = self.judged.agg(
            count("UNRESOLVED_OBJECT").alias("unresolved_objects"),
            count("SKIP_UNMAPPED_PROPERTY").alias("unresolved_properties"),
            count("SKIP_UNCHANGED").alias("statements_skipped_unchanged"),
            status("added").alias("statements_added"),
            status("error").alias("statement_errors"),
            status("unresolved_target").alias("unresolved_targets"),
        )
        conflict = F.count_if(F.col("source") == "conflict")
        resolved = self.planner.resolution.agg(conflict.alias("conflicts"), F.count_distinct(F.when(F.col("qid").isNotNull(), F.col("canonical_id"))).alias("items_reused"))
        made = self.created.agg(F.count("*").alias("items_created"))
        size = lambda c: F.coalesce(F.sum(F.when(c.isNotNull(), F.size(c))), F.lit(0)).cast("long")
        has = lambda v: F.when(F.col("qid").isNotNull(), v)
        meta = self.metadata_updates().agg(
            F.count_if(F.col("qid").isNull()).alias("metadata_errors"),
            size(has(F.map_keys("labels"))).alias("labels_updated"),
            size(has(F.map_keys("descriptions"))).alias("descriptions_updated"),
            size(has(F.col("aliases"))).alias("aliases_added"),
        )
        out = planned.withColumn("k", F.lit(1))
        for part in (resolved, made, meta):
            out = out.join(part.withColumn("k", F.lit(1)), "k")
        errors = F.col("metadata_errors") + F.col("statement_errors")
        return out.select(
            F.lit(run_id).alias("run_id"), F.when(errors == 0, "completed").otherwise("completed_with_errors").alias("status"), "items_created", "items_reused", "labels_updated", "descriptions_updated", "aliases_added",
            "statements_added", "statements_skipped_unchanged", (F.col("unresolved_objects") + F.col("conflicts")).alias("unresolved_entities"), "unresolved_properties", "unresolved_targets", "conflicts", errors.alias("errors"),
        )
