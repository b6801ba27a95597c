"""Profiles of a graph and its entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..terms import DESCRIPTIONS, LABEL, META_TYPES, OWL, RDF_TYPE, SUB_CLASS_OF
from ..written import checkpointed
from .ontology import Ontology, in_order


def predicate_usage(onto: Ontology) -> DataFrame:
    """(map_key, n, value_kinds sorted, local_name)"""
    return onto.statements.groupBy("map_key").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("value_kind")).alias("value_kinds"), F.min("predicate_local_name").alias("local_name"))


def language_distribution(onto: Ontology) -> DataFrame:
    return onto.labels.groupBy("lang").agg(F.count("*").alias("n"))


def duplicate_labels(onto: Ontology) -> DataFrame:
    return onto.labels.groupBy("lang", "text").agg(F.count("*").alias("n")).where("n > 1")


def entity_type_counts(onto: Ontology) -> DataFrame:
    return onto.entities.groupBy("entity_type").agg(F.count("*").alias("n"))


def unlabeled(onto: Ontology) -> DataFrame:
    return onto.display_labels.where("not labeled").drop("label", "labeled")


def unlabeled_sample(onto: Ontology, n: int = 25) -> DataFrame:
    """The first in the order of entities: a top-n, not a sort of everything."""
    return in_order(unlabeled(onto)).limit(n).select("canonical_id")


def ontology_statistics(onto: Ontology, mapping: DataFrame) -> DataFrame:
    """(metric, value): counts as text, lists as JSON text.

    One pass over the graph for its plain counts; each distinct count is one of its own columns alone, combined
    before its exchange, where one aggregate of all three would carry every triple three times more. What
    is asked of statements comes from one small table of their keys and kinds.
    """
    onto.settle()
    triples = onto.source.scan()
    p, o = F.col("p"), F.col("o")
    when = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    typed = lambda name: when((p == RDF_TYPE) & (o == OWL + name))  # noqa: E731  triples are a set: each counts one subject
    counts = triples.agg(
        F.count("*").alias("total_triples"),
        typed("Class").alias("owl_classes"),
        typed("NamedIndividual").alias("named_individuals"),
        typed("ObjectProperty").alias("object_properties"),
        typed("DatatypeProperty").alias("datatype_properties"),
        typed("AnnotationProperty").alias("annotation_properties"),
        when(p == LABEL).alias("labels"),
        when(p.isin(DESCRIPTIONS)).alias("descriptions"),
        when(onto.alias_predicates.column(p)).alias("aliases"),
        when(p == SUB_CLASS_OF).alias("subclass_statements"),
        when((p == RDF_TYPE) & ~o.isin(META_TYPES)).alias("instance_of_statements"),
    )
    blank = triples.where("s_kind = 'bnode'").select("s").union(triples.where("o_kind = 'bnode'").select("o")).distinct().agg(F.count("*").alias("blank_nodes"))
    distinct = lambda name, *columns: triples.select(*columns).distinct().agg(F.count("*").alias(name))
    subjects, predicates = distinct("unique_subjects", "s_kind", "s"), distinct("unique_predicates", "p")
    objects = distinct("unique_objects", "o_kind", "o", F.coalesce("o_datatype", F.lit("")).alias("d"), F.coalesce("o_lang", F.lit("")).alias("l"))
    usage = checkpointed(onto.statements.groupBy("map_key", "value_kind").agg(F.count("*").alias("n")))  # a row for each predicate and kind
    of_kind = lambda k: F.coalesce(F.sum(F.when(F.col("value_kind") == k, F.col("n"))), F.lit(0))
    kinds = usage.agg(*(of_kind(k).alias(f"{k}_valued_statements") for k in ("literal", "resource", "blank_node")))
    unused = usage.select("map_key").distinct().join(mapping.select(F.col("source_predicate").alias("map_key")), "map_key", "left_anti")
    unmapped = unused.agg(F.count("*").alias("unmapped_predicate_count"), F.to_json(F.sort_array(F.collect_list("map_key"))).alias("unmapped_predicates"))
    bare = unlabeled(onto).agg(F.count("*").alias("entities_without_labels"))
    sample = unlabeled_sample(onto).agg(F.to_json(F.sort_array(F.collect_list("canonical_id"))).alias("entities_without_labels_sample"))
    total = onto.entities.agg(F.count("*").alias("total_entities_parsed"))
    langs = language_distribution(onto).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "n"))))).alias("language_distribution"))
    doubles = duplicate_labels(onto).agg(F.count("*").alias("duplicate_labels"))

    def long(df: DataFrame) -> DataFrame:
        return df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in df.columns))).alias("m")).select("m.*")

    out = long(counts)
    for part in (subjects, predicates, objects, blank, kinds, unmapped, bare, sample, total, langs, doubles):
        out = out.unionAll(long(part))
    return out


def label_index_of_unmapped(onto: Ontology, mapping: DataFrame) -> DataFrame:
    """Unmapped predicates with the label of their declaration, found by their identifier, and their use, most used first."""
    used = onto.statements.groupBy("map_key").agg(F.count("*").alias("usage_count"), F.array_join(F.sort_array(F.collect_set("value_kind")), ", ").alias("value_kinds"), F.min("predicate_original").alias("canonical_id"))
    bare = used.join(mapping.select(F.col("source_predicate").alias("map_key")), "map_key", "left_anti")
    named = bare.join(onto.property_labels, "canonical_id", "left")
    return named.select(F.col("map_key").alias("predicate_key"), F.coalesce("label", F.lit("")).alias("resolved_label"), "usage_count", "value_kinds").orderBy(F.desc("usage_count"), "predicate_key")
