"""Findings: (check, severity, message, source_identifier, details as JSON).

Fixed values: the names of checks, their severities and the texts of messages, which readers of reports know.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import WELL_FORMED, is_malformed, strip
from ..sources.triples import Predicates
from ..terms import ATTENTION, FINDING_COLUMNS, RDF_TYPE, RESOURCE_DATATYPES, SEVERITIES, SUB_CLASS_OF
from .ontology import Ontology
from .profile import duplicate_labels, predicate_usage, unlabeled

_TIME = r"^[+-]?[0-9]{1,9}(-[0-9]{2}(-[0-9]{2})?)?"
_QUANTITY = r"^[+-]?[0-9]+(\.[0-9]+)?"


def message(template: str, **parts: Column) -> Column:
    """Text with {names} for columns."""
    out, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        out += [F.lit(before)] * bool(before) + [parts.get(name, F.col(name)).cast("string")]
    return F.concat(*out, *([F.lit(rest)] if rest else []))


def finding(check: str, severity: str, text: Column, identifier: Column | None = None, **details: Column) -> Column:
    named = F.to_json(F.struct(*(v.alias(k) for k, v in details.items()))) if details else F.lit("{}")
    return F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), text.alias("message"), (F.lit("") if identifier is None else identifier).alias("source_identifier"), named.alias("details"))


def from_rows(df: DataFrame, *found: Column) -> DataFrame:
    """All findings of each row in one pass; a finding that does not hold is null."""
    return df.select(F.explode(F.array(*found)).alias("f")).where("f is not null").select("f.*")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- the property map

def used_mappings(onto: Ontology, mapping: DataFrame) -> DataFrame:
    """Full outer: (map_key, n, value_kinds, used, configured, pid, wikibase_datatype)."""
    usage = predicate_usage(onto).withColumn("used", F.lit(True))
    configured = mapping.select(F.col("source_predicate").alias("map_key"), F.nullif("pid", F.lit("")).alias("pid"), F.nullif("wikibase_datatype", F.lit("")).alias("wikibase_datatype"), F.lit(True).alias("configured"))
    return usage.join(configured, "map_key", "full").withColumn("used", F.coalesce("used", F.lit(False))).withColumn("configured", F.coalesce("configured", F.lit(False)))


def duplicate_pids(mapping: DataFrame) -> DataFrame:
    """(pid, keys sorted) of ids that several keys have."""
    return mapping.where("coalesce(pid, '') <> ''").groupBy("pid").agg(F.sort_array(F.collect_list("source_predicate")).alias("keys")).where(F.size("keys") > 1)


def mapping_findings(onto: Ontology, mapping: DataFrame) -> DataFrame:
    key, both, kinds, kind = F.col("map_key"), F.col("used") & F.col("configured"), F.col("value_kinds"), F.col("wikibase_datatype")
    typed = both & kind.isNotNull()
    rows = from_rows(
        used_mappings(onto, mapping),
        F.when(
            F.col("used") & ~F.col("configured"),
            finding("unmapped_predicate", "WARNING", message("Predicate '{map_key}' is used {n} time(s) in the OWL file but has no PROPERTY_MAP entry."), key, count=F.col("n"), value_kinds=kinds),
        ),
        F.when(F.col("configured") & ~F.col("used"), finding("unused_property_mapping", "INFO", message("PROPERTY_MAP entry '{map_key}' is configured but not used by any statement in the OWL file."), key)),
        F.when(both & F.col("pid").isNull(), finding("missing_pid", "ERROR", message("Predicate '{map_key}' is used in the OWL file but PROPERTY_MAP['{map_key}']['pid'] is None."), key)),
        F.when(both & kind.isNull(), finding("missing_datatype", "ERROR", message("PROPERTY_MAP['{map_key}'] has no wikibase_datatype configured."), key)),
        F.when(
            typed & F.array_contains(kinds, "resource") & ~kind.isin(RESOURCE_DATATYPES),
            finding(
                "incompatible_datatype",
                "ERROR",
                message("Predicate '{map_key}' has resource-valued statements in the OWL file, but is mapped to wikibase_datatype='{wikibase_datatype}', which cannot represent a resource reference."),
                key,
            ),
        ),
        F.when(
            typed & (kinds == F.array(F.lit("literal"))) & (kind == "wikibase-item"),
            finding("incompatible_datatype", "ERROR", message("Predicate '{map_key}' only has literal-valued statements in the OWL file, but is mapped to wikibase_datatype='wikibase-item'."), key),
        ),
        F.when(
            typed & F.array_contains(kinds, "blank_node"),
            finding("blank_node_statement", "WARNING", message("Predicate '{map_key}' has blank-node-valued statements, which cannot become Wikibase items."), key),
        ),
    )
    text = message("PID {pid} is assigned to multiple PROPERTY_MAP entries: {list}.", list=F.array_join("keys", ", "))
    doubles = from_rows(duplicate_pids(mapping), finding("duplicate_pid_assignment", "BLOCKING", text, None, pid=F.col("pid"), keys=F.col("keys")))
    return rows.unionByName(doubles)


def mapping_summary(onto: Ontology, mapping: DataFrame) -> DataFrame:
    """(category, keys as JSON), eight rows whatever is found."""
    typed = F.col("wikibase_datatype").isNotNull()
    both = F.col("used") & F.col("configured")
    wrong = both & typed & ((F.array_contains("value_kinds", "resource") & ~F.col("wikibase_datatype").isin(RESOURCE_DATATYPES)) | ((F.col("value_kinds") == F.array(F.lit("literal"))) & (F.col("wikibase_datatype") == "wikibase-item")))
    sets = {
        "discovered_predicates": F.col("used"),
        "mapped_predicates": both,
        "unmapped_predicates": F.col("used") & ~F.col("configured"),
        "unused_mappings": F.col("configured") & ~F.col("used"),
        "predicates_missing_pid": both & F.col("pid").isNull(),
        "predicates_missing_datatype": both & ~typed,
        "incompatible_datatype_predicates": F.coalesce(wrong, F.lit(False)),
    }
    wide = used_mappings(onto, mapping).agg(*(F.to_json(F.sort_array(F.collect_set(F.when(c, F.col("map_key"))))).alias(n) for n, c in sets.items()))
    doubles = duplicate_pids(mapping).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("pid", "keys"))))).alias("duplicate_pid_assignments"))
    long = lambda df: df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("category"), F.col(c).alias("keys")) for c in df.columns))).alias("x")).select("x.*")
    return long(wide).unionAll(long(doubles))


# ---- the entities

def duplicate_canonical_ids(onto: Ontology) -> DataFrame:
    return onto.entities.groupBy("canonical_id").agg(F.count("*").alias("n")).where("n > 1")


def mapped_statements(onto: Ontology, mapping: DataFrame, statements: DataFrame | None = None) -> DataFrame:
    """Statements with pid, wikibase_datatype and whether there is an entry. The map is small and Spark, which knows its size, broadcasts it."""
    entry = mapping.select(F.col("source_predicate").alias("map_key"), F.nullif("pid", F.lit("")).alias("pid"), F.nullif("wikibase_datatype", F.lit("")).alias("wikibase_datatype"), F.lit(True).alias("has_entry"))
    return (onto.statements if statements is None else statements).join(entry, "map_key", "left").withColumn("has_entry", F.coalesce("has_entry", F.lit(False)))


def item_predicates(mapping: DataFrame) -> Predicates:
    """The predicates that point to items, as far as their keys tell. The map is kept by hand: a row for each predicate."""
    keys = [r[0] for r in mapping.where("wikibase_datatype = 'wikibase-item'").select("source_predicate").collect()]
    fixed = {"rdf:type": RDF_TYPE, "rdfs:subClassOf": SUB_CLASS_OF}
    return Predicates(tuple(fixed[k] for k in keys if k in fixed), tuple(k.lower() for k in keys if k not in fixed))


def unresolved_objects(onto: Ontology, mapping: DataFrame) -> DataFrame:
    """Statements whose object should be an item of ours and is none."""
    known = onto.entities.select(F.col("canonical_id").alias("value")).distinct()
    pointing = onto.statements_of(item_predicates(mapping)).where("value_kind = 'resource'").join(known, "value", "left_anti")
    return mapped_statements(onto, mapping, pointing.join(onto.subjects.select("s"), "s", "left_semi")).where("wikibase_datatype = 'wikibase-item'")


def quality_findings(onto: Ontology, mapping: DataFrame) -> DataFrame:
    onto.settle()
    c, me = F.col, F.col("canonical_id")
    supported = [*onto.config.supported_languages, onto.config.default_language]
    of_entities = from_rows(
        onto.entities,
        F.when(me == "", finding("missing_identifier", "BLOCKING", message("Entity with original id '{s}' has no canonical identifier."), c("s"))),
        F.when(is_malformed(c("s")), finding("malformed_uri", "INFO", message("Original identifier '{s}' embeds more than one absolute URI; normalized to '{canonical_id}'."), me)),
    )
    doubles = from_rows(duplicate_canonical_ids(onto), finding("duplicate_canonical_id", "BLOCKING", message("Canonical id '{canonical_id}' resolves to {n} distinct OWL resources."), me))
    bare = from_rows(unlabeled(onto), finding("missing_label", "WARNING", message("Entity '{canonical_id}' has no rdfs:label in any language."), me))
    named = onto.entities.select("s", "is_thing", "canonical_id")
    foreign = onto.labels.where(~c("lang").isin(supported)).join(named, ["s", "is_thing"])
    foreign = from_rows(foreign, finding("unsupported_language_tag", "INFO", message("Entity '{canonical_id}' has a label in language '{lang}', which is not in SUPPORTED_LANGUAGES."), me))
    same = from_rows(duplicate_labels(onto), finding("duplicate_label", "INFO", message("Label '{text}' ({lang}) is used by {n} different entities."), None, language=c("lang"), label=c("text"), count=c("n")))

    me = c("subject_canonical_id")
    kind, datatype, value, key = c("value_kind"), c("wikibase_datatype"), c("value"), c("map_key")
    real, literal = kind != "blank_node", kind == "literal"
    text = lambda t: message(t.replace("{me}", "{subject_canonical_id}"))
    of_statements = from_rows(
        mapped_statements(onto, mapping),
        F.when(~real, finding("blank_node_statement", "WARNING", text("Entity '{me}' has a blank-node value for predicate '{map_key}'."), me)),
        F.when((kind == "resource") & ~value.rlike(WELL_FORMED), finding("malformed_uri", "WARNING", text("Resource value '{value}' for predicate '{map_key}' is not a well-formed URI."), me)),
        F.when(
            literal & (datatype == "url") & ~strip(value).rlike(WELL_FORMED),
            finding(
                "invalid_url_value",
                "WARNING",
                text(
                    "Value '{value}' for predicate '{map_key}' is not a well-formed URL and will be reported as an ERROR in the synchronization plan rather than written to "
                    "Wikibase (commonly a placeholder like 'None' left by the authoring tool when no value was set)."
                ),
                me,
                predicate=key,
                value=value,
            ),
        ),
        F.when(real & ~c("has_entry"), finding("predicate_without_mapping", "WARNING", text("Entity '{me}' uses predicate '{map_key}', which has no PROPERTY_MAP entry."), me, predicate=key)),
        F.when(literal & (datatype == "time") & ~strip(value).rlike(_TIME), finding("invalid_time_value", "ERROR", text("Value '{value}' for predicate '{map_key}' cannot be parsed as a time."), me)),
        F.when(literal & (datatype == "quantity") & ~strip(value).rlike(_QUANTITY), finding("invalid_quantity_value", "ERROR", text("Value '{value}' for predicate '{map_key}' cannot be parsed as a quantity."), me)),
    )
    dangling = from_rows(unresolved_objects(onto, mapping), finding("unresolved_object", "WARNING", text("Entity '{me}' has a resource-valued statement on '{map_key}' pointing to '{value}', which is not among the parsed classes/individuals."), me, predicate=key, object=value))
    return _union([doubles, of_entities, bare, foreign, of_statements, dangling, same])


def all_findings(onto: Ontology, mapping: DataFrame) -> DataFrame:
    return quality_findings(onto, mapping).unionByName(mapping_findings(onto, mapping))


def summary(findings: DataFrame) -> DataFrame:
    """(severity, n) for all four severities, in the order of their names."""
    spark = findings.sparkSession
    every = spark.createDataFrame([(s,) for s in SEVERITIES], "severity string")
    return every.join(findings.groupBy("severity").agg(F.count("*").alias("n")), "severity", "left").select("severity", F.coalesce("n", F.lit(0)).cast("long").alias("n")).orderBy("severity")


def preview(findings: DataFrame, n: int = 20) -> DataFrame:
    """The first findings: by severity, then by check and where they are."""
    return findings.orderBy("severity", "check", "source_identifier", "message", "details").limit(n)


def has_blocking(findings: DataFrame) -> DataFrame:
    return findings.agg(F.coalesce(F.bool_or(F.col("severity") == "BLOCKING"), F.lit(False)).alias("has_blocking"))


def safety_gate(findings: DataFrame, plan: DataFrame, config) -> DataFrame:
    """One row: whether a live run may go on. Only findings made before count; blocking rows of the plan are reported beside."""
    blocked = F.col("has_blocking") & F.lit(config.stop_on_validation_error)
    rows = plan.agg(F.count_if(F.col("severity") == "BLOCKING").alias("blocking_plan_rows"))
    gate = has_blocking(findings).select(F.lit(1).alias("k"), (~F.lit(config.dry_run) & ~blocked).alias("proceed"), F.when(F.lit(config.dry_run), "dry run").when(blocked, "blocking findings").otherwise("").alias("reason"))
    return gate.join(rows.withColumn("k", F.lit(1)), "k").drop("k")


# ---- after a run

def post_sync_findings(entities: DataFrame, cache: DataFrame, plan: DataFrame, live: DataFrame | None = None) -> DataFrame:
    """`live`: (qid) of items that the knowledge base has, if it was asked."""
    c = F.col
    missing = missing_qids(entities, cache)
    doubles = duplicate_qids(cache)
    severity = F.create_map(*(F.lit(x) for kv in ATTENTION.items() for x in kv))
    echoed = plan.where(c("action").isin(list(ATTENTION)))
    echoes = echoed.select(F.concat(F.lit("unresolved_action_"), F.lower("action")).alias("check"), severity[c("action")].alias("severity"), message("{action}: {reason}").alias("message"), "source_identifier", F.lit("{}").alias("details"))
    parts = [
        from_rows(missing, finding("missing_qid_after_sync", "ERROR", message("Entity '{canonical_id}' has no QID in the cache after synchronization."), c("canonical_id"))),
        from_rows(doubles, finding("duplicate_qid_mapping", "BLOCKING", message("QID {qid} is mapped from {n} different canonical ids.", n=F.size("canonical_ids")), None, qid=c("qid"), canonical_ids=c("canonical_ids"))),
        echoes,
    ]
    if live is not None:
        parts.append(from_rows(not_live(cache, live), finding("cached_qid_not_found_live", "ERROR", message("Cached QID {qid} for '{canonical_id}' could not be found on Wikibase."), c("canonical_id"))))
    return _union(parts).select(*FINDING_COLUMNS)


def missing_qids(entities: DataFrame, cache: DataFrame) -> DataFrame:
    return entities.select("canonical_id").join(cache.where("coalesce(qid, '') <> ''").select("canonical_id"), "canonical_id", "left_anti")


def duplicate_qids(cache: DataFrame) -> DataFrame:
    """(qid, canonical_ids) of items that stand for several identifiers. Entries without an item are none of these."""
    return cache.where("coalesce(qid, '') <> ''").groupBy("qid").agg(F.sort_array(F.collect_list("canonical_id")).alias("canonical_ids")).where(F.size("canonical_ids") > 1)


def not_live(cache: DataFrame, live: DataFrame) -> DataFrame:
    return cache.select("canonical_id", "qid").join(live.select("qid").distinct(), "qid", "left_anti")


