"""The registered queries, by name, with their DuckDB SQL. Arrays and maps leave as JSON text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import identifiers as ids
from ..functions import values
from ..operators import profile, validate
from ..operators.ontology import Ontology
from ..plans import plan as plans
from ..plans.execute import Execution, number_new_items
from ..plans.plan import Existing, Planner
from ..sources import fixtures, rdf, stores, triples
from ..sources.remote import claim_values, remote_matches
from ..terms import LABEL, PLAN_COLUMNS, SUB_CLASS_OF, THING
from . import sql
from .sql import NS, PRELUDE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
FIRST_QID = 90_000_000


def query(oracle: str | None = None, prelude: bool = True):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            SQL[f.__name__] = (PRELUDE if prelude else "") + oracle
        return f

    return register


def table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def onto(spark, d) -> Ontology:
    return Ontology(fixtures.graph(spark, d), Config())


def mapping(spark) -> DataFrame:
    return fixtures.property_map_fx(spark)


def planner(spark, d) -> Planner:
    existing = Existing(fixtures.entity_cache_fx(spark, d), fixtures.remote_matches_fx(spark, d), fixtures.existing_items_fx(spark, d), fixtures.existing_metadata_fx(spark, d), fixtures.existing_claims_fx(spark, d))
    return Planner(onto(spark, d), mapping(spark), existing)


def execution(spark, d) -> Execution:
    return Execution(planner(spark, d), number_new_items(FIRST_QID))


# ---- scalar functions

@query(f"SELECT s, {sql.norm('s')} AS canonical_id FROM (SELECT DISTINCT s FROM t)")
def normalize_identifiers(spark, d):
    return fixtures.graph(spark, d).scan().select("s").distinct().select("s", ids.normalize(F.col("s")).alias("canonical_id"))


@query(f"SELECT DISTINCT s, s_kind, CASE WHEN s_kind = 'bnode' THEN '_:' || s ELSE {sql.local(sql.norm('s'))} END AS local_name FROM t")
def local_name(spark, d):
    return fixtures.graph(spark, d).scan().select("s", "s_kind").distinct().withColumn("local_name", ids.term_local_name(F.col("s_kind"), F.col("s")))


@query("SELECT s, len(regexp_extract_all(s, 'https?://')) > 1 AS malformed FROM (SELECT DISTINCT s FROM t)")
def malformed_uri(spark, d):
    return fixtures.graph(spark, d).scan().select("s").distinct().withColumn("malformed", ids.is_malformed(F.col("s")))


@query(f"SELECT page_id, {sql.uri('url')} AS comparable, {sql.uri(chr(39) + ' HTTP://Host.Example.ORG/Path/ ' + chr(39) + ' || page_id || ' + chr(39) + '?' + chr(39))} AS made FROM pages", prelude=False)
def normalize_urls(spark, d):
    made = F.concat(F.lit(" HTTP://Host.Example.ORG/Path/ "), F.col("page_id"), F.lit("?"))
    return table(spark, d, "pages").select("page_id", ids.comparable_uri(F.col("url")).alias("comparable"), ids.comparable_uri(made).alias("made"))


_DATES = "SELECT o_orderkey, CASE o_orderkey % 20 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN 'not a date' WHEN 3 THEN '-0044-03-15' WHEN 4 THEN '+7' WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS x FROM orders"


@query(f"SELECT o_orderkey, x AS given, {sql.time('x')} AS comparable_value, {sql.precision('x')} AS precision, CASE WHEN {sql.time('x')} IS NULL THEN 'unparseable_time_value:''' || x || '''' END AS error FROM ({_DATES})", prelude=False)
def convert_time(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    x = F.when(k % 20 == 4, "+7").when(k % 20 == 5, F.date_format(day, "yyyy-MM-dd'T00:00:00'")).otherwise(fixtures.order_date(k, day))
    out = table(spark, d, "orders").select("o_orderkey", x.alias("given")).withColumn("c", values.to_time(F.col("given")))
    return out.select("o_orderkey", "given", "c.comparable_value", F.get_json_object("c.datavalue", "$.value.precision").cast("int").alias("precision"), "c.error")


@query(
    f"SELECT p_partkey, x AS given, {sql.quantity('x')} AS comparable_value, CASE WHEN {sql.quantity('x')} IS NULL THEN 'unparseable_quantity_value:''' || trim(x) || '''' END AS error "
    "FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size || ' cm' WHEN 1 THEN '-' || p_size || '.50' WHEN 2 THEN 'about ' || p_size WHEN 3 THEN '1,' || p_size ELSE ' +' || p_size || 'e5  kg ' END AS x FROM part)",
    prelude=False,
)
def convert_quantity(spark, d):
    k, s, lit = F.col("p_partkey"), F.col("p_size"), F.lit
    x = F.when(k % 5 == 0, F.concat(s, lit(" cm"))).when(k % 5 == 1, F.concat(lit("-"), s, lit(".50"))).when(k % 5 == 2, F.concat(lit("about "), s)).when(k % 5 == 3, F.concat(lit("1,"), s)).otherwise(F.concat(lit(" +"), s, lit("e5  kg ")))
    out = table(spark, d, "part").select("p_partkey", x.alias("given")).withColumn("c", values.to_quantity(F.col("given")))
    return out.select("p_partkey", "given", "c.comparable_value", "c.error")


_CONVERT = sql.converted("value_kind", "value", "dt", "language", "'Q' || length(value)")


_CONVERSIONS = (
    f"SELECT s, map_key, value, dt, {_CONVERT} AS comparable_value, CASE WHEN {_CONVERT} IS NULL THEN {sql.conversion_error('value_kind', 'value', 'dt', chr(39) + 'Q' + chr(39) + ' || length(value)')} END AS error "
    "FROM (SELECT *, unnest(['wikibase-item', 'string', 'external-id', 'url', 'monolingualtext', 'time', 'quantity', 'commonsMedia', 'geo-shape']) AS dt FROM st"
)


def conversions(statements: DataFrame) -> DataFrame:
    """Each statement's value converted to each datatype, and to one that is not known."""
    kinds = [*values.DATATYPES, "geo-shape"]
    out = statements.withColumn("dt", F.explode(F.array(*map(F.lit, kinds)))).withColumn("c", values.convert(F.col("value_kind"), F.col("value"), F.col("dt"), F.col("language"), F.concat(F.lit("Q"), F.length("value"))))
    return out.select("s", "map_key", "value", "dt", "c.comparable_value", "c.error")


@query(f"{_CONVERSIONS})")
def convert_values(spark, d):
    return conversions(onto(spark, d).statements)


@query("SELECT qid, map_key, cmp AS comparable FROM have")
def normalize_claims(spark, d):
    keys = mapping(spark).where("pid is not null").select("pid", F.col("source_predicate").alias("map_key"), "wikibase_datatype")
    known = fixtures.existing_claims_fx(spark, d).join(fixtures.existing_items_fx(spark, d), "qid", "left_semi")
    return known.join(keys, "pid").select("qid", "map_key", values.comparable(F.col("wikibase_datatype"), F.col("value")).alias("comparable")).distinct()


@query("SELECT DISTINCT predicate_original, map_key FROM st")
def property_key(spark, d):
    return onto(spark, d).statements.select("predicate_original", "map_key").distinct()


_J = lambda *pairs: "'{' || " + " || ',' || ".join(f"'\"{k}\":' || coalesce(CAST(to_json({v}) AS VARCHAR), 'null')" for k, v in sorted(pairs)) + " || '}'"
_STATEMENT_HASH = "sha256(" + _J(("subject", "subject"), ("predicate", "predicate_local_name"), ("value_kind", "value_kind"), ("value", "value"), ("datatype", "coalesce(literal_datatype, '')"), ("language", "coalesce(language, '')")) + ")"


@query(f"SELECT s, predicate_original, value, {_STATEMENT_HASH} AS statement_hash FROM st")
def statement_hash(spark, d):
    return onto(spark, d).hashed_statements.select("s", "predicate_original", "value", "statement_hash")


_MAP = lambda name, value: f"(SELECT s, is_thing, '{{' || string_agg('\"' || lang || '\":' || {value}, ',' ORDER BY lang) || '}}' AS j FROM {name} GROUP BY s, is_thing)"
_STATEMENT_JSON = _J(("subject_canonical_id", "subject"), ("predicate_original", "predicate_original"), ("predicate_local_name", "predicate_local_name"), ("value_kind", "value_kind"), ("value", "value"), ("literal_datatype", "literal_datatype"), ("language", "language"), ("statement_hash", _STATEMENT_HASH))
_ALIAS_LISTS = f"(SELECT s, is_thing, lang, {sql.jlist('list_sort(list(text))')} AS j FROM ali GROUP BY s, is_thing, lang)"
_NESTED = (
    f"FROM ent e LEFT JOIN {_MAP('lab', 'CAST(to_json(text) AS VARCHAR)')} l ON l.s = e.s AND l.is_thing = e.is_thing LEFT JOIN {_MAP('dsc', 'CAST(to_json(text) AS VARCHAR)')} x ON x.s = e.s AND x.is_thing = e.is_thing "
    f"LEFT JOIN {_MAP(_ALIAS_LISTS, 'j')} a ON a.s = e.s AND a.is_thing = e.is_thing "
    f"LEFT JOIN (SELECT s, '[' || array_to_string(list_transform(list_sort(list({_STATEMENT_JSON})), lambda v: CAST(to_json(v) AS VARCHAR)), ',') || ']' AS j, count(*) AS n FROM st GROUP BY s) z ON z.s = e.s AND NOT e.is_thing"
)
_HASH = "sha256('{\"aliases\":' || coalesce(a.j, '{}') || ',\"canonical_id\":' || to_json(e.canonical_id) || ',\"descriptions\":' || coalesce(x.j, '{}') || ',\"entity_type\":' || to_json(e.entity_type) || ',\"labels\":' || coalesce(l.j, '{}') || ',\"statements\":' || coalesce(z.j, '[]') || '}')"


@query(f"SELECT e.s AS original_id, e.is_thing, {_HASH} AS content_hash {_NESTED}")
def entity_hashes(spark, d):
    return onto(spark, d).nested().select("original_id", "is_thing", "content_hash")


QUERIES["entity_hash"], SQL["entity_hash"] = QUERIES.pop("entity_hashes"), SQL.pop("entity_hashes")

# ---- graph and entities

@query("SELECT s, s_kind, p, o, o_kind, coalesce(o_datatype, '') AS o_datatype, coalesce(o_lang, '') AS o_lang FROM t")
def scan_triples(spark, d):
    return fixtures.graph(spark, d).scan().withColumns({c: F.coalesce(c, F.lit("")) for c in ("o_datatype", "o_lang")})


_NS = f"'{NS}"
_TRIPLE = "SELECT '{syntax}' AS syntax, {s} AS s, '{p}' AS p, {o} AS o, '{kind}' AS o_kind, '{datatype}' AS o_datatype, '{lang}' AS o_lang FROM {table}"


def _parsed() -> str:
    customer, supplier, region, nation = (f"{_NS}{n}_' || {k}" for n, k in (("Customer", "c_custkey"), ("Supplier", "s_suppkey"), ("Region", "r_regionkey"), ("Nation", "n_nationkey")))
    xsd, individual = "http://www.w3.org/2001/XMLSchema#", f"'{sql.OWL}NamedIndividual'"
    rows = [
        ("nt", customer, sql.RDF_TYPE, individual, "iri", "", "", "customer"),
        ("nt", customer, LABEL, "c_name", "literal", "", "en", "customer"),
        ("nt", customer, NS + "balance", "CAST(c_acctbal AS VARCHAR)", "literal", xsd + "decimal", "", "customer"),
        ("turtle", supplier, sql.RDF_TYPE, individual, "iri", "", "", "supplier"),
        ("turtle", supplier, LABEL, "s_name", "literal", "", "en", "supplier"),
        ("turtle", supplier, NS + "hasNation", f"{_NS}Nation_' || s_nationkey", "iri", "", "", "supplier"),
        ("turtle", supplier, NS + "rank", "CAST(s_suppkey AS VARCHAR)", "literal", xsd + "integer", "", "supplier"),
        ("xml", region, sql.RDF_TYPE, f"'{sql.OWL}Class'", "iri", "", "", "region"),
        ("xml", region, LABEL, "r_name", "literal", "", "en", "region"),
        ("xml", region, SUB_CLASS_OF, f"'{THING}'", "iri", "", "", "region"),
        ("json-ld", nation, sql.RDF_TYPE, individual, "iri", "", "", "nation"),
        ("json-ld", nation, NS + "inRegion", f"{_NS}Region_' || n_regionkey", "iri", "", "", "nation"),
        ("json-ld", nation, NS + "name", "n_name", "literal", "", "", "nation"),
    ]
    names = ("syntax", "s", "p", "o", "kind", "datatype", "lang", "table")
    return " UNION ALL ".join(_TRIPLE.format(**dict(zip(names, r, strict=True))) for r in rows)


@query(_parsed(), prelude=False)
def scan_parsed(spark, d):
    """Files of each syntax, made from the tables, parsed and read back."""
    parts = []
    for syntax, folder in fixtures.documents(spark, d).items():
        read = rdf.load_ontology(spark, folder, syntax).scan()
        parts.append(read.select(F.lit(syntax).alias("syntax"), "s", "p", "o", "o_kind", F.coalesce("o_datatype", F.lit("")).alias("o_datatype"), F.coalesce("o_lang", F.lit("")).alias("o_lang")))
    return reduce(DataFrame.unionAll, parts)


@query("SELECT s AS subject, p AS predicate, o AS object FROM t ORDER BY s, p, o LIMIT 15")
def triple_sample(spark, d):
    return triples.sample(fixtures.graph(spark, d))


@query("SELECT CASE WHEN x = '' THEN p ELSE x END AS namespace, count(*) AS n FROM (SELECT p, regexp_extract(p, '^(.*[#/])', 1) AS x FROM t) GROUP BY 1")
def namespaces(spark, d):
    return triples.namespaces(fixtures.graph(spark, d))


_TYPED = (
    f"(SELECT s AS resource, CASE WHEN bool_or(o = '{sql.OWL}Class') THEN 'OwlClass' WHEN bool_or(o = '{sql.OWL}NamedIndividual') THEN 'NamedIndividual' WHEN bool_or(o = '{sql.OWL}ObjectProperty') THEN 'ObjectProperty' "
    f"WHEN bool_or(o = '{sql.OWL}DatatypeProperty') THEN 'DatatypeProperty' WHEN bool_or(o = '{sql.OWL}AnnotationProperty') THEN 'AnnotationProperty' ELSE 'Unknown' END AS entity_type FROM t WHERE p = '{sql.RDF_TYPE}' AND s_kind = 'iri' GROUP BY s)"
)


@query(f"SELECT * FROM {_TYPED}")
def classify_resources(spark, d):
    return onto(spark, d).typed_resources()


@query(f"SELECT p AS predicate, coalesce(entity_type, 'Unknown') AS entity_type FROM (SELECT DISTINCT p FROM t) LEFT JOIN {_TYPED} ON resource = p")
def classify_predicates(spark, d):
    return onto(spark, d).classify_predicates()


@query("SELECT s, canonical_id, entity_type, local_name FROM subj")
def syncable_subjects(spark, d):
    return onto(spark, d).subjects


@query(f"SELECT s, lang, {sql.jlist('list_sort(list(text))')} AS texts FROM lv WHERE p = '{sql.LABEL}' GROUP BY s, lang")
def language_values(spark, d):
    from ..sources.triples import Predicates

    return onto(spark, d).language_values(Predicates((LABEL,))).groupBy("s", "lang").agg(F.to_json(F.sort_array(F.collect_list("text"))).alias("texts"))


@query("SELECT s, lang, text, is_thing FROM lab")
def entity_labels(spark, d):
    return onto(spark, d).labels


@query("SELECT s, lang, text FROM dsc")
def entity_descriptions(spark, d):
    return onto(spark, d).descriptions


@query("SELECT s, lang, text FROM ali")
def entity_aliases(spark, d):
    return onto(spark, d).aliases


@query("SELECT s, is_thing, label FROM disp")
def primary_label(spark, d):
    return onto(spark, d).display_labels.select("s", "is_thing", "label")


@query("SELECT s, subject AS subject_canonical_id, predicate_original, predicate_local_name, value_kind, value, literal_datatype, language, map_key FROM st")
def statements(spark, d):
    return onto(spark, d).statements


@query("SELECT s, canonical_id, entity_type, local_name FROM thing")
def owl_thing(spark, d):
    return onto(spark, d).thing


@query(f"SELECT e.canonical_id, e.s AS original_id, e.entity_type, e.local_name, coalesce(l.j, '{{}}') AS labels, coalesce(x.j, '{{}}') AS descriptions, coalesce(a.j, '{{}}') AS aliases, coalesce(z.n, 0) AS n_statements, {_HASH} AS content_hash {_NESTED}")
def entities(spark, d):
    return onto(spark, d).nested().select("canonical_id", "original_id", "entity_type", "local_name", *(F.to_json(c).alias(c) for c in ("labels", "descriptions", "aliases")), F.size("statements").cast("long").alias("n_statements"), "content_hash")


@query(f"SELECT {sql.norm('s')} AS canonical_id, arg_min(text, (lang, text)) AS label FROM lv WHERE p = '{sql.LABEL}' AND s IN (SELECT s FROM t WHERE p = '{sql.RDF_TYPE}' AND o IN ('{sql.OWL}ObjectProperty', '{sql.OWL}DatatypeProperty', '{sql.OWL}AnnotationProperty')) GROUP BY 1")
def property_label_index(spark, d):
    return onto(spark, d).property_labels


# ---- profiles

_ALIAS_P = "lower(" + sql.local(sql.norm("p")) + ") IN ('aliase', 'alias', 'aliases')"
_TYPE_N = lambda n: f"(SELECT CAST(count(DISTINCT s) AS VARCHAR) FROM t WHERE p = '{sql.RDF_TYPE}' AND o = '{sql.OWL}{n}')"
_COUNT = lambda frm: f"(SELECT CAST(count(*) AS VARCHAR) FROM {frm})"
_BARE = "(SELECT canonical_id, is_thing, s FROM ent WHERE NOT is_thing AND s NOT IN (SELECT s FROM lab WHERE NOT is_thing))"
_STATS = {
    "total_triples": _COUNT("t"),
    "unique_subjects": _COUNT("(SELECT DISTINCT s_kind, s FROM t)"),
    "unique_predicates": _COUNT("(SELECT DISTINCT p FROM t)"),
    "unique_objects": _COUNT("(SELECT DISTINCT o_kind, o, coalesce(o_datatype, ''), coalesce(o_lang, '') FROM t)"),
    "owl_classes": _TYPE_N("Class"),
    "named_individuals": _TYPE_N("NamedIndividual"),
    "object_properties": _TYPE_N("ObjectProperty"),
    "datatype_properties": _TYPE_N("DatatypeProperty"),
    "annotation_properties": _TYPE_N("AnnotationProperty"),
    "labels": _COUNT(f"t WHERE p = '{sql.LABEL}'"),
    "descriptions": _COUNT(f"t WHERE p IN ('{sql.COMMENT}', '{sql.DC_DESCRIPTION}', '{sql.DCTERMS_DESCRIPTION}')"),
    "aliases": _COUNT(f"t WHERE {_ALIAS_P}"),
    "subclass_statements": _COUNT(f"t WHERE p = '{sql.SUB_CLASS_OF}'"),
    "instance_of_statements": _COUNT(f"t WHERE p = '{sql.RDF_TYPE}' AND o NOT IN {sql._list(sql.META_TYPES)}"),
    "blank_nodes": _COUNT("(SELECT s FROM t WHERE s_kind = 'bnode' UNION SELECT o FROM t WHERE o_kind = 'bnode')"),
    "literal_valued_statements": _COUNT("st WHERE value_kind = 'literal'"),
    "resource_valued_statements": _COUNT("st WHERE value_kind = 'resource'"),
    "blank_node_valued_statements": _COUNT("st WHERE value_kind = 'blank_node'"),
    "unmapped_predicate_count": _COUNT("used WHERE used AND NOT configured"),
    "unmapped_predicates": f"(SELECT {sql.jlist('list_sort(list(k))')} FROM used WHERE used AND NOT configured)",
    "entities_without_labels": _COUNT(_BARE),
    "entities_without_labels_sample": f"(SELECT {sql.jlist('list_sort(list(canonical_id))')} FROM (SELECT canonical_id FROM {_BARE} ORDER BY is_thing DESC, s LIMIT 25))",
    "total_entities_parsed": _COUNT("ent"),
    "language_distribution": "(SELECT '{' || string_agg('\"' || lang || '\":' || n, ',' ORDER BY lang) || '}' FROM (SELECT lang, count(*) AS n FROM lab GROUP BY lang))",
    "duplicate_labels": _COUNT("(SELECT 1 FROM lab GROUP BY lang, text HAVING count(*) > 1)"),
}


@query(" UNION ALL ".join(f"SELECT '{k}' AS metric, {v} AS value" for k, v in _STATS.items()))
def ontology_statistics(spark, d):
    return profile.ontology_statistics(onto(spark, d), mapping(spark))


@query(f"SELECT map_key, n, {sql.jlist('kinds')} AS value_kinds, local_name FROM usage")
def predicate_usage(spark, d):
    return profile.predicate_usage(onto(spark, d)).withColumn("value_kinds", F.to_json("value_kinds"))


@query("SELECT lang, count(*) AS n FROM lab GROUP BY lang")
def language_distribution(spark, d):
    return profile.language_distribution(onto(spark, d))


@query("SELECT lang, text, count(*) AS n FROM lab GROUP BY lang, text HAVING count(*) > 1")
def duplicate_labels(spark, d):
    return profile.duplicate_labels(onto(spark, d))


@query("SELECT entity_type, count(*) AS n FROM ent GROUP BY entity_type")
def entity_type_counts(spark, d):
    return profile.entity_type_counts(onto(spark, d))


@query(f"SELECT canonical_id FROM {_BARE} ORDER BY is_thing DESC, s LIMIT 25")
def unlabeled_sample(spark, d):
    return profile.unlabeled_sample(onto(spark, d))


# ---- validation

@query("SELECT k AS map_key FROM used WHERE used AND configured")
def mapped_predicates(spark, d):
    return onto(spark, d).statements.select("map_key").intersect(mapping(spark).select("source_predicate"))


@query(f"SELECT u.map_key AS predicate_key, coalesce(l.label, '') AS resolved_label, u.n AS usage_count, array_to_string(u.kinds, ', ') AS value_kinds FROM usage u LEFT JOIN (SELECT s, arg_min(text, (lang, text)) AS label FROM lv WHERE p = '{sql.LABEL}' GROUP BY s) l ON l.s = u.predicate WHERE u.map_key NOT IN (SELECT map_key FROM pm) ORDER BY usage_count DESC, predicate_key")
def unmapped_predicates(spark, d):
    return profile.label_index_of_unmapped(onto(spark, d), mapping(spark))


@query("SELECT k AS map_key FROM used WHERE configured AND NOT used")
def unused_mappings(spark, d):
    return mapping(spark).select(F.col("source_predicate").alias("map_key")).join(onto(spark, d).statements.select("map_key").distinct(), "map_key", "left_anti")


@query(f"SELECT pid, {sql.jlist('keys')} AS keys FROM dup_pid")
def duplicate_pids(spark, d):
    return validate.duplicate_pids(mapping(spark)).withColumn("keys", F.to_json("keys"))


_KEYS = lambda where: f"(SELECT coalesce({sql.jlist('list_sort(list(k))')}, '[]') FROM used WHERE {where})"
_SUMMARY = {
    "discovered_predicates": _KEYS("used"),
    "mapped_predicates": _KEYS("used AND configured"),
    "unmapped_predicates": _KEYS("used AND NOT configured"),
    "unused_mappings": _KEYS("configured AND NOT used"),
    "predicates_missing_pid": _KEYS("used AND configured AND pid IS NULL"),
    "predicates_missing_datatype": _KEYS("used AND configured AND datatype IS NULL"),
    "incompatible_datatype_predicates": _KEYS("used AND configured AND ((list_contains(kinds, 'resource') AND datatype NOT IN ('wikibase-item', 'url', 'string', 'external-id')) OR (kinds = ['literal'] AND datatype = 'wikibase-item'))"),
    "duplicate_pid_assignments": f"(SELECT '{{' || string_agg('\"' || pid || '\":' || {sql.jlist('keys')}, ',' ORDER BY pid) || '}}' FROM dup_pid)",
}


@query(" UNION ALL ".join(f"SELECT '{k}' AS category, {v} AS keys" for k, v in _SUMMARY.items()))
def mapping_summary(spark, d):
    return validate.mapping_summary(onto(spark, d), mapping(spark))


@query(sql.MAPPING_FINDINGS)
def mapping_findings(spark, d):
    return validate.mapping_findings(onto(spark, d), mapping(spark))


@query("SELECT canonical_id, count(*) AS n FROM ent GROUP BY canonical_id HAVING count(*) > 1")
def duplicate_canonical_ids(spark, d):
    return validate.duplicate_canonical_ids(onto(spark, d))


@query("SELECT s, map_key, value FROM ms WHERE value_kind = 'resource' AND datatype = 'wikibase-item' AND value NOT IN (SELECT canonical_id FROM ent)")
def unresolved_objects(spark, d):
    return validate.unresolved_objects(onto(spark, d), mapping(spark)).select("s", "map_key", "value")


@query(sql.QUALITY_FINDINGS)
def quality_findings(spark, d):
    return validate.quality_findings(onto(spark, d), mapping(spark))


_ALL = f"({sql.QUALITY_FINDINGS} UNION ALL {sql.MAPPING_FINDINGS})"


@query(f"SELECT * FROM {_ALL}")
def all_findings(spark, d):
    return validate.all_findings(onto(spark, d), mapping(spark))


@query(f'SELECT * FROM {_ALL} ORDER BY severity, "check", source_identifier, message, details LIMIT 20')
def findings_preview(spark, d):
    return validate.preview(validate.all_findings(onto(spark, d), mapping(spark)))


@query(f"SELECT v.severity, count(f.severity) AS n FROM (VALUES ('INFO'), ('WARNING'), ('ERROR'), ('BLOCKING')) AS v(severity) LEFT JOIN {_ALL} f ON f.severity = v.severity GROUP BY v.severity")
def findings_summary(spark, d):
    return validate.summary(validate.all_findings(onto(spark, d), mapping(spark)))


@query(f"SELECT coalesce(bool_or(severity = 'BLOCKING'), false) AS has_blocking FROM {_ALL}")
def has_blocking(spark, d):
    return validate.has_blocking(validate.all_findings(onto(spark, d), mapping(spark)))


@query(f"SELECT NOT bool_or(severity = 'BLOCKING') AS proceed, CASE WHEN bool_or(severity = 'BLOCKING') THEN 'blocking findings' ELSE '' END AS reason, (SELECT count(*) FROM plan WHERE severity = 'BLOCKING') AS blocking_plan_rows FROM {_ALL}")
def safety_gate(spark, d):
    p = planner(spark, d)
    return validate.safety_gate(validate.all_findings(p.onto, p.mapping), p.plan(), Config(dry_run=False))


# ---- planning

@query("SELECT canonical_id, qid, entity_type, canonical_id AS source_identifier, 'cached ' || qid AS label, '' AS last_seen_owl_hash, '2024-01-01T00:00:00Z' AS last_synced_at FROM cache")
def cache_records(spark, d):
    return fixtures.entity_cache_fx(spark, d)


@query(f"SELECT canonical_id, qid, entity_type FROM cache WHERE canonical_id = '{NS}Customer_4'")
def cache_lookup(spark, d):
    return stores.entry_of(fixtures.entity_cache_fx(spark, d), NS + "Customer_4").select("canonical_id", "qid", "entity_type")


@query("SELECT canonical_id, 'https://kg.example.org/entity/' || qid AS uri FROM cache")
def entity_uris(spark, d):
    return fixtures.entity_cache_fx(spark, d).select("canonical_id", ids.entity_uri(F.lit("https://kg.example.org/"), F.col("qid")).alias("uri"))


@query(f"SELECT qid, {sql.jlist('list_sort(list(canonical_id))')} AS canonical_ids FROM cache GROUP BY qid HAVING count(*) > 1 AND coalesce(qid, '') <> ''")
def duplicate_qids(spark, d):
    return validate.duplicate_qids(fixtures.entity_cache_fx(spark, d)).withColumn("canonical_ids", F.to_json("canonical_ids"))


@query("SELECT s, canonical_id FROM ent WHERE canonical_id NOT IN (SELECT canonical_id FROM cache)")
def cache_miss(spark, d):
    return planner(spark, d).cache_miss().select("s", "canonical_id")


@query("SELECT CAST(floor((row_number() OVER (ORDER BY is_thing DESC, s) - 1) / 50) AS BIGINT) AS batch, canonical_id FROM ent WHERE canonical_id NOT IN (SELECT canonical_id FROM cache)")
def lookup_batches(spark, d):
    return planner(spark, d).lookup_batches()


@query(f"SELECT qid FROM rem WHERE identity_value = '{NS}Part_11'")
def remote_identity_single(spark, d):
    found = fixtures.lookup_client().find_one("P17", NS + "Part_11")
    return spark.createDataFrame([(q,) for q in found], "qid string")


@query(f"SELECT identity_value, {sql.jlist('list_sort(list(qid))')} AS qids FROM rem WHERE identity_value IN (SELECT canonical_id FROM ent WHERE canonical_id NOT IN (SELECT canonical_id FROM cache)) GROUP BY identity_value")
def remote_identity_batch(spark, d):
    """One request for each batch, made on the executors."""
    found = remote_matches(planner(spark, d).lookup_batches(), fixtures.lookup_client, "P17")
    return found.groupBy("identity_value").agg(F.to_json(F.sort_array(F.collect_list("qid"))).alias("qids"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Q' || json_extract_string(props, '$.k') WHEN 1 THEN 'text ' || json_extract_string(props, '$.k') WHEN 2 THEN '+2024-01-01T00:00:00Z' ELSE json_extract_string(props, '$.k') END AS value FROM events", prelude=False)
def claim_values_of_events(spark, d):
    """Values in the shapes that a knowledge base gives them, made from the events' properties."""
    n, k = F.col("event_id") % 4, F.get_json_object("props", "$.k")
    j = F.when(n == 0, F.concat(F.lit('{"value":{"entity-type":"item","id":"Q'), k, F.lit('"}}'))).when(n == 1, F.concat(F.lit('{"value":{"language":"en","text":"text '), k, F.lit('"}}'))).when(n == 2, F.lit('{"value":{"time":"+2024-01-01T00:00:00Z","precision":11}}')).otherwise(F.concat(F.lit('{"value":"'), k, F.lit('"}')))
    return table(spark, d, "events").select("event_id", claim_values(j).alias("value"))


QUERIES["claim_values"], SQL["claim_values"] = QUERIES.pop("claim_values_of_events"), SQL.pop("claim_values_of_events")


@query("SELECT s, is_thing, canonical_id, coalesce(qid, '') AS qid, is_new, source, n_matches FROM res")
def resolve_entities(spark, d):
    return planner(spark, d).resolution.select("s", "is_thing", "canonical_id", F.coalesce("qid", F.lit("")).alias("qid"), "is_new", "source", "n_matches")


_PLAN = lambda frm: f"SELECT {', '.join(PLAN_COLUMNS)} FROM {frm}"


@query(_PLAN("rows_res WHERE action = 'CONFLICT'"))
def conflicts(spark, d):
    return planner(spark, d).resolved_rows().where("action = 'CONFLICT'")


@query(_PLAN("rows_res WHERE action = 'SKIP_UNCHANGED'"))
def unverified_items(spark, d):
    return planner(spark, d).unverified_rows()


@query(_PLAN("rows_label"))
def label_diff(spark, d):
    return planner(spark, d).label_rows()


@query(_PLAN("rows_description"))
def description_diff(spark, d):
    return planner(spark, d).description_rows()


@query(_PLAN("rows_alias"))
def alias_diff(spark, d):
    return planner(spark, d).alias_rows()


@query("SELECT s, is_thing, map_key, value_kind, value FROM ids")
def identity_statements(spark, d):
    return onto(spark, d).identity_statements.select("s", "is_thing", "map_key", "value_kind", "value")


@query("SELECT s, map_key, value, coalesce(pid, '') AS pid, coalesce(datatype, '') AS wikibase_datatype, has_entry FROM ms")
def statement_mapping(spark, d):
    return validate.mapped_statements(onto(spark, d), mapping(spark)).select("s", "map_key", "value", *(F.coalesce(c, F.lit("")).alias(c) for c in ("pid", "wikibase_datatype")), "has_entry")


@query("SELECT s, is_thing, map_key, value, known, target_new, coalesce(target_qid, '') AS target_qid FROM pt WHERE to_item")
def object_resolution(spark, d):
    return planner(spark, d).planned_statements.where("to_item").select("s", "is_thing", "map_key", "value", F.col("target_known").alias("known"), "target_new", F.coalesce("target_qid", F.lit("")).alias("target_qid"))


@query("SELECT s, is_thing, map_key, value, coalesce(cmp, '') AS comparable, outcome FROM po")
def statement_diff(spark, d):
    return planner(spark, d).compared_statements.select("s", "is_thing", "map_key", "value", F.coalesce(F.when(F.col("configured"), F.col("comparable")), F.lit("")).alias("comparable"), "outcome")


@query(_PLAN("rows_b"))
def plan_statements(spark, d):
    return planner(spark, d).pass_b()


@query(_PLAN("plan"))
def full_plan(spark, d):
    return planner(spark, d).plan().drop("datavalue")


@query(_PLAN("plan") + f" ORDER BY {', '.join(PLAN_COLUMNS)} LIMIT 20")
def plan_preview(spark, d):
    return plans.preview(planner(spark, d).plan())


@query("SELECT action, count(*) AS n FROM plan GROUP BY action")
def action_counts(spark, d):
    return plans.action_counts(planner(spark, d).plan())


@query("SELECT 'action' AS kind, action AS name, count(*) AS n FROM plan GROUP BY action UNION ALL SELECT 'severity', severity, count(*) FROM plan GROUP BY severity UNION ALL SELECT 'total', '', count(*) FROM plan")
def plan_summary(spark, d):
    return plans.plan_summary(planner(spark, d).plan())


@query(_PLAN("plan WHERE action IN ('CONFLICT', 'UNRESOLVED_OBJECT', 'ERROR', 'SKIP_UNMAPPED_PROPERTY')"))
def plan_attention(spark, d):
    return plans.attention(planner(spark, d).plan()).drop("datavalue")


# ---- execution

_STATES = "(SELECT 'run-' || o_custkey AS run_id, 'file-' || o_custkey % 7 AS f, 'config-' || o_custkey % 3 AS c, 'https://kg.example.org' AS u, CASE WHEN o_custkey % 2 = 0 THEN 'completed' ELSE 'completed_with_errors' END AS st FROM orders)"


@query(f"SELECT coalesce(max(run_id), 'run-new') AS run_id, count(*) > 0 AS resumed FROM {_STATES} WHERE f = 'file-3' AND c = 'config-1' AND u = 'https://kg.example.org' AND st <> 'completed'", prelude=False)
def state_resume(spark, d):
    k, lit = F.col("o_custkey"), F.lit
    states = table(spark, d, "orders").select(
        F.concat(lit("run-"), k).alias("run_id"), F.concat(lit("file-"), k % 7).alias("owl_file_hash"), F.concat(lit("config-"), k % 3).alias("config_hash"), lit("https://kg.example.org").alias("wikibase_url"),
        F.when(k % 2 == 0, "completed").otherwise("completed_with_errors").alias("completion_status"),
    )
    return stores.resume(states, "file-3", "config-1", "https://kg.example.org", "run-new")


@query("SELECT canonical_id, new_qid AS qid, entity_type, s AS source_identifier, label, '2024-02-01T00:00:00Z' AS last_synced_at FROM made")
def execute_creations(spark, d):
    return execution(spark, d).cache_entries("2024-02-01T00:00:00Z")


@query("SELECT source_identifier, action, split_part(property_name, '@', 1) AS field, substr(property_name, strpos(property_name, '@') + 1) AS lang, new_value FROM mrows")
def plan_metadata_apply(spark, d):
    return execution(spark, d).metadata_rows()


@query("SELECT source_identifier, coalesce(qid, '') AS qid, n_labels, n_descriptions, n_aliases FROM mup")
def execute_metadata(spark, d):
    return execution(spark, d).metadata_updates().select("source_identifier", F.coalesce("qid", F.lit("")).alias("qid"), *(F.size(c).cast("long").alias(f"n_{c}") for c in ("labels", "descriptions", "aliases")))


@query("SELECT source_identifier, property_name, coalesce(subject_qid, '') AS subject_qid, target_source_identifier, coalesce(target_qid, '') AS target_qid FROM bound")
def late_binding(spark, d):
    return execution(spark, d).bound.select("source_identifier", "property_name", F.coalesce("subject_qid", F.lit("")).alias("subject_qid"), "target_source_identifier", F.coalesce("target_qid", F.lit("")).alias("target_qid"))


@query("SELECT pid, property_name, status, count(*) AS n FROM bound GROUP BY pid, property_name, status")
def execute_statements(spark, d):
    return execution(spark, d).bound.groupBy("pid", "property_name", "status").agg(F.count("*").alias("n"))


_N = lambda where: f"(SELECT count(*) FROM plan WHERE {where})"


@query(
    "SELECT 'run-1' AS run_id, CASE WHEN (SELECT count(*) FROM bound WHERE status = 'error') + (SELECT count(*) FROM mup WHERE qid IS NULL) = 0 THEN 'completed' ELSE 'completed_with_errors' END AS status, (SELECT count(*) FROM made) AS items_created, (SELECT count(DISTINCT canonical_id) FROM res WHERE qid IS NOT NULL) AS items_reused, "
    "(SELECT CAST(coalesce(sum(n_labels), 0) AS BIGINT) FROM mup WHERE qid IS NOT NULL) AS labels_updated, (SELECT CAST(coalesce(sum(n_descriptions), 0) AS BIGINT) FROM mup WHERE qid IS NOT NULL) AS descriptions_updated, (SELECT CAST(coalesce(sum(n_aliases), 0) AS BIGINT) FROM mup WHERE qid IS NOT NULL) AS aliases_added, "
    "(SELECT count(*) FROM bound WHERE status = 'added') AS statements_added, " + _N("action = 'SKIP_UNCHANGED' AND pid <> ''") + " AS statements_skipped_unchanged, " + _N("action IN ('CONFLICT', 'UNRESOLVED_OBJECT')") + " AS unresolved_entities, "
    + _N("action = 'SKIP_UNMAPPED_PROPERTY'") + " AS unresolved_properties, (SELECT count(*) FROM bound WHERE status = 'unresolved_target') AS unresolved_targets, " + _N("action = 'CONFLICT'") + " AS conflicts, (SELECT count(*) FROM bound WHERE status = 'error') + (SELECT count(*) FROM mup WHERE qid IS NULL) AS errors"
)
def sync_result(spark, d):
    return execution(spark, d).result("run-1")


@query("SELECT canonical_id FROM ent WHERE canonical_id NOT IN (SELECT canonical_id FROM cache)")
def post_sync_missing_qid(spark, d):
    return validate.missing_qids(onto(spark, d).entities, fixtures.entity_cache_fx(spark, d))


@query("SELECT qid, canonical_id FROM cache WHERE qid NOT IN (SELECT qid FROM items)")
def post_sync_qid_not_live(spark, d):
    return validate.not_live(fixtures.entity_cache_fx(spark, d), fixtures.existing_items_fx(spark, d))


@query(sql.POST_FINDINGS)
def post_sync_findings(spark, d):
    p = planner(spark, d)
    return validate.post_sync_findings(p.onto.entities, p.existing.cache, p.plan(), p.existing.items)


