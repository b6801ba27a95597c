"""DuckDB SQL for the queries: written on its own, from the rules, not from the DataFrame plans."""

from __future__ import annotations

from ..sources.fixtures import BLANK_CLASS, CONSTANTS, EXT, NS, PROPERTY_ROWS, XSD_DATE
from ..terms import COMMENT, DC_DESCRIPTION, DCTERMS_DESCRIPTION, LABEL, META_TYPES, NOTHING, OWL, RDF_TYPE, SUB_CLASS_OF, THING

URI = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
FULL, MONTH, YEAR = r"^([+-]?[0-9]{1,9})-([0-9]{2})-([0-9]{2})(T.*)?$", r"^([+-]?[0-9]{1,9})-([0-9]{2})$", r"^[+-]?[0-9]{1,9}$"
QUANTITY = r"^([+-]?[0-9]+(?:\.[0-9]+)?)\s*(.*)$"


def q(text) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def norm(x: str) -> str:
    t = f"trim({x})"
    inner = lambda m: f"strpos(substr({t}, 2), '{m}')"
    return f"CASE WHEN {inner('http://')} > 0 THEN substr({t}, {inner('http://')} + 1) WHEN {inner('https://')} > 0 THEN substr({t}, {inner('https://')} + 1) ELSE {t} END"


def local(x: str) -> str:
    return f"(SELECT coalesce(nullif(CASE WHEN contains(v, '#') THEN regexp_extract(v, '[^#]*$') END, ''), nullif(CASE WHEN contains(v, '/') THEN regexp_extract(rtrim(v, '/'), '[^/]*$') END, ''), v) FROM (SELECT trim({x}) AS v))"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def uri(x: str) -> str:
    t = squeeze(x)
    g = lambda i: f"regexp_extract({t}, '{URI}', {i})"
    return (
        f"CASE WHEN NOT regexp_matches({t}, '{URI}') THEN {t} ELSE lower({g(1)}) || ':' || CASE WHEN {g(2)} = '//' THEN '' ELSE lower({g(2)}) END || "
        f"CASE WHEN length({g(3)}) > 1 AND ends_with({g(3)}, '/') THEN left({g(3)}, length({g(3)}) - 1) ELSE {g(3)} END || "
        f"CASE WHEN {g(4)} = '?' THEN '' ELSE {g(4)} END || CASE WHEN {g(5)} = '#' THEN '' ELSE {g(5)} END END"
    )


def time(x: str) -> str:
    t = squeeze(x)
    pad = lambda y, n: f"repeat('0', greatest(0, {n} - length({y}))) || {y}"
    signed = lambda y: f"CASE WHEN starts_with({y}, '-') THEN '-' || {pad(f'substr({y}, 2)', 4)} WHEN starts_with({y}, '+') THEN '++' || {pad(f'substr({y}, 2)', 3)} ELSE '+' || {pad(y, 4)} END"
    g = lambda r, i: f"regexp_extract({t}, '{r}', {i})"
    return (
        f"CASE WHEN regexp_matches({t}, '{FULL}') THEN {signed(g(FULL, 1))} || '-' || {g(FULL, 2)} || '-' || {g(FULL, 3)} || 'T00:00:00Z' "
        f"WHEN regexp_matches({t}, '{MONTH}') THEN {signed(g(MONTH, 1))} || '-' || {g(MONTH, 2)} || '-00T00:00:00Z' "
        f"WHEN regexp_matches({t}, '{YEAR}') THEN {signed(t)} || '-00-00T00:00:00Z' END"
    )


def precision(x: str) -> str:
    t = squeeze(x)
    return f"CASE WHEN regexp_matches({t}, '{FULL}') THEN 11 WHEN regexp_matches({t}, '{MONTH}') THEN 10 WHEN regexp_matches({t}, '{YEAR}') THEN 9 END"


def quantity(x: str) -> str:
    t = squeeze(x)
    a, u = f"regexp_extract({t}, '{QUANTITY}', 1)", f"trim(regexp_extract({t}, '{QUANTITY}', 2))"
    return f"CASE WHEN regexp_matches({t}, '{QUANTITY}') THEN CASE WHEN regexp_matches({a}, '^[+-]') THEN '' ELSE '+' END || {a} || '|' || CASE WHEN {u} = '' THEN '1' ELSE {u} END END"


def comparable(dt: str, x: str) -> str:
    return f"CASE WHEN {dt} = 'url' THEN {uri(x)} ELSE {squeeze(x)} END"


def converted(kind: str, x: str, dt: str, lang: str, qid: str) -> str:
    """The comparable value, null if there is none."""
    return (
        f"CASE WHEN {dt} = 'wikibase-item' THEN CASE WHEN {kind} = 'resource' AND regexp_matches(coalesce({qid}, ''), '^Q[0-9]+$') THEN {qid} END "
        f"WHEN {kind} = 'resource' AND {dt} NOT IN ('url', 'string', 'external-id') THEN NULL "
        f"WHEN {dt} IN ('string', 'external-id', 'commonsMedia') THEN nullif({squeeze(x)}, '') "
        rf"WHEN {dt} = 'url' THEN CASE WHEN regexp_matches({squeeze(x)}, '^[a-zA-Z][a-zA-Z0-9+.\-]*://') THEN {uri(x)} END "
        f"WHEN {dt} = 'monolingualtext' THEN coalesce({lang}, 'en') || ':' || nullif({squeeze(x)}, '') "
        f"WHEN {dt} = 'time' THEN {time(x)} WHEN {dt} = 'quantity' THEN {quantity(x)} END"
    )


def conversion_error(kind: str, x: str, dt: str, qid: str) -> str:
    t = squeeze(x)
    return (
        f"CASE WHEN {dt} = 'wikibase-item' AND {kind} <> 'resource' THEN 'datatype_mismatch: wikibase-item property received value_kind=''' || {kind} || '''' "
        f"WHEN {dt} = 'wikibase-item' AND coalesce({qid}, '') = '' THEN 'unresolved_target_qid' "
        f"WHEN {dt} = 'wikibase-item' THEN 'invalid_qid:''' || {qid} || '''' "
        f"WHEN {kind} = 'resource' AND {dt} NOT IN ('url', 'string', 'external-id') THEN 'datatype_mismatch: resource value cannot populate ''' || {dt} || '''' "
        f"WHEN {dt} IN ('string', 'external-id', 'commonsMedia') THEN 'empty_string_value' WHEN {dt} = 'url' THEN 'not_a_uri:''' || {t} || '''' "
        f"WHEN {dt} = 'monolingualtext' THEN 'empty_monolingualtext_value' WHEN {dt} = 'time' THEN 'unparseable_time_value:''' || {t} || '''' "
        f"WHEN {dt} = 'quantity' THEN 'unparseable_quantity_value:''' || {t} || '''' ELSE 'unsupported_wikibase_datatype:' || {dt} END"
    )


def _triples() -> str:
    out = []

    def add(table, s, p, o, kind="literal", lang="NULL", dt="NULL", where="true", s_kind="iri"):
        out.append(f"SELECT {s} AS s, '{s_kind}' AS s_kind, {q(p)} AS p, {o} AS o, '{kind}' AS o_kind, {dt} AS o_datatype, {lang} AS o_lang FROM {table} WHERE {where}")

    ns = lambda name, key: f"'{NS}{name}_' || {key}"
    is_a = lambda table, s, name: (add(table, s, RDF_TYPE, q(OWL + "NamedIndividual"), "iri"), add(table, s, RDF_TYPE, q(NS + name), "iri"))
    s = ns("Region", "r_regionkey")
    add("region", s, RDF_TYPE, q(OWL + "Class"), "iri")
    add("region", s, SUB_CLASS_OF, q(THING), "iri")
    add("region", s, LABEL, "r_name")
    nation = lambda k: f"CASE WHEN {k} % 10 = 3 THEN '{NS}{EXT}Nation_' ELSE '{NS}Nation_' END || {k}"
    s = nation("n_nationkey")
    add("nation", s, RDF_TYPE, q(OWL + "Class"), "iri")
    add("nation", s, SUB_CLASS_OF, ns("Region", "n_regionkey"), "iri")
    add("nation", s, LABEL, "n_name")
    add("nation", s, LABEL, "lower(n_name)", lang="'de'")
    add("nation", s, COMMENT, "'Nation ' || n_nationkey")
    add("nation", s, DC_DESCRIPTION, "'Description of nation ' || n_nationkey", where="n_nationkey % 5 = 0")
    s = ns("Customer", "c_custkey")
    is_a("customer", s, "Customer")
    add("customer", s, NS + "source", "c_mktsegment")
    add("customer", s, NS + "balance", "CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR)")
    add("customer", s, NS + "ext_id", "'C' || c_custkey")
    add("customer", s, LABEL, "c_name", where="c_custkey % 17 <> 0")
    add("customer", s, LABEL, "c_name", lang="'fr'", where="c_custkey % 11 = 0")
    s = ns("Supplier", "s_suppkey")
    is_a("supplier", s, "Supplier")
    add("supplier", s, LABEL, "s_name")
    add("supplier", s, NS + "hasNation", nation("s_nationkey"), "iri")
    add("supplier", s, NS + "homepage", "CASE WHEN s_suppkey % 3 = 0 THEN 'None' ELSE 'HTTP://Supplier' || s_suppkey || '.Example.org/Path/' END")
    add("supplier", s, NS + "hasPart", "'b' || s_suppkey", "bnode", where="s_suppkey % 10 = 0")
    add("supplier", s, NS + "hasPart", ns("Missing", "s_suppkey"), "iri", where="s_suppkey % 10 = 1")
    s = ns("Part", "p_partkey")
    is_a("part", s, "Part")
    add("part", s, LABEL, "p_name")
    add("part", s, NS + "aliase", "p_brand")
    add("part", s, NS + "aliase", "p_type")
    add("part", s, NS + "aliase", "'  ' || p_brand || ' '")
    add("part", s, NS + "size", "p_size || ' cm'")
    add("part", s, NS + "madeBy", ns("Supplier", "(p_partkey % 10)"), "iri")
    add("part", s, NS + "stock", "CAST(p_size AS VARCHAR)")
    s = ns("Order", "o_orderkey")
    is_a("orders", s, "Order")
    add("orders", s, LABEL, "'Order ' || o_orderkey")
    add("orders", s, NS + "hasCustomer", ns("Customer", "o_custkey"), "iri")
    add(
        "orders", s, NS + "orderDate", "CASE o_orderkey % 20 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN 'not a date' WHEN 3 THEN '-0044-03-15' ELSE strftime(o_orderdate, '%Y-%m-%d') END",
        dt=q(XSD_DATE),
    )
    add("orders", s, NS + "priority", "o_orderpriority")
    s = ns("Page", "page_id")
    is_a("pages", s, "Page")
    add("pages", s, NS + "wikidata_uri", "'None'", where="page_id % 13 = 0")
    add("pages", s, NS + "wikidata_uri", "url", where="page_id % 13 <> 0 AND page_id % 2 = 0")
    add("pages", s, NS + "wikidata_uri", "url", "iri", where="page_id % 13 <> 0 AND page_id % 2 = 1")
    s = ns("Document", "doc_id")
    is_a("documents", s, "Document")
    add("documents", s, LABEL, "'Document ' || doc_id", lang="lang")
    add("documents", s, COMMENT, "'Comment on ' || doc_id", lang="lang")
    add("documents", s, DCTERMS_DESCRIPTION, "'About document ' || doc_id", lang="lang")
    add("documents", s, NS + "source", "source")
    add("documents", s, NS + "flag", "'1'")
    for c in CONSTANTS:
        add("(SELECT 1)", q(c[0]), c[1], q(c[2]), c[3])
    add("(SELECT 1)", q(BLANK_CLASS[0]), BLANK_CLASS[1], q(BLANK_CLASS[2]), BLANK_CLASS[3], s_kind="bnode")
    return "\n  UNION ALL ".join(out)


def _list(values) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def _prelude() -> str:
    """Common table expressions; DuckDB leaves out those that a query does not use."""
    cls, ind = OWL + "Class", OWL + "NamedIndividual"
    alias = "lower(" + local(norm("p")) + ") IN ('aliase', 'alias', 'aliases')"
    rank = f"CASE p WHEN {q(COMMENT)} THEN 1 WHEN {q(DC_DESCRIPTION)} THEN 2 ELSE 3 END"
    parts = {
        "t": _triples(),
        "subj": f"SELECT s, {norm('s')} AS canonical_id, CASE WHEN bool_or(o = {q(cls)}) THEN 'OwlClass' ELSE 'NamedIndividual' END AS entity_type, {local(norm('s'))} AS local_name FROM t WHERE p = {q(RDF_TYPE)} AND s_kind = 'iri' AND o IN ({q(cls)}, {q(ind)}) GROUP BY s",
        "thing": f"SELECT {q(THING)} AS s, {q(THING)} AS canonical_id, 'OwlClass' AS entity_type, 'Thing' AS local_name WHERE EXISTS (SELECT 1 FROM t JOIN subj USING (s) WHERE p = {q(SUB_CLASS_OF)} AND o = {q(THING)})",
        "ent": "SELECT *, false AS is_thing FROM subj UNION ALL SELECT *, true FROM thing",
        "lv": "SELECT s, p, coalesce(nullif(o_lang, ''), 'en') AS lang, trim(o) AS text FROM t WHERE o_kind = 'literal' AND trim(o) <> ''",
        "lab": f"SELECT s, lang, min(text) AS text, false AS is_thing FROM lv WHERE p = {q(LABEL)} AND s IN (SELECT s FROM subj) GROUP BY s, lang UNION ALL SELECT s, 'en', 'Thing', true FROM thing",
        "dsc": f"SELECT s, lang, arg_min(text, ({rank}, text)) AS text, false AS is_thing FROM lv WHERE p IN {_list([COMMENT, DC_DESCRIPTION, DCTERMS_DESCRIPTION])} AND s IN (SELECT s FROM subj) GROUP BY s, lang",
        "ali": f"SELECT DISTINCT s, lang, {squeeze('text')} AS text, false AS is_thing FROM lv WHERE {alias} AND s IN (SELECT s FROM subj)",
        "disp": "SELECT e.*, coalesce(l.own, l.other, e.local_name) AS label FROM ent e LEFT JOIN (SELECT s, is_thing, max(CASE WHEN lang = 'en' THEN text END) AS own, arg_min(text, lang) AS other FROM lab GROUP BY s, is_thing) l ON l.s = e.s AND l.is_thing = e.is_thing",
        "st": f"SELECT s, {norm('s')} AS subject, p AS predicate_original, {local(norm('p'))} AS predicate_local_name, CASE o_kind WHEN 'literal' THEN 'literal' WHEN 'bnode' THEN 'blank_node' ELSE 'resource' END AS value_kind, "
        f"CASE o_kind WHEN 'literal' THEN trim(o) WHEN 'bnode' THEN '_:' || o ELSE {norm('o')} END AS value, CASE WHEN o_kind = 'literal' THEN nullif(o_datatype, '') END AS literal_datatype, CASE WHEN o_kind = 'literal' THEN nullif(o_lang, '') END AS language, "
        f"CASE WHEN p = {q(RDF_TYPE)} THEN 'rdf:type' WHEN p = {q(SUB_CLASS_OF)} THEN 'rdfs:subClassOf' ELSE {local(norm('p'))} END AS map_key FROM t "
        f"WHERE s IN (SELECT s FROM subj) AND p NOT IN {_list([LABEL, COMMENT, DC_DESCRIPTION, DCTERMS_DESCRIPTION])} AND NOT ({alias}) AND NOT (p = {q(RDF_TYPE)} AND o IN {_list(META_TYPES)}) AND NOT (p = {q(SUB_CLASS_OF)} AND o = {q(NOTHING)})",
        "pm": "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(q, r)) + ")" for r in PROPERTY_ROWS) + ") AS v(map_key, pid, datatype, role)",
        "usage": "SELECT map_key, count(*) AS n, list_sort(list(DISTINCT value_kind)) AS kinds, min(predicate_local_name) AS local_name, min(predicate_original) AS predicate FROM st GROUP BY map_key",
        "cache": f"SELECT '{NS}Customer_' || c_custkey AS canonical_id, 'Q' || (100000 + c_custkey) AS qid, 'NamedIndividual' AS entity_type FROM customer WHERE c_custkey % 4 = 0 "
        f"UNION ALL SELECT '{NS}Order_' || o_orderkey, 'Q' || (1000000 + o_orderkey), 'NamedIndividual' FROM orders WHERE o_orderkey % 3 = 0 "
        f"UNION ALL SELECT CASE WHEN n_nationkey % 10 = 3 THEN '{EXT}Nation_' ELSE '{NS}Nation_' END || n_nationkey, 'Q' || (100 + n_nationkey), 'OwlClass' FROM nation "
        f"UNION ALL SELECT '{NS}Region_' || r_regionkey, 'Q50', 'OwlClass' FROM region WHERE r_regionkey IN (0, 1)",
        "rem": f"SELECT '{NS}Part_' || p_partkey AS identity_value, 'Q' || (20000000 + p_partkey) AS qid FROM part WHERE p_partkey % 5 IN (0, 1) UNION ALL SELECT '{NS}Part_' || p_partkey, 'Q' || (30000000 + p_partkey) FROM part WHERE p_partkey % 5 = 1",
        "items": "SELECT 'Q' || (100000 + c_custkey) AS qid FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT 'Q' || (1000000 + o_orderkey) FROM orders WHERE o_orderkey % 3 = 0",
        "meta": "SELECT 'Q' || (100000 + c_custkey) AS qid, CASE WHEN c_custkey % 8 = 0 THEN '  ' || c_name || '  ' ELSE 'old ' || c_name END AS text FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT 'Q' || (1000000 + o_orderkey), 'Order ' || o_orderkey FROM orders WHERE o_orderkey % 3 = 0",
        "claims": "SELECT 'Q' || (1000000 + o_orderkey) AS qid, 'P9' AS pid, strftime(o_orderdate, '+%Y-%m-%dT00:00:00Z') AS value FROM orders WHERE o_orderkey % 6 = 0 "
        "UNION ALL SELECT 'Q' || (100000 + c_custkey), 'P3', '  ' || c_mktsegment || ' ' FROM customer WHERE c_custkey % 8 = 0 UNION ALL SELECT 'Q' || (100000 + c_custkey), 'P13', 'C' || c_custkey FROM customer WHERE c_custkey % 8 = 0",
        "rc": "SELECT identity_value, count(*) AS n, min(qid) AS qid FROM rem GROUP BY identity_value",
        "res0": "SELECT d.*, c.canonical_id IS NOT NULL AS cached, CASE WHEN c.canonical_id IS NOT NULL THEN 0 ELSE coalesce(r.n, 0) END AS n_matches, CASE WHEN c.canonical_id IS NOT NULL THEN c.qid WHEN r.n = 1 THEN r.qid END AS qid FROM disp d LEFT JOIN cache c ON c.canonical_id = d.canonical_id LEFT JOIN rc r ON r.identity_value = d.canonical_id",
        "res": "SELECT *, qid IS NULL AND n_matches <= 1 AS is_new, CASE WHEN n_matches > 1 THEN 'conflict' WHEN qid IS NULL THEN 'new' WHEN cached THEN 'cache' ELSE 'wikibase_lookup' END AS source FROM res0",
        "live": "SELECT *, CASE WHEN is_new THEN '<NEW_ITEM>' ELSE qid END AS shown FROM res WHERE source <> 'conflict'",
        "unv": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY is_thing DESC, s) AS k FROM res WHERE qid IS NOT NULL AND qid NOT IN (SELECT qid FROM items)) WHERE k = 1",
        "ids": f"SELECT s, is_thing, 'ontology_iri' AS map_key, 'literal' AS value_kind, canonical_id AS value FROM ent",
        "ws": "SELECT s, false AS is_thing, map_key, value_kind, value, literal_datatype, language FROM st UNION ALL SELECT s, is_thing, map_key, value_kind, value, NULL, NULL FROM ids",
        "ps": "SELECT w.map_key, w.value_kind, w.value, w.literal_datatype, w.language, l.s, l.is_thing, l.canonical_id, l.entity_type, l.label, l.qid, l.is_new, l.shown, p.pid, p.datatype, p.pid IS NOT NULL AND p.datatype IS NOT NULL AS configured, "
        "p.pid IS NOT NULL AND p.datatype = 'wikibase-item' AND w.value_kind = 'resource' AS to_item FROM ws w JOIN live l ON l.s = w.s AND l.is_thing = w.is_thing LEFT JOIN pm p ON p.map_key = w.map_key",
        "tgt": "SELECT DISTINCT canonical_id, qid, is_new FROM live",
        "pt": "SELECT p.*, g.canonical_id IS NOT NULL AS known, coalesce(g.is_new, false) AS target_new, g.qid AS target_qid FROM ps p LEFT JOIN tgt g ON p.to_item AND g.canonical_id = p.value",
        "pc": f"SELECT *, CASE WHEN target_new THEN '<NEW_ITEM>' WHEN configured THEN {converted('value_kind', 'value', 'datatype', 'language', 'target_qid')} END AS cmp FROM pt",
        "have": f"SELECT DISTINCT c.qid, p.map_key, {comparable('p.datatype', 'c.value')} AS cmp FROM claims c JOIN pm p ON p.pid = c.pid JOIN items i ON i.qid = c.qid",
        "po": "SELECT c.*, CASE WHEN NOT configured THEN 'SKIP_UNMAPPED_PROPERTY' WHEN to_item AND NOT known THEN 'UNRESOLVED_OBJECT' WHEN c.cmp IS NULL THEN 'ERROR' WHEN is_new OR target_new OR h.qid IS NULL THEN 'ADD_STATEMENT' ELSE 'SKIP_UNCHANGED' END AS outcome "
        "FROM pc c LEFT JOIN have h ON h.qid = c.qid AND h.map_key = c.map_key AND h.cmp = c.cmp",
        "rows_b": "SELECT outcome AS action, entity_type, canonical_id AS source_identifier, shown AS qid, label, CASE WHEN outcome = 'SKIP_UNMAPPED_PROPERTY' THEN '' ELSE pid END AS pid, map_key AS property_name, '' AS old_value, "
        "CASE WHEN outcome IN ('ADD_STATEMENT', 'SKIP_UNCHANGED') THEN cmp ELSE value END AS new_value, CASE outcome WHEN 'SKIP_UNMAPPED_PROPERTY' THEN 'predicate ''' || map_key || ''' has no configured PID/datatype in PROPERTY_MAP' "
        "WHEN 'UNRESOLVED_OBJECT' THEN 'object ''' || value || ''' did not resolve to a known/plannable Wikibase item' "
        f"WHEN 'ERROR' THEN 'conversion failed: ' || {conversion_error('value_kind', 'value', 'datatype', 'target_qid')} "
        "WHEN 'SKIP_UNCHANGED' THEN 'statement already present with the same value' ELSE CASE WHEN is_new THEN 'new item' ELSE 'statement not present on existing item' END END AS reason, "
        "CASE outcome WHEN 'SKIP_UNMAPPED_PROPERTY' THEN 'WARNING' WHEN 'UNRESOLVED_OBJECT' THEN 'WARNING' WHEN 'ERROR' THEN 'ERROR' ELSE 'INFO' END AS severity, "
        "CASE WHEN outcome IN ('ADD_STATEMENT', 'SKIP_UNCHANGED') AND to_item THEN value ELSE '' END AS target_source_identifier, CASE WHEN outcome IN ('ADD_STATEMENT', 'SKIP_UNCHANGED') THEN coalesce(literal_datatype, '') ELSE '' END AS literal_datatype, "
        "CASE WHEN outcome IN ('ADD_STATEMENT', 'SKIP_UNCHANGED') THEN coalesce(language, '') ELSE '' END AS language FROM po",
        "rows_label": "SELECT 'UPDATE_LABEL' AS action, l.entity_type, l.canonical_id AS source_identifier, l.shown AS qid, l.label, '' AS pid, 'label@' || v.lang AS property_name, coalesce(m.text, '') AS old_value, v.text AS new_value, CASE WHEN m.text IS NULL THEN 'label missing for this language' ELSE 'label differs from OWL source' END AS reason, 'INFO' AS severity, '' AS target_source_identifier, '' AS literal_datatype, '' AS language "
        f"FROM lab v JOIN live l ON l.s = v.s AND l.is_thing = v.is_thing LEFT JOIN meta m ON m.qid = l.qid AND v.lang = 'en' WHERE m.text IS NULL OR {squeeze('m.text')} <> {squeeze('v.text')}",
        "rows_description": "SELECT 'ADD_DESCRIPTION' AS action, l.entity_type, l.canonical_id AS source_identifier, l.shown AS qid, l.label, '' AS pid, 'description@' || v.lang AS property_name, '' AS old_value, v.text AS new_value, 'description missing for this language' AS reason, 'INFO' AS severity, '' AS target_source_identifier, '' AS literal_datatype, '' AS language FROM dsc v JOIN live l ON l.s = v.s AND l.is_thing = v.is_thing",
        "rows_alias": "SELECT 'ADD_ALIAS' AS action, l.entity_type, l.canonical_id AS source_identifier, l.shown AS qid, l.label, '' AS pid, 'alias@' || v.lang AS property_name, '' AS old_value, v.text AS new_value, 'alias not present on existing item' AS reason, 'INFO' AS severity, '' AS target_source_identifier, '' AS literal_datatype, '' AS language FROM ali v JOIN live l ON l.s = v.s AND l.is_thing = v.is_thing",
        "rows_res": "SELECT 'CONFLICT' AS action, entity_type, canonical_id AS source_identifier, '' AS qid, label, '' AS pid, '' AS property_name, '' AS old_value, '' AS new_value, n_matches || ' Wikibase items already have identity value ''' || canonical_id || '''' AS reason, 'BLOCKING' AS severity, '' AS target_source_identifier, '' AS literal_datatype, '' AS language FROM res WHERE source = 'conflict' "
        "UNION ALL SELECT 'CREATE_ITEM', entity_type, canonical_id, '<NEW_ITEM>', label, '', '', '', '', 'no existing Wikibase item found', 'INFO', '', '', '' FROM res WHERE is_new "
        "UNION ALL SELECT 'SKIP_UNCHANGED', entity_type, canonical_id, qid, label, '', '', '', '', 'existing item state could not be verified (no Wikibase connection); metadata/statement changes cannot be safely diffed this run', 'WARNING', '', '', '' FROM unv",
        "plan": "SELECT * FROM rows_res UNION ALL SELECT * FROM rows_label UNION ALL SELECT * FROM rows_description UNION ALL SELECT * FROM rows_alias UNION ALL SELECT * FROM rows_b",
        "made": "SELECT *, 'Q' || (90000000 + row_number() OVER (ORDER BY is_thing DESC, s) - 1) AS new_qid, row_number() OVER (ORDER BY is_thing DESC, s) AS n FROM res WHERE is_new",
        "qids": "SELECT DISTINCT canonical_id, qid FROM res WHERE qid IS NOT NULL UNION ALL SELECT canonical_id, arg_max(new_qid, n) FROM made GROUP BY canonical_id",
        "mrows": "SELECT * FROM (SELECT * FROM rows_label UNION ALL SELECT * FROM rows_description UNION ALL SELECT * FROM rows_alias) WHERE source_identifier NOT IN (SELECT canonical_id FROM made)",
        "mup": "SELECT m.source_identifier, q.qid, count(DISTINCT CASE WHEN action = 'UPDATE_LABEL' THEN property_name END) AS n_labels, count(DISTINCT CASE WHEN action LIKE '%DESCRIPTION' THEN property_name END) AS n_descriptions, count(*) FILTER (WHERE action = 'ADD_ALIAS') AS n_aliases FROM mrows m LEFT JOIN qids q ON q.canonical_id = m.source_identifier GROUP BY m.source_identifier, q.qid",
        "bound": "SELECT r.source_identifier, a.qid AS subject_qid, r.pid, r.property_name, r.target_source_identifier, b.qid AS target_qid, CASE WHEN a.qid IS NULL THEN 'error' WHEN r.target_source_identifier <> '' AND b.qid IS NULL THEN 'unresolved_target' ELSE 'added' END AS status "
        "FROM rows_b r LEFT JOIN qids a ON a.canonical_id = r.source_identifier LEFT JOIN qids b ON r.target_source_identifier <> '' AND b.canonical_id = r.target_source_identifier WHERE r.action = 'ADD_STATEMENT'",
        "used": "SELECT coalesce(u.map_key, p.map_key) AS k, u.n, u.kinds, u.map_key IS NOT NULL AS used, p.map_key IS NOT NULL AS configured, p.pid, p.datatype FROM usage u FULL JOIN pm p ON p.map_key = u.map_key",
        "dup_pid": "SELECT pid, list_sort(list(map_key)) AS keys FROM pm WHERE pid IS NOT NULL GROUP BY pid HAVING count(*) > 1",
        "ms": "SELECT s.*, p.pid, p.datatype, p.map_key IS NOT NULL AS has_entry FROM st s LEFT JOIN pm p ON p.map_key = s.map_key",
    }
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n"


PRELUDE = _prelude()

_JSON_LIST = "'[' || array_to_string(list_transform({x}, lambda v: '\"' || v || '\"'), ',') || ']'"


def jlist(x: str) -> str:
    return _JSON_LIST.format(x=x)


def _f(check: str, severity: str, message: str, source: str, frm: str, details: str = "'{}'") -> str:
    return f"SELECT '{check}' AS \"check\", '{severity}' AS severity, {message} AS message, {source} AS source_identifier, {details} AS details FROM {frm}"


MAPPING_FINDINGS = "\nUNION ALL ".join(
    [
        _f("unmapped_predicate", "WARNING", "'Predicate ''' || k || ''' is used ' || n || ' time(s) in the OWL file but has no PROPERTY_MAP entry.'", "k", "used WHERE used AND NOT configured", f"'{{\"count\":' || n || ',\"value_kinds\":' || {jlist('kinds')} || '}}'"),
        _f("unused_property_mapping", "INFO", "'PROPERTY_MAP entry ''' || k || ''' is configured but not used by any statement in the OWL file.'", "k", "used WHERE configured AND NOT used"),
        _f("missing_pid", "ERROR", "'Predicate ''' || k || ''' is used in the OWL file but PROPERTY_MAP[''' || k || '''][''pid''] is None.'", "k", "used WHERE configured AND used AND pid IS NULL"),
        _f("missing_datatype", "ERROR", "'PROPERTY_MAP[''' || k || '''] has no wikibase_datatype configured.'", "k", "used WHERE configured AND used AND datatype IS NULL"),
        _f("incompatible_datatype", "ERROR", "'Predicate ''' || k || ''' has resource-valued statements in the OWL file, but is mapped to wikibase_datatype=''' || datatype || ''', which cannot represent a resource reference.'", "k", "used WHERE configured AND used AND list_contains(kinds, 'resource') AND datatype NOT IN ('wikibase-item', 'url', 'string', 'external-id')"),
        _f("incompatible_datatype", "ERROR", "'Predicate ''' || k || ''' only has literal-valued statements in the OWL file, but is mapped to wikibase_datatype=''wikibase-item''.'", "k", "used WHERE configured AND used AND kinds = ['literal'] AND datatype = 'wikibase-item'"),
        _f("blank_node_statement", "WARNING", "'Predicate ''' || k || ''' has blank-node-valued statements, which cannot become Wikibase items.'", "k", "used WHERE configured AND used AND list_contains(kinds, 'blank_node') AND datatype IS NOT NULL"),
        _f("duplicate_pid_assignment", "BLOCKING", "'PID ' || pid || ' is assigned to multiple PROPERTY_MAP entries: ' || array_to_string(keys, ', ') || '.'", "''", "dup_pid", f"'{{\"pid\":\"' || pid || '\",\"keys\":' || {jlist('keys')} || '}}'"),
    ]
)

_WELL = r"regexp_matches(value, '^[a-zA-Z][a-zA-Z0-9+.\-]*://\S+$')"
_ON = "'Entity ''' || subject || '''"
QUALITY_FINDINGS = "\nUNION ALL ".join(
    [
        _f("duplicate_canonical_id", "BLOCKING", "'Canonical id ''' || canonical_id || ''' resolves to ' || count(*) || ' distinct OWL resources.'", "canonical_id", "ent GROUP BY canonical_id HAVING count(*) > 1"),
        _f("malformed_uri", "INFO", "'Original identifier ''' || s || ''' embeds more than one absolute URI; normalized to ''' || canonical_id || '''.'", "canonical_id", "ent WHERE len(regexp_extract_all(s, 'https?://')) > 1"),
        _f("missing_label", "WARNING", "'Entity ''' || canonical_id || ''' has no rdfs:label in any language.'", "canonical_id", "ent WHERE NOT is_thing AND s NOT IN (SELECT s FROM lab WHERE NOT is_thing)"),
        _f("unsupported_language_tag", "INFO", "'Entity ''' || e.canonical_id || ''' has a label in language ''' || l.lang || ''', which is not in SUPPORTED_LANGUAGES.'", "e.canonical_id", "lab l JOIN ent e ON e.s = l.s AND e.is_thing = l.is_thing WHERE l.lang NOT IN ('en', 'de')"),
        _f("duplicate_label", "INFO", "'Label ''' || text || ''' (' || lang || ') is used by ' || count(*) || ' different entities.'", "''", "lab GROUP BY lang, text HAVING count(*) > 1", "'{\"language\":\"' || lang || '\",\"label\":\"' || text || '\",\"count\":' || count(*) || '}'"),
        _f("blank_node_statement", "WARNING", _ON + " has a blank-node value for predicate ''' || map_key || '''.'", "subject", "ms WHERE value_kind = 'blank_node'"),
        _f("unresolved_object", "WARNING", _ON + " has a resource-valued statement on ''' || map_key || ''' pointing to ''' || value || ''', which is not among the parsed classes/individuals.'", "subject", "ms WHERE value_kind = 'resource' AND datatype = 'wikibase-item' AND value NOT IN (SELECT canonical_id FROM ent)", "'{\"predicate\":\"' || map_key || '\",\"object\":\"' || value || '\"}'"),
        _f("malformed_uri", "WARNING", "'Resource value ''' || value || ''' for predicate ''' || map_key || ''' is not a well-formed URI.'", "subject", f"ms WHERE value_kind = 'resource' AND NOT {_WELL}"),
        _f("invalid_url_value", "WARNING", "'Value ''' || value || ''' for predicate ''' || map_key || ''' is not a well-formed URL and will be reported as an ERROR in the synchronization plan rather than written to Wikibase (commonly a placeholder like ''None'' left by the authoring tool when no value was set).'", "subject", f"ms WHERE value_kind = 'literal' AND datatype = 'url' AND NOT {_WELL}", "'{\"predicate\":\"' || map_key || '\",\"value\":\"' || value || '\"}'"),
        _f("predicate_without_mapping", "WARNING", _ON + " uses predicate ''' || map_key || ''', which has no PROPERTY_MAP entry.'", "subject", "ms WHERE value_kind <> 'blank_node' AND NOT has_entry", "'{\"predicate\":\"' || map_key || '\"}'"),
        _f("invalid_time_value", "ERROR", "'Value ''' || value || ''' for predicate ''' || map_key || ''' cannot be parsed as a time.'", "subject", "ms WHERE value_kind = 'literal' AND datatype = 'time' AND NOT regexp_matches(value, '^[+-]?[0-9]{1,9}')"),
        _f("invalid_quantity_value", "ERROR", "'Value ''' || value || ''' for predicate ''' || map_key || ''' cannot be parsed as a quantity.'", "subject", "ms WHERE value_kind = 'literal' AND datatype = 'quantity' AND NOT regexp_matches(value, '^[+-]?[0-9]+')"),
    ]
)
POST_FINDINGS = "\nUNION ALL ".join(
    [
        _f("missing_qid_after_sync", "ERROR", "'Entity ''' || canonical_id || ''' has no QID in the cache after synchronization.'", "canonical_id", "ent WHERE canonical_id NOT IN (SELECT canonical_id FROM cache)"),
        _f("duplicate_qid_mapping", "BLOCKING", "'QID ' || qid || ' is mapped from ' || count(*) || ' different canonical ids.'", "''", "cache GROUP BY qid HAVING count(*) > 1", f"'{{\"qid\":\"' || qid || '\",\"canonical_ids\":' || {jlist('list_sort(list(canonical_id))')} || '}}'"),
        _f("cached_qid_not_found_live", "ERROR", "'Cached QID ' || qid || ' for ''' || canonical_id || ''' could not be found on Wikibase.'", "canonical_id", "cache WHERE qid NOT IN (SELECT qid FROM items)"),
        "SELECT 'unresolved_action_' || lower(action), CASE action WHEN 'CONFLICT' THEN 'BLOCKING' WHEN 'ERROR' THEN 'ERROR' ELSE 'WARNING' END, action || ': ' || reason, source_identifier, '{}' FROM plan WHERE action IN ('CONFLICT', 'UNRESOLVED_OBJECT', 'ERROR', 'SKIP_UNMAPPED_PROPERTY')",
    ]
)
