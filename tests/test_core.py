"""Operators on small graphs and values, without the relational tables."""

import json

import pytest
from pyspark.sql import functions as F

from kgsync import report
from kgsync.config import Config, Credentials, overridden, property_map
from kgsync.functions import identifiers as ids
from kgsync.functions import values
from kgsync.operators import validate
from kgsync.operators.numbering import numbered
from kgsync.operators.ontology import Ontology
from kgsync.plans.execute import DryRunError, Execution, guard, number_new_items
from kgsync.plans.plan import Existing, Planner, action_counts
from kgsync.sources import rdf, stores, triples
from kgsync.sources.remote import Client, RetryableError, claim_values, remote_matches
from kgsync.sources.triples import Predicates, TableSource
from kgsync.streaming import incremental
from kgsync.terms import ATTENTION, ENTITY_CACHE, LABEL, THING, TRIPLES

R = "http://rivers.example.net/o#"
SOURCE, OLD = "https://old.example.net/Ilm", "http://rivers.example.net/o#https://old.example.net/Ilm"
RIVERS = f"""
@prefix r: <{R}> . @prefix owl: <http://www.w3.org/2002/07/owl#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
r:Watercourse a owl:Class ; rdfs:label "watercourse"@en, "Gewässer"@de ; rdfs:subClassOf owl:Thing .
r:Brook a owl:Class ; rdfs:subClassOf r:Watercourse ; rdfs:comment "  a small one " .
r:flowsInto a owl:ObjectProperty ; rdfs:label "flows into" .
r:Elbe a owl:NamedIndividual, r:Watercourse ; rdfs:label "Elbe", "Alb" ; r:flowsInto r:NorthSea ; r:length "1094 km" ; r:named "0950" ;
  r:alias "Labe"@cs, "  Labe "@cs, "Albis"@la .
r:Saale a owl:NamedIndividual ; r:flowsInto r:Elbe ; r:page <HTTP://maps.example.net/Saale/>, "unknown" ; r:basin [ r:length "5" ] ; r:named "long ago" .
<{OLD}> a owl:NamedIndividual, r:Brook ; rdfs:label "Ilm"@xx ; r:flowsInto r:Saale .
r:Ilmbach a owl:NamedIndividual ; rdfs:label "Elbe" ; r:flowsInto <{SOURCE}> ; r:length "about nine" .
"""
PROPERTIES = [
    ("ontology_iri", "P1", "url", "identity"),
    ("rdf:type", "P2", "wikibase-item", None),
    ("rdfs:subClassOf", "P3", "wikibase-item", None),
    ("flowsInto", "P4", "wikibase-item", None),
    ("length", "P5", "quantity", None),
    ("named", "P6", "time", None),
    ("page", "P7", "url", None),
]
ALL = {THING, SOURCE, *(R + n for n in ("Watercourse", "Brook", "Elbe", "Saale", "Ilmbach"))}


@pytest.fixture(scope="module")
def onto(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("rdf") / "rivers.ttl"
    path.write_text(RIVERS, encoding="utf-8")
    return Ontology(rdf.load_ontology(spark, str(path)), Config())


def evaluate(spark, f, *given):
    df = spark.createDataFrame([(g,) for g in given], "x string")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def planner(spark, onto, cache=(), **existing):
    return Planner(onto, property_map(spark, PROPERTIES), Existing(spark.createDataFrame(list(cache), ENTITY_CACHE), **existing))


# ---- scalar functions

def test_identifiers(spark):
    inner = "http://a.org/x#http://b.org/Y_1"
    assert evaluate(spark, ids.normalize, " http://a.org/x#Y ", inner, "https://a/https://b/c", "https://a/https://b/http://c/d", "") == ["http://a.org/x#Y", "http://b.org/Y_1", "https://b/c", "http://c/d", ""]
    assert evaluate(spark, ids.local_name, "http://a.org/x#Y", "http://a.org/x/", "http://a.org/onto#", "plain", "///", "a#b#", "http://a/b#c/d") == ["Y", "x", "onto#", "plain", "///", "a#b#", "c/d"]
    assert evaluate(spark, ids.is_malformed, inner, "http://a.org") == [True, False]


def test_white_space(spark):
    assert evaluate(spark, ids.squeeze, "  hello  \n world\t") == ["hello world"]
    assert evaluate(spark, ids.strip, " \n a  b 　", " ", "") == ["a  b", "", ""]


def test_comparable_uri(spark):
    given = ["HTTP://Example.org/Path/", "http://Example.org/", "http://Example.org", "not a uri", "http://e.org/a?q=A#F", "http://e.org/a?#", "urn:ISBN:X/", "http://e.org//"]
    want = ["http://example.org/Path", "http://example.org/", "http://example.org", "not a uri", "http://e.org/a?q=A#F", "http://e.org/a", "urn:ISBN:X", "http://e.org/"]
    assert evaluate(spark, ids.comparable_uri, *given) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [("2023-05-17", "+2023-05-17T00:00:00Z"), ("2023", "+2023-00-00T00:00:00Z"), ("2023-07", "+2023-07-00T00:00:00Z"), ("-44", "-0044-00-00T00:00:00Z"), ("+7", "++007-00-00T00:00:00Z"), ("2023-13-45", "+2023-13-45T00:00:00Z"), ("2023-05-17T10:00", "+2023-05-17T00:00:00Z"), ("not a date", None), ("12345", "+12345-00-00T00:00:00Z")],
)
def test_time(spark, given, want):
    assert evaluate(spark, lambda x: values.to_time(x)["comparable_value"], given) == [want]


def test_quantity(spark):
    assert evaluate(spark, lambda x: values.to_quantity(x)["comparable_value"], "42.5 meters", "-3", "1,000", "1e5", "about 3") == ["+42.5|meters", "-3|1", "+1|,000", "+1|e5", None]


def test_convert_errors(spark):
    c = lambda kind, dt, qid=None: lambda x: values.convert(F.lit(kind), x, F.lit(dt), F.lit(None).cast("string"), F.lit(qid).cast("string"))["error"]
    assert evaluate(spark, c("literal", "wikibase-item"), "x")[0].startswith("datatype_mismatch: wikibase-item")
    assert evaluate(spark, c("resource", "wikibase-item"), "x") == ["unresolved_target_qid"]
    assert evaluate(spark, c("resource", "wikibase-item", "Q1\n"), "x") == [None]  # white space is squeezed first
    assert evaluate(spark, c("resource", "time"), "x")[0].endswith("'time'")
    assert evaluate(spark, c("literal", "url"), "not-a-uri") == ["not_a_uri:'not-a-uri'"]
    assert evaluate(spark, c("literal", "geo-shape"), "x") == ["unsupported_wikibase_datatype:geo-shape"]
    assert evaluate(spark, c("literal", "string"), "  ") == ["empty_string_value"]
    assert evaluate(spark, c("blank_node", "string"), "_:b") == [None]


def test_claim_values(spark):
    given = ['{"value":{"id":"Q5"}}', '{"value":{"text":"t","language":"en"}}', '{"value":{"time":"+2020"}}', '{"value":"plain"}']
    assert evaluate(spark, claim_values, *given) == ["Q5", "t", "+2020", "plain"]


# ---- entities

def test_entities(onto):
    found = {r.canonical_id: r for r in onto.nested().collect()}
    assert set(found) == ALL and len({r.content_hash for r in found.values()}) == len(ALL)
    elbe, brook, ilm = found[R + "Elbe"], found[R + "Brook"], found[SOURCE]
    assert (elbe.entity_type, elbe.labels, elbe.aliases) == ("NamedIndividual", {"en": "Alb"}, {"cs": ["Labe"], "la": ["Albis"]})
    assert (brook.entity_type, brook.labels, brook.descriptions) == ("OwlClass", {}, {"en": "a small one"})
    assert (ilm.original_id, ilm.labels, ilm.local_name) == (OLD, {"xx": "Ilm"}, "Ilm")
    assert found[R + "Watercourse"].labels == {"de": "Gewässer", "en": "watercourse"}
    kinds = {(s.predicate_local_name, s.value_kind) for s in found[R + "Saale"].statements}
    assert kinds == {("flowsInto", "resource"), ("page", "resource"), ("page", "literal"), ("basin", "blank_node"), ("named", "literal")}
    assert [(s.predicate_local_name, s.value) for s in ilm.statements if s.predicate_local_name != "type"] == [("flowsInto", R + "Saale")]


def test_no_thing_without_reference(spark):
    source = TableSource(spark.createDataFrame([("u:A", "iri", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://www.w3.org/2002/07/owl#Class", "iri", None, None)], TRIPLES))
    assert [r.canonical_id for r in Ontology(source).entities.collect()] == ["u:A"]


def test_empty_graph(spark):
    onto = Ontology(TableSource(spark.createDataFrame([], TRIPLES)))
    p = planner(spark, onto)
    assert p.plan().count() == 0
    assert onto.nested().count() == 0
    assert {r.severity: r.n for r in validate.summary(validate.all_findings(onto, p.mapping)).collect()} == {"INFO": 7, "WARNING": 0, "ERROR": 0, "BLOCKING": 0}


def test_findings(spark, onto):
    findings = validate.all_findings(onto, property_map(spark, PROPERTIES))
    found = {(r.check, r.source_identifier) for r in findings.collect()}
    expected = {
        ("unresolved_object", R + "Elbe"), ("malformed_uri", SOURCE), ("unsupported_language_tag", SOURCE), ("missing_label", R + "Brook"), ("missing_label", R + "Saale"),
        ("invalid_url_value", R + "Saale"), ("blank_node_statement", R + "Saale"), ("invalid_time_value", R + "Saale"), ("invalid_quantity_value", R + "Ilmbach"),
    }
    assert expected <= found
    assert not {c for c, _ in found} & {"duplicate_canonical_id", "missing_identifier"}
    rows = validate.preview(findings, 5).collect()
    assert len(rows) == 5 and [r.severity for r in rows] == sorted(r.severity for r in rows) and rows[0].severity == "ERROR"


# ---- plan

def test_plan_without_lookup(spark, onto):
    p = planner(spark, onto)
    n = {r.action: r.n for r in action_counts(p.plan()).collect()}
    # the sea; "unknown", "long ago" and "about nine"; the basin
    assert (n["CREATE_ITEM"], n["UNRESOLVED_OBJECT"], n["ERROR"], n["SKIP_UNMAPPED_PROPERTY"]) == (len(ALL), 1, 3, 1)
    assert (n["UPDATE_LABEL"], n["ADD_DESCRIPTION"], n["ADD_ALIAS"]) == (6, 1, 2) and "SKIP_UNCHANGED" not in n
    assert {r.severity for r in p.resolved_rows().collect()} == {"WARNING"}
    assert [r.action for r in action_counts(p.plan()).collect()] == sorted(n, key=lambda a: (-n[a], a))


def test_plan_with_lookup(spark, onto):
    elbe, saale, brook = R + "Elbe", R + "Saale", R + "Brook"
    matches = spark.createDataFrame([(saale, "Q20"), (brook, "Q30"), (brook, "Q31"), (elbe, "Q11")], "identity_value string, qid string")
    items = spark.createDataFrame([("Q10",)], "qid string")
    claims = spark.createDataFrame([("Q10", "P5", "+1094|km"), ("Q10", "P1", elbe.upper().replace("/O#ELBE", "/o#Elbe"))], "qid string, pid string, value string")
    metadata = spark.createDataFrame([("Q10", "label", "en", "Alb  "), ("Q10", "alias", "cs", " Labe")], "qid string, kind string, lang string, text string")
    p = planner(spark, onto, [(elbe, "Q10", *[None] * 5)], matches=matches, items=items, claims=claims, metadata=metadata)
    r = {x.canonical_id: (x.source, x.qid) for x in p.resolution.collect()}
    assert (r[elbe], r[saale], r[brook], r[THING]) == (("cache", "Q10"), ("wikibase_lookup", "Q20"), ("conflict", None), ("new", None))
    rows = {(x.action, x.source_identifier, x.property_name) for x in p.plan().collect()}
    assert {(a, n) for a, i, n in rows if i == elbe} == {
        ("SKIP_UNCHANGED", "length"), ("SKIP_UNCHANGED", "ontology_iri"), ("ADD_ALIAS", "alias@la"), ("ADD_STATEMENT", "named"), ("ADD_STATEMENT", "rdf:type"), ("UNRESOLVED_OBJECT", "flowsInto"),
    }
    assert ("SKIP_UNCHANGED", saale, "") in rows  # its item could not be read
    assert {a for a, i, _ in rows if i == brook} == {"CONFLICT"}
    assert ("UNRESOLVED_OBJECT", SOURCE, "rdf:type") in rows  # what it is is in conflict


def test_execution(spark, onto):
    e = Execution(planner(spark, onto), number_new_items(500))
    qids = {r.canonical_id: r.qid for r in e.qids.collect()}
    assert set(qids) == ALL and qids[THING] == "Q500" and set(qids.values()) == {f"Q{500 + i}" for i in range(len(ALL))}
    bound = {(r.source_identifier, r.property_name): json.loads(r.datavalue) for r in e.bound.collect()}
    assert bound[R + "Ilmbach", "flowsInto"]["value"] == {"entity-type": "item", "id": qids[SOURCE]}
    result = e.result("r").first()
    assert (result.status, result.items_created, result.labels_updated, result.statements_added) == ("completed", len(ALL), 0, len(bound))
    with pytest.raises(DryRunError):
        guard(Config())


def test_numbered(spark):
    got = numbered(spark.range(1000).selectExpr("id * 7 % 1000 as k"), "k").collect()
    assert sorted((r.k, r.n) for r in got) == [(i, i + 1) for i in range(1000)]


# ---- sources and stores

NT = '<u:a> <u:p> "x \\"y\\" \\u00e9\\n" .\n# comment\n\n_:b <u:p> <u:c> . # end\n<u:a> <u:q> "z"@en-GB .\n<u:a> <u:q> "5"^^<u:int> .\n<u:a> <u:q> "5"^^<u:int> .\nbroken\n'


def test_ntriples(spark, tmp_path):
    (tmp_path / "a.nt").write_text(NT, encoding="utf-8")
    got = {tuple(r) for r in rdf.load_ontology(spark, str(tmp_path / "a.nt")).triples.collect()}
    assert got == {("u:a", "iri", "u:p", 'x "y" é\n', "literal", None, None), ("b", "bnode", "u:p", "u:c", "iri", None, None), ("u:a", "iri", "u:q", "z", "literal", None, "en-GB"), ("u:a", "iri", "u:q", "5", "literal", "u:int", None)}


def test_the_graph_is_parsed_once(spark, onto, tmp_path):
    (tmp_path / "g.ttl").write_text(RIVERS, encoding="utf-8")
    source = rdf.load_ontology(spark, str(tmp_path / "g.ttl"), folder=str(tmp_path / "table"))
    (tmp_path / "g.ttl").unlink()
    assert source.scan().count() == onto.source.scan().count() and len(list((tmp_path / "table").glob("*.parquet"))) > 0
    plan = source.scan(Predicates((LABEL,)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p), EqualTo(p," in plan or "PushedFilters: [In(p," in plan


def test_samples_and_namespaces(spark, onto, tmp_path):
    assert [tuple(r) for r in triples.sample(onto.source, 3).collect()] == sorted((r.s, r.p, r.o) for r in onto.source.scan().collect())[:3]
    n = {r.namespace: r.n for r in triples.namespaces(onto.source).collect()}
    assert set(n) == {R, "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2000/01/rdf-schema#"} and sum(n.values()) == onto.source.scan().count()
    (tmp_path / "g.ttl").write_text(RIVERS, encoding="utf-8")
    (tmp_path / "g.rdf").write_text('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:z="u:z#"/>')
    (tmp_path / "g.json").write_text('{"@context": {"e": "http://e.org/", "t": "e:t"}, "@id": "e:a"}')
    found = {k: {r.prefix: r.namespace for r in rdf.declared_prefixes(spark, str(tmp_path / f), k).collect()} for f, k in (("g.ttl", "turtle"), ("g.rdf", "xml"), ("g.json", "json-ld"))}
    assert found["turtle"]["r"] == R and found["xml"]["z"] == "u:z#" and found["json-ld"] == {"e": "http://e.org/"}


XML = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:o="http://e.org/o#" xml:base="http://e.org/o" xml:lang="fr">
 <o:Lake rdf:ID="L1" o:depth="9"><o:name>Lac</o:name><o:near rdf:resource="#L2"/><o:area rdf:datatype="u:int">5</o:area>
  <o:shore rdf:parseType="Resource"><o:length>7</o:length></o:shore><o:fedBy><o:River rdf:nodeID="n"/></o:fedBy></o:Lake></rdf:RDF>"""
SAME = """@prefix o: <http://e.org/o#> . o:L1 a o:Lake ; o:depth "9"@fr ; o:name "Lac"@fr ; o:near o:L2 ; o:area "5"^^<u:int> ; o:shore [ o:length "7"@fr ] ; o:fedBy [ a o:River ] ."""


def test_xml_and_turtle_agree():
    plain = lambda rows: sorted(tuple("_" if k in (0, 3) and t[k + 1] == "bnode" else x or "" for k, x in enumerate(t)) for t in rows)
    assert plain(rdf.parse_xml(XML.encode())) == plain(rdf.parse_turtle(SAME.encode()))


def test_turtle_and_jsonld_agree():
    turtle = b'@prefix e: <http://e.org/> . @base <http://b.org/> . e:a a e:C ; e:p "v"@de , 5, true ; e:q <x>, [ e:r "w"^^e:t ] . # end\n'
    jsonld = json.dumps({"@context": {"e": "http://e.org/"}, "@id": "e:a", "@type": "e:C", "e:p": [{"@value": "v", "@language": "de"}, 5, True], "e:q": [{"@id": "http://b.org/x"}, {"e:r": {"@value": "w", "@type": "e:t"}}]}).encode()
    plain = lambda rows: sorted(tuple("_" if k in (0, 3) and t[k + 1] == "bnode" else x or "" for k, x in enumerate(t)) for t in rows)
    assert plain(rdf.parse_turtle(turtle)) == plain(rdf.parse_jsonld(jsonld))
    assert len(plain(rdf.parse_turtle(b"<u:a> <u:p> (1 2) ."))) == 5


def test_load_errors(spark, tmp_path):
    with pytest.raises(rdf.OntologyLoadError, match="no file"):
        rdf.load_ontology(spark, str(tmp_path / "none.owl"))
    (tmp_path / "empty.owl").write_text("")
    with pytest.raises(rdf.OntologyLoadError, match="empty"):
        rdf.load_ontology(spark, str(tmp_path / "empty.owl"))
    (tmp_path / "bad.owl").write_text("<<<")
    with pytest.raises(rdf.OntologyLoadError, match="can't be read"):
        rdf.load_ontology(spark, str(tmp_path / "bad.owl"))
    (tmp_path / "wrong.owl").write_text("<u:a> <u:p> <u:b> .")  # not what its ending says
    assert rdf.load_ontology(spark, str(tmp_path / "wrong.owl")).triples.count() == 1


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: incremental.stream_ntriples(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    (tmp_path / "in" / "1.nt").write_text(NT, encoding="utf-8")
    run()
    (tmp_path / "in" / "2.nt").write_text(NT + "<u:n> <u:p> <u:m> .\n", encoding="utf-8")
    run()
    assert incremental.source(spark, str(tmp_path / "t")).scan().count() == 5
    again = spark.read.text(str(tmp_path / "in")).where("value like '<u:n>%' or value like '_:b%'")
    incremental.append_new(rdf.ntriples(again), str(tmp_path / "t"))  # a batch that runs again
    assert incremental.source(spark, str(tmp_path / "t")).scan().count() == 5
    next((tmp_path / "t").glob("bucket=*/*.parquet")).write_bytes(b"damaged")
    with pytest.raises(Exception, match="(?i)parquet"):
        incremental.append_new(rdf.ntriples(spark.read.text(str(tmp_path / "in"))), str(tmp_path / "t"))


def test_cache_files(spark, tmp_path):
    path = tmp_path / "c.json"
    cache = spark.createDataFrame([("u:a", "Q1", "OwlClass", "u:a", "A", "h", "t"), ("u:b", "Q1", "OwlClass", "u:b", "B", "h", "t")], ENTITY_CACHE)
    stores.save_cache(cache, path, "https://kb", "now")
    again, meta = stores.load_cache(spark, path)
    assert (sorted(again.collect()), meta["wikibase_url"]) == (sorted(cache.collect()), "https://kb")
    assert [r.canonical_ids for r in validate.duplicate_qids(again).collect()] == [["u:a", "u:b"]]
    assert stores.backup(path).exists() and stores.backup(tmp_path / "none") is None
    path.write_text("{")
    assert stores.load_cache(spark, path)[0].count() == 0
    assert (tmp_path / "c.json.corrupt.0").exists()
    late = spark.createDataFrame([("u:a", "Q5", "OwlClass", "u:a", "A", "h", "t2")], ENTITY_CACHE)
    assert {r.canonical_id: r.qid for r in stores.upsert(cache, late).collect()} == {"u:a": "Q5", "u:b": "Q1"}


def test_caches_as_tables(spark, tmp_path, caplog):
    entries = spark.createDataFrame([(f"u:{i}", f"Q{i}", "OwlClass", f"u:{i}", "x", "h", "t") for i in range(50)], ENTITY_CACHE)
    for round_ in range(3):
        stores.save_cache(entries, tmp_path / "cache", "https://kb", str(round_))
        again, about = stores.load_cache(spark, tmp_path / "cache", "https://kb")
        assert (again.count(), about["last_updated"]) == (50, str(round_))
        entries = again
    assert len(list((tmp_path / "cache").glob("entities-*"))) == 2 and not caplog.records
    assert [r.qid for r in stores.entry_of(again, "u:7").collect()] == ["Q7"]
    stores.load_cache(spark, tmp_path / "cache", "https://other")
    assert "can't be trusted" in caplog.text


def test_entries_without_an_item_are_no_duplicates(spark):
    cache = spark.createDataFrame([("u:a", "", *[None] * 5), ("u:b", "", *[None] * 5), ("u:c", None, *[None] * 5), ("u:d", None, *[None] * 5), ("u:e", "Q1", *[None] * 5)], ENTITY_CACHE)
    assert validate.duplicate_qids(cache).count() == 0


INPUTS = {"owl_file_hash": "f", "config_hash": "c", "wikibase_url": "u"}


def test_run_log(tmp_path):
    path = tmp_path / "run.jsonl"
    first = stores.RunLog(path, "r1", "t0", **INPUTS)
    first.add("made", canonical_id="a", source_identifier="a", qid="Q1", is_thing=False)
    first.add("claim", digest=first.claim_digest("Q1", "P1", "{}"))
    first.add("failed", action="CREATE_ITEM", source_identifier="b", error="x")
    first.add("phase", name="creations")
    with path.open("a") as f:
        f.write('{"event": "made", "canon')  # cut short
    again = stores.RunLog(path, "r2", "t1", **INPUTS)
    assert again.resumed and again.run_id == "r1" and set(again.made) == {("a", False)} and again.claims == first.claims and again.phase == "creations"
    assert again.summary()["processed_entity_ids"] == ["a"] and again.summary()["failed_actions"] == first.failures
    again.add("ended", status="completed_with_errors")
    assert stores.RunLog(path, "r3", **INPUTS).run_id == "r1"
    other = stores.RunLog(path, "r4", **INPUTS | {"owl_file_hash": "other"})
    assert not other.resumed and other.run_id == "r4" and set(other.made) == {("a", False)} and not other.claims  # its items are there, whoever made them
    other.add("ended", status="completed")
    last = stores.RunLog(path, "r5", **INPUTS | {"owl_file_hash": "other"})
    assert not last.resumed and not last.made
    path.write_text("rubbish")
    assert not stores.RunLog(path, "r6", **INPUTS).made and (tmp_path / "run.jsonl.corrupt.0").exists()


class Broken(BaseException):
    """The process ends."""


def stub(breaks_at: int | None = None):
    """A knowledge base in memory that breaks off before its n-th write."""
    made, claims, writes = [], [], []

    def send(kind, payload):
        if kind in ("create", "claim"):
            if len(writes) == breaks_at:
                raise Broken
            writes.append(kind)
        if kind == "create":
            made.append(payload["labels"])
            return f"Q{1000 + len(made)}"
        if kind == "claim":
            claims.append((payload["qid"], payload["pid"], payload["datavalue"]))
        return None

    return send, made, claims


def test_a_broken_run_goes_on_where_it_was(spark, onto, tmp_path):
    from kgsync.plans.live import run_live

    config = Config(dry_run=False, sleep_time_seconds=0.0)
    cred = Credentials("https://kb", "https://kb/api")

    def run(folder, send):
        cache, _ = stores.load_cache(spark, folder / "cache.json")
        p = Planner(Ontology(onto.source, config), property_map(spark, PROPERTIES), Existing(cache))
        return run_live(p, Client(send, config, cred), folder / "cache.json", stores.RunLog(folder / "run.jsonl", "r", "t", **INPUTS), "2024-01-01")

    (tmp_path / "whole").mkdir()
    send, made, claims = stub()
    whole = run(tmp_path / "whole", send)
    assert whole["items_created"] == len(made) == len(ALL) and whole["status"] == "completed" and len(claims) == len(set(claims)) == whole["statements_added"]
    for k in (0, 3, len(ALL), len(ALL) + 5):
        folder = tmp_path / str(k)
        folder.mkdir()
        send, first, early = stub(k)
        with pytest.raises(Broken):
            run(folder, send)
        assert len(first) + len(early) == k
        send, second, late = stub()
        number = lambda out, n=len(first): f"Q{int(out[1:]) + n}" if out else out
        result = run(folder, lambda kind, payload, send=send, number=number: number(send(kind, payload)))
        items = first + second
        assert len(items) == len(ALL) and result["items_created"] == len(second)
        assert sorted(early + late) == sorted(claims)
        entries = {r.canonical_id: r.qid for r in stores.load_cache(spark, folder / "cache.json")[0].collect()}
        assert set(entries) == ALL and len(set(entries.values())) == len(ALL)
    stores.save_cache(spark.createDataFrame([], ENTITY_CACHE), tmp_path / "0" / "cache.json", "https://another", "t")
    with pytest.raises(ValueError, match="another"):
        run(tmp_path / "0", stub()[0])


def test_client():
    calls, naps = [], []

    def send(kind, payload):
        calls.append(kind)
        if len(calls) < 3:
            raise RetryableError("busy")
        return [{"value": {"value": "v"}, "item": {"value": "http://kb/entity/Q4"}}] * 2

    c = Client(send, Config(max_retries=5), Credentials(url="http://kb/"), naps.append)
    assert c.find("P1", ["v", 'w"']) == {"v": ["Q4", "Q4"]}
    assert (c.traffic(), naps) == ({"api_calls": 3, "retries": 2}, [0.5, 1.0])
    assert '"w\\""' in Client.lookup_query("http://kb/", "P1", ['w"']) and "<http://kb/prop/direct/P1>" in Client.lookup_query("http://kb/", "P1", [])
    with pytest.raises(DryRunError):
        c.create_item({}, {}, {})
    failing = Client(lambda *_: (_ for _ in ()).throw(ValueError("x")), Config(), None, naps.append)
    assert failing.find("P1", ["v"]) == {} and failing.snapshot("Q1") is None


def test_remote_matches_ask_once_a_batch(spark):
    from kgsync.sources import fixtures

    batches = spark.createDataFrame([(i // 4, f"{fixtures.NS}Part_{i}") for i in range(20)], "batch long, canonical_id string")
    found = {}
    for r in remote_matches(batches, fixtures.lookup_client, "P1").collect():
        found.setdefault(r.identity_value, []).append(r.qid)
    assert {k.rpartition("_")[2]: len(v) for k, v in found.items()} == {str(i): 1 if i % 5 == 0 else 2 for i in range(20) if i % 5 < 2}


def test_live_run_against_a_server(spark, onto, tmp_path):
    """The API of a knowledge base, on this machine: items are numbered, claims kept."""
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from urllib.parse import parse_qs

    from kgsync.plans.live import run_live
    from kgsync.sources.http import Transport

    items, claims, failed = {}, [], []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            q = {k: v[0] for k, v in parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode()).items()}
            if "query" in q:
                return self.reply({"results": {"bindings": []}})
            if q["action"] == "query":
                return self.reply({"query": {"tokens": {"logintoken": "L", "csrftoken": "C"}, "general": {}}})
            if q["action"] == "login":
                return self.reply({"login": {"result": "Success" if q["lgtoken"] == "L" else "Failed"}})
            if not failed:
                failed.append(1)
                self.send_response(503)
                self.end_headers()
                return None
            assert q["token"] == "C"
            if q["action"] == "wbeditentity":
                qid = q.get("id") or f"Q{len(items) + 1}"
                items.setdefault(qid, []).append(json.loads(q["data"]))
                return self.reply({"entity": {"id": qid}})
            claims.append((q["entity"], q["property"], json.loads(q["value"])))
            return self.reply({"success": 1})

        def reply(self, value):
            data = json.dumps(value).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        at = f"http://127.0.0.1:{server.server_port}"
        config = Config(dry_run=False, sleep_time_seconds=0.0, cache_dir=str(tmp_path))
        cred = Credentials(at, at + "/api", at + "/sparql", "bot", "secret")
        client = Client(Transport(cred, config), config, cred)
        status = client.connect(require_write=True)
        assert status.ready_for_live_writes and status.sparql and not status.errors
        live = Ontology(onto.source, config)
        done = stores.RunLog(tmp_path / "run.jsonl", "r", **INPUTS)
        result = run_live(planner(spark, live), client, tmp_path / "cache.json", done, "2024-01-01")
    finally:
        server.shutdown()
    assert (result["items_created"], result["status"], len(items), result["errors"]) == (len(ALL), "completed", len(ALL), 0)
    assert result["statements_added"] == len(claims) and result["retries"] == 1
    names = {i[0]["labels"][k]["value"]: q for q, i in items.items() for k in i[0]["labels"]}
    assert (names["Alb"], "P2", {"entity-type": "item", "id": names["watercourse"]}) in claims
    assert stores.load_cache(spark, tmp_path / "cache.json")[0].count() == len(ALL)
    with pytest.raises(DryRunError):
        run_live(planner(spark, onto), client, tmp_path / "x.json", done, "t")


def test_reports(spark, onto, tmp_path):
    p = planner(spark, onto)
    plan = p.plan()
    summary = report.save_plan(tmp_path, plan)
    assert summary["total_actions"] == sum(summary["action_counts"].values()) == len((tmp_path / "dry_run_plan.csv").read_text(encoding="utf-8").splitlines()) - 1
    findings = validate.all_findings(onto, p.mapping)
    assert set(report.save_findings(tmp_path, findings)) == {"INFO", "WARNING", "ERROR", "BLOCKING"}
    assert report.save_unresolved(tmp_path, plan) == sum(summary["action_counts"].get(a, 0) for a in ATTENTION) == 5
    assert json.loads((tmp_path / "dry_run_plan.json").read_text())["total_actions"] == summary["total_actions"]
    import hashlib

    (tmp_path / "f").write_bytes(b"abc")
    assert report.file_hash(spark, str(tmp_path / "f")) == hashlib.sha256(b"abc").hexdigest()


def test_config():
    a, b = Config(), Config(update_labels=False)
    assert a.config_hash() == Config(report_dir="x").config_hash() != b.config_hash()
    assert Credentials(password="x").describe_safe()["password"] == "<redacted>"
    assert overridden(a, {"batch_size": 7, "supported_languages": ["fr"]}) == Config(batch_size=7, supported_languages=("fr",))
    with pytest.raises(KeyError, match="bach_size"):
        overridden(a, {"bach_size": 7})
    assert Credentials("u", "a").has_read_endpoints and not Credentials("u", "a").is_complete and Credentials("u", "a").lacking("username", "url") == ["username"]


def test_folders(tmp_path):
    made = Config(cache_dir=str(tmp_path / "a"), report_dir=str(tmp_path / "b"), log_dir=str(tmp_path / "a")).folders()
    assert all(f.is_dir() for f in made) and len(made) == 3
