"""A graph, a property map, a cache and a knowledge base made from the relational test tables by rule.

The rules give distinct triples: no two of a relation share subject, predicate and value, and relations
have subjects of their own. So the graph needs no `distinct`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Credentials
from ..terms import COMMENT, DC_DESCRIPTION, DCTERMS_DESCRIPTION, LABEL, NOTHING, OWL, PROPERTY_MAP, RDF_TYPE, SUB_CLASS_OF, THING, TRIPLES
from ..written import new_folder
from .remote import Client
from .triples import MappedSource, Rule

NS, EXT = "http://kg.example.org/onto#", "http://purl.example.org/item/"
XSD_DATE = "http://www.w3.org/2001/XMLSchema#date"

CONSTANTS = (
    [(NS + n, RDF_TYPE, OWL + t, "iri") for t, names in {"ObjectProperty": "hasPart hasNation hasCustomer madeBy", "DatatypeProperty": "size balance orderDate", "AnnotationProperty": "source aliase"}.items() for n in names.split()]
    + [(NS + n, LABEL, f"label of {n}", "literal") for n in "hasPart hasNation hasCustomer madeBy size balance orderDate aliase".split()]
    + [t for n in "Customer Supplier Part Order Page Document".split() for t in ((NS + n, RDF_TYPE, OWL + "Class", "iri"), (NS + n, SUB_CLASS_OF, THING, "iri"), (NS + n, LABEL, n, "literal"))]
    + [(NS + "Void", RDF_TYPE, OWL + "Class", "iri"), (NS + "Void", SUB_CLASS_OF, NOTHING, "iri")]
    + [t for s in (EXT + "Twin", NS + EXT + "Twin") for t in ((s, RDF_TYPE, OWL + "Class", "iri"), (s, LABEL, "Twin", "literal"))]
)
BLANK_CLASS = ("anon", RDF_TYPE, OWL + "Class", "iri")

PROPERTY_ROWS = [
    ("rdf:type", "P1", "wikibase-item", "instance_of"),
    ("rdfs:subClassOf", "P2", "wikibase-item", "subclass_of"),
    ("source", "P3", "string", None),
    ("hasPart", "P4", "wikibase-item", None),
    ("ontology_iri", "P5", "url", "identity"),
    ("wikidata_uri", "P6", "url", None),
    ("hasNation", "P7", "wikibase-item", None),
    ("hasCustomer", "P8", "wikibase-item", None),
    ("orderDate", "P9", "time", None),
    ("balance", "P10", "quantity", None),
    ("size", "P11", "quantity", None),
    ("homepage", "P12", "url", None),
    ("ext_id", "P13", "external-id", None),
    ("shadow", "P13", "string", None),
    ("madeBy", "P15", "quantity", None),
    ("stock", None, "string", None),
    ("flag", "P14", None, None),
    ("hasInterchangeFormat", None, "wikibase-item", None),
]


def text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def nation_iri(k: Column) -> Column:
    return F.when(k % 10 == 3, text(NS + EXT + "Nation_", k)).otherwise(text(NS + "Nation_", k))


def order_date(k: Column, day: Column) -> Column:
    fmt = lambda f: F.date_format(day, f)
    return F.when(k % 20 == 0, fmt("yyyy")).when(k % 20 == 1, fmt("yyyy-MM")).when(k % 20 == 2, "not a date").when(k % 20 == 3, "-0044-03-15").otherwise(fmt("yyyy-MM-dd"))


def graph(spark: SparkSession, sf_dir: str) -> MappedSource:
    read = lambda name: lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    c = F.col
    kind = lambda s, t: Rule(s, RDF_TYPE, F.lit(OWL + t), "iri")
    label = lambda s, v, **k: Rule(s, LABEL, v, **k)
    is_a = lambda s, n: [kind(s, "NamedIndividual"), Rule(s, RDF_TYPE, F.lit(NS + n), "iri")]
    has = lambda s, n, v, **k: Rule(s, NS + n, v, **k)
    key = lambda n: {"Nation": "n_nationkey", "Customer": "c_custkey", "Supplier": "s_suppkey", "Part": "p_partkey", "Order": "o_orderkey", "Page": "page_id", "Document": "doc_id", "Region": "r_regionkey"}[n]
    me = lambda n: text(NS + n + "_", c(key(n)))
    nation, k = nation_iri(c("n_nationkey")), c
    constant = lambda: spark.createDataFrame([(*t, "iri") for t in CONSTANTS] + [(*BLANK_CLASS, "bnode")], "s string, p string, o string, o_kind string, s_kind string")
    rules = [
        (read("region"), [kind(me("Region"), "Class"), Rule(me("Region"), SUB_CLASS_OF, F.lit(THING), "iri"), label(me("Region"), c("r_name"))]),
        (
            read("nation"),
            [
                kind(nation, "Class"),
                Rule(nation, SUB_CLASS_OF, text(NS + "Region_", c("n_regionkey")), "iri"),
                label(nation, c("n_name")),
                label(nation, F.lower("n_name"), lang=F.lit("de")),
                Rule(nation, COMMENT, text("Nation ", c("n_nationkey"))),
                Rule(nation, DC_DESCRIPTION, text("Description of nation ", c("n_nationkey")), where=c("n_nationkey") % 5 == 0),
            ],
        ),
        (
            read("customer"),
            [
                *is_a(me("Customer"), "Customer"),
                has(me("Customer"), "source", c("c_mktsegment")),
                has(me("Customer"), "balance", c("c_acctbal").cast("decimal(15,2)").cast("string")),
                has(me("Customer"), "ext_id", text("C", k("c_custkey"))),
                label(me("Customer"), c("c_name"), where=k("c_custkey") % 17 != 0),
                label(me("Customer"), c("c_name"), lang=F.lit("fr"), where=k("c_custkey") % 11 == 0),
            ],
        ),
        (
            read("supplier"),
            [
                *is_a(me("Supplier"), "Supplier"),
                label(me("Supplier"), c("s_name")),
                has(me("Supplier"), "hasNation", nation_iri(c("s_nationkey")), kind="iri"),
                has(me("Supplier"), "homepage", F.when(k("s_suppkey") % 3 == 0, "None").otherwise(text("HTTP://Supplier", k("s_suppkey"), ".Example.org/Path/"))),
                has(me("Supplier"), "hasPart", text("b", k("s_suppkey")), kind="bnode", where=k("s_suppkey") % 10 == 0),
                has(me("Supplier"), "hasPart", text(NS + "Missing_", k("s_suppkey")), kind="iri", where=k("s_suppkey") % 10 == 1),
            ],
        ),
        (
            read("part"),
            [
                *is_a(me("Part"), "Part"),
                label(me("Part"), c("p_name")),
                has(me("Part"), "aliase", c("p_brand")),
                has(me("Part"), "aliase", c("p_type")),
                has(me("Part"), "aliase", text("  ", c("p_brand"), " ")),
                has(me("Part"), "size", text(c("p_size"), " cm")),
                has(me("Part"), "madeBy", text(NS + "Supplier_", k("p_partkey") % 10), kind="iri"),
                has(me("Part"), "stock", text(c("p_size"))),
            ],
        ),
        (
            read("orders"),
            [
                *is_a(me("Order"), "Order"),
                label(me("Order"), text("Order ", k("o_orderkey"))),
                has(me("Order"), "hasCustomer", text(NS + "Customer_", c("o_custkey")), kind="iri"),
                has(me("Order"), "orderDate", order_date(k("o_orderkey"), c("o_orderdate")), datatype=XSD_DATE),
                has(me("Order"), "priority", c("o_orderpriority")),
            ],
        ),
        (
            read("pages"),
            [
                *is_a(me("Page"), "Page"),
                has(me("Page"), "wikidata_uri", F.lit("None"), where=k("page_id") % 13 == 0),
                has(me("Page"), "wikidata_uri", c("url"), where=(k("page_id") % 13 != 0) & (k("page_id") % 2 == 0)),
                has(me("Page"), "wikidata_uri", c("url"), kind="iri", where=(k("page_id") % 13 != 0) & (k("page_id") % 2 == 1)),
            ],
        ),
        (
            read("documents"),
            [
                *is_a(me("Document"), "Document"),
                label(me("Document"), text("Document ", k("doc_id")), lang=c("lang")),
                Rule(me("Document"), COMMENT, text("Comment on ", k("doc_id")), lang=c("lang")),
                Rule(me("Document"), DCTERMS_DESCRIPTION, text("About document ", k("doc_id")), lang=c("lang")),
                has(me("Document"), "source", c("source")),
                has(me("Document"), "flag", F.lit("1")),
            ],
        ),
    ]
    source = MappedSource(rules)
    scan = source.scan

    def with_constants(keep=None) -> DataFrame:
        fixed = constant().selectExpr("s", "s_kind", "p", "o", "o_kind", "cast(null as string) o_datatype", "cast(null as string) o_lang")
        return scan(keep).unionAll(fixed if keep is None else fixed.where(keep.column(F.col("p")))).to(spark.createDataFrame([], TRIPLES).schema)

    source.scan = with_constants
    return source


def property_map_fx(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROPERTY_ROWS, PROPERTY_MAP)


def entity_cache_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    entry = lambda df, iri, qid, kind: df.select(iri.alias("canonical_id"), qid.alias("qid"), F.lit(kind).alias("entity_type"))
    c = F.col
    parts = [
        entry(read("customer").where("c_custkey % 4 = 0"), text(NS + "Customer_", c("c_custkey")), text("Q", 100000 + c("c_custkey")), "NamedIndividual"),
        entry(read("orders").where("o_orderkey % 3 = 0"), text(NS + "Order_", c("o_orderkey")), text("Q", 1000000 + c("o_orderkey")), "NamedIndividual"),
        entry(read("nation"), F.when(c("n_nationkey") % 10 == 3, text(EXT + "Nation_", c("n_nationkey"))).otherwise(text(NS + "Nation_", c("n_nationkey"))), text("Q", 100 + c("n_nationkey")), "OwlClass"),
        entry(read("region").where("r_regionkey in (0, 1)"), text(NS + "Region_", c("r_regionkey")), F.lit("Q50"), "OwlClass"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.select("canonical_id", "qid", "entity_type", F.col("canonical_id").alias("source_identifier"), F.concat(F.lit("cached "), F.col("qid")).alias("label"), F.lit("").alias("last_seen_owl_hash"), F.lit("2024-01-01T00:00:00Z").alias("last_synced_at"))


def remote_matches_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(identity_value, qid)"""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").where("p_partkey % 5 in (0, 1)")
    k = F.col("p_partkey")
    second = F.when(k % 5 == 1, F.array(text("Q", 20000000 + k), text("Q", 30000000 + k))).otherwise(F.array(text("Q", 20000000 + k)))
    return part.select(text(NS + "Part_", k).alias("identity_value"), F.explode(second).alias("qid"))


_LISTED = re.compile(r'"((?:[^"\\]|\\.)*)"')
_PART = re.compile(re.escape(NS) + r"Part_([0-9]+)$")


def query_service(kind: str, payload: dict) -> list[dict]:
    """A stand-in for a query service that knows the items of `remote_matches_fx`: it reads the values in a lookup's query and answers as a service does."""
    if kind != "sparql":
        raise ValueError(kind)
    out = []
    for value in _LISTED.findall(payload["query"]):
        part = _PART.match(value)
        k = int(part[1]) if part else -1
        numbers = {0: [20000000 + k], 1: [20000000 + k, 30000000 + k]}.get(k % 5, []) if part else []
        out += [{"value": {"value": value}, "item": {"value": f"http://kg.example.org/entity/Q{n}"}} for n in numbers]
    return out


def lookup_client() -> Client:
    return Client(query_service, Config(), Credentials(url="http://kg.example.org/"), sleep=lambda _: None)


def existing_items_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid) whose state could be read."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 4 = 0").select(text("Q", 100000 + F.col("c_custkey")).alias("qid"))
    return c.unionAll(spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 3 = 0").select(text("Q", 1000000 + F.col("o_orderkey")).alias("qid")))


def existing_metadata_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, kind, lang, text)"""
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 4 = 0")
    c = c.select(text("Q", 100000 + k).alias("qid"), F.lit("label").alias("kind"), F.lit("en").alias("lang"), F.when(k % 8 == 0, text("  ", F.col("c_name"), "  ")).otherwise(text("old ", F.col("c_name"))).alias("text"))
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 3 = 0")
    return c.unionAll(o.select(text("Q", 1000000 + F.col("o_orderkey")), F.lit("label"), F.lit("en"), text("Order ", F.col("o_orderkey"))))


def existing_claims_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, pid, value)"""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 6 = 0")
    o = o.select(text("Q", 1000000 + F.col("o_orderkey")).alias("qid"), F.lit("P9").alias("pid"), F.date_format("o_orderdate", "'+'yyyy-MM-dd'T00:00:00Z'").alias("value"))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 8 = 0")
    qid = text("Q", 100000 + F.col("c_custkey"))
    return o.unionAll(c.select(qid, F.lit("P3"), text("  ", F.col("c_mktsegment"), " "))).unionAll(c.select(qid, F.lit("P13"), text("C", F.col("c_custkey"))))


# ---- documents of each syntax

def documents(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Files made from the tables, by syntax: customers as N-Triples, suppliers as Turtle, regions as RDF/XML, nations as JSON-LD (a file for each of the last two)."""
    c = F.col
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    iri = lambda kind, key: text("<", NS, kind, key, ">")
    quoted = lambda v: text('"', F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), '"')
    customer = iri("Customer_", c("c_custkey"))
    lines = F.array(
        text(customer, f" <{RDF_TYPE}> <{OWL}NamedIndividual> ."),
        text(customer, f" <{LABEL}> ", quoted(c("c_name")), "@en . # ", c("c_custkey")),
        text(customer, f" <{NS}balance> ", quoted(c("c_acctbal")), "^^<http://www.w3.org/2001/XMLSchema#decimal> ."),
    )
    turtle = text(
        f"@prefix o: <{NS}> . @prefix rdfs: <{LABEL.rpartition('#')[0]}#> . o:Supplier_", c("s_suppkey"), f" a <{OWL}NamedIndividual> ; rdfs:label ", quoted(c("s_name")), "@en ; o:hasNation o:Nation_", c("s_nationkey"), " ; o:rank ", c("s_suppkey"), " .",
    )
    xml = text(
        f'<rdf:RDF xmlns:rdf="{RDF_TYPE.rpartition("#")[0]}#" xmlns:rdfs="{LABEL.rpartition("#")[0]}#" xmlns:owl="{OWL}" xml:base="{NS[:-1]}"><owl:Class rdf:about="#Region_', c("r_regionkey"), '"><rdfs:label xml:lang="en">', c("r_name"),
        f'</rdfs:label><rdfs:subClassOf rdf:resource="{THING}"/></owl:Class></rdf:RDF>',
    )
    linked = F.to_json(
        F.struct(
            F.from_json(F.lit('{"o":"' + NS + '"}'), "o string").alias("@context"),
            text("o:Nation_", c("n_nationkey")).alias("@id"),
            F.lit(OWL + "NamedIndividual").alias("@type"),
            F.struct(text("o:Region_", c("n_regionkey")).alias("@id")).alias("o:inRegion"),
            c("n_name").alias("o:name"),
        )
    )
    made = {"nt": read("customer").select(F.explode(lines)), "turtle": read("supplier").select(turtle), "xml": read("region").select(xml), "json-ld": read("nation").select(linked)}
    out = {}
    for syntax, rows in made.items():
        out[syntax] = new_folder(spark, f"documents-{syntax}")
        rows.write.option("maxRecordsPerFile", 1 if syntax in ("xml", "json-ld") else 0).text(out[syntax])
    return out
