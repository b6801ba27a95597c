"""Names and values that are fixed by RDF, OWL or the plan's format."""

from __future__ import annotations

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
RDF_TYPE, SUB_CLASS_OF, LABEL, COMMENT = RDF + "type", RDFS + "subClassOf", RDFS + "label", RDFS + "comment"
THING, NOTHING = OWL + "Thing", OWL + "Nothing"
DC_DESCRIPTION = "http://purl.org/dc/elements/1.1/description"
DCTERMS_DESCRIPTION = "http://purl.org/dc/terms/description"

# Description predicates, in the order in which they win.
DESCRIPTIONS = [COMMENT, DC_DESCRIPTION, DCTERMS_DESCRIPTION]
# Objects of rdf:type that classify and say nothing else.
META_TYPES = [OWL + "Class", OWL + "NamedIndividual", OWL + "ObjectProperty", OWL + "DatatypeProperty", OWL + "AnnotationProperty", OWL + "Ontology", RDF + "Property"]
# Types in order of precedence, and the entity type each gives.
TYPE_PRECEDENCE = {
    OWL + "Class": "OwlClass",
    OWL + "NamedIndividual": "NamedIndividual",
    OWL + "ObjectProperty": "ObjectProperty",
    OWL + "DatatypeProperty": "DatatypeProperty",
    OWL + "AnnotationProperty": "AnnotationProperty",
}
PROPERTY_TYPES = [OWL + "ObjectProperty", OWL + "DatatypeProperty", OWL + "AnnotationProperty"]
# Severities, in the order of summaries.
SEVERITIES = ["INFO", "WARNING", "ERROR", "BLOCKING"]
# Datatypes a value can be converted to.
DATATYPES = ["wikibase-item", "string", "external-id", "url", "monolingualtext", "time", "quantity", "commonsMedia"]
# Datatypes that can hold a resource.
RESOURCE_DATATYPES = ["wikibase-item", "url", "string", "external-id"]
# Actions that a person should look at, with the severity after a run.
ATTENTION = {"CONFLICT": "BLOCKING", "UNRESOLVED_OBJECT": "WARNING", "ERROR": "ERROR", "SKIP_UNMAPPED_PROPERTY": "WARNING"}
NEW_ITEM = "<NEW_ITEM>"
CALENDAR = "http://www.wikidata.org/entity/Q1985727"
SCHEMA_VERSION = "1.0"

TRIPLES = "s string, s_kind string, p string, o string, o_kind string, o_datatype string, o_lang string"
PROPERTY_MAP = "source_predicate string, pid string, wikibase_datatype string, role string"
ENTITY_CACHE = "canonical_id string, qid string, entity_type string, source_identifier string, label string, last_seen_owl_hash string, last_synced_at string"
# The columns of a plan, of which all but the last two are exported.
PLAN_COLUMNS = ["action", "entity_type", "source_identifier", "qid", "label", "pid", "property_name", "old_value", "new_value", "reason", "severity", "target_source_identifier", "literal_datatype", "language"]
FINDING_COLUMNS = ["check", "severity", "message", "source_identifier", "details"]
