"""From triples to entities: classification, labels, descriptions, aliases and statements.

Everything is kept in long tables (one row for each value) and nested only at the edge. Each table asks
the source for its predicates alone. "First" always means by a stated order, never by arrival.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.hashing import entity_hash, statement_hash, statement_json
from ..functions.identifiers import normalize, normalized_local_name, property_key, squeeze, strip
from ..sources.triples import Predicates
from ..terms import DESCRIPTIONS, LABEL, META_TYPES, NOTHING, OWL, PROPERTY_TYPES, RDF_TYPE, SUB_CLASS_OF, THING, TYPE_PRECEDENCE
from ..written import checkpointed


def entity_type(types: Column) -> Column:
    """The type that comes first in precedence, of an array of rdf:type objects."""
    out = F.when(F.lit(False), "")
    for iri, name in TYPE_PRECEDENCE.items():
        out = out.when(F.array_contains(types, iri), name)
    return out.otherwise("Unknown")


def ranked_type(o: Column) -> Column:
    """(rank, name) so that the least is the type that counts; null for other objects."""
    return F.create_map(*(x for i, (iri, name) in enumerate(TYPE_PRECEDENCE.items()) for x in (F.lit(iri), F.struct(F.lit(i).alias("rank"), F.lit(name).alias("name")))))[o]


class Ontology:
    """Lazy relations of one graph."""

    def __init__(self, source, config: Config | None = None):
        self.source, self.config = source, config or Config()

    # ---- types

    def type_triples(self) -> DataFrame:
        return self.source.scan(Predicates((RDF_TYPE,)))

    def typed_resources(self) -> DataFrame:
        """(resource, entity_type): every subject of rdf:type that is no blank node."""
        return self.type_triples().where("s_kind = 'iri'").groupBy(F.col("s").alias("resource")).agg(F.coalesce(F.min(ranked_type(F.col("o")))["name"], F.lit("Unknown")).alias("entity_type"))

    def classify_predicates(self) -> DataFrame:
        """(predicate, entity_type) of every predicate in use."""
        used = self.source.scan().select(F.col("p").alias("predicate")).distinct()
        typed = self.typed_resources().withColumnRenamed("resource", "predicate")
        return used.join(typed, "predicate", "left").select("predicate", F.coalesce("entity_type", F.lit("Unknown")).alias("entity_type"))

    @cached_property
    def subjects(self) -> DataFrame:
        """(s, canonical_id, entity_type, local_name): classes and individuals that are no blank nodes."""
        typed = self.type_triples().where(F.col("s_kind") == "iri").where(F.col("o").isin(OWL + "Class", OWL + "NamedIndividual"))
        return typed.groupBy("s").agg(F.min(ranked_type(F.col("o")))["name"].alias("entity_type")).select("s", normalize(F.col("s")).alias("canonical_id"), "entity_type", normalized_local_name(F.col("s")).alias("local_name"))

    @cached_property
    def named_subjects(self) -> DataFrame:
        """Subjects with `label` (that of the default language, else of the least language, else the local name) and whether they have any. Types and labels meet by subject."""
        text, lang = F.col("text"), F.col("lang")
        chosen = self.language_values(Predicates((LABEL,))).groupBy("s").agg(F.min(F.when(lang == self.config.default_language, text)).alias("own"), F.min(F.struct(lang, text))["text"].alias("other"))
        return self.subjects.join(chosen, "s", "left").select(*self.subjects.columns, F.coalesce("own", "other", "local_name").alias("label"), F.col("other").isNotNull().alias("labeled"))

    def settle(self) -> Ontology:
        """Write the named subjects down, once, for all that builds on them in one plan or several."""
        if not self.__dict__.get("settled"):
            self.settled = True
            self.named_subjects = checkpointed(self.named_subjects)
            self.subjects = self.named_subjects.drop("label", "labeled")
        return self

    def _of_subjects(self, triples: DataFrame) -> DataFrame:
        return triples.join(self.subjects.select("s"), "s", "left_semi")

    # ---- owl:Thing

    @cached_property
    def has_thing(self) -> bool:
        """Whether a class has owl:Thing above it. Asked for once, so that no plan carries the question along."""
        above = self.source.scan(Predicates((SUB_CLASS_OF,))).where("o_kind = 'iri'").where(normalize(F.col("o")) == THING)
        return not self._of_subjects(above).isEmpty()

    @cached_property
    def thing(self) -> DataFrame:
        """One row like those of `subjects`, or none. It is added even if it is declared."""
        spark = self.subjects.sparkSession
        return spark.createDataFrame([(THING, THING, "OwlClass", "Thing")] if self.has_thing else [], "s string, canonical_id string, entity_type string, local_name string")

    @cached_property
    def entities(self) -> DataFrame:
        """`subjects` and the synthesized owl:Thing; `is_thing` tells it apart."""
        return self.subjects.withColumn("is_thing", F.lit(False)).unionByName(self.thing.withColumn("is_thing", F.lit(True)))

    @cached_property
    def display_labels(self) -> DataFrame:
        """Entities with `label` and `labeled`."""
        return self.named_subjects.withColumn("is_thing", F.lit(False)).unionByName(self.thing.select("*", F.lit("Thing").alias("label"), F.lit(True).alias("labeled"), F.lit(True).alias("is_thing")))

    # ---- values by language

    def language_values(self, keep: Predicates) -> DataFrame:
        """(s, p, lang, text): literals, without white space at the ends; untagged ones in the default language, empty ones left out."""
        lang = F.coalesce(F.nullif(F.col("o_lang"), F.lit("")), F.lit(self.config.default_language))
        return self.source.scan(keep).where("o_kind = 'literal'").select("s", "p", lang.alias("lang"), strip(F.col("o")).alias("text")).where("text <> ''")

    @cached_property
    def all_labels(self) -> DataFrame:
        """(s, lang, text, is_thing): the least label of each language, of whatever has one. Joins with entities keep theirs."""
        own = self.language_values(Predicates((LABEL,))).groupBy("s", "lang").agg(F.min("text").alias("text"))
        thing = self.thing.select("s", F.lit(self.config.default_language).alias("lang"), F.lit("Thing").alias("text"), F.lit(True).alias("is_thing"))
        return own.withColumn("is_thing", F.lit(False)).unionByName(thing)

    @cached_property
    def labels(self) -> DataFrame:
        """Those of entities."""
        return self.all_labels.where("is_thing").unionByName(self._of_subjects(self.all_labels.where("not is_thing")).select("s", "lang", "text", "is_thing"))

    @cached_property
    def all_descriptions(self) -> DataFrame:
        """(s, lang, text): by the order of the predicates, then the least."""
        rank = F.array_position(F.array(*map(F.lit, DESCRIPTIONS)), F.col("p"))
        return self.language_values(Predicates(tuple(DESCRIPTIONS))).groupBy("s", "lang").agg(F.min(F.struct(rank.alias("rank"), "text"))["text"].alias("text"))

    @cached_property
    def descriptions(self) -> DataFrame:
        return self._of_subjects(self.all_descriptions)

    @cached_property
    def alias_predicates(self) -> Predicates:
        return Predicates((), tuple(n.lower() for n in self.config.alias_local_names))

    @cached_property
    def all_aliases(self) -> DataFrame:
        """(s, lang, text): distinct, white space squeezed."""
        return self.language_values(self.alias_predicates).select("s", "lang", squeeze(F.col("text")).alias("text")).distinct()

    @cached_property
    def aliases(self) -> DataFrame:
        return self._of_subjects(self.all_aliases)

    @cached_property
    def property_labels(self) -> DataFrame:
        """(canonical_id, label) of declared properties: of the least language, the least."""
        typed = self.type_triples().where(F.col("o").isin(PROPERTY_TYPES)).select("s").distinct()
        named = self.language_values(Predicates((LABEL,))).join(typed, "s", "left_semi")
        return named.groupBy(normalize(F.col("s")).alias("canonical_id")).agg(F.min(F.struct("lang", "text"))["text"].alias("label"))

    # ---- statements

    @cached_property
    def statements(self) -> DataFrame:
        """One row for each statement of an entity, with its key in the property map."""
        return self._of_subjects(self.all_statements)

    @cached_property
    def all_statements(self) -> DataFrame:
        """The same of whatever has any."""
        return self.statements_of(None)

    def statements_of(self, keep: Predicates | None) -> DataFrame:
        """Those of some predicates."""
        about = Predicates((LABEL, *DESCRIPTIONS), self.alias_predicates.local_names, other=True)
        p, o = F.col("p"), F.col("o")
        trivial = ((p == RDF_TYPE) & o.isin(META_TYPES)) | ((p == SUB_CLASS_OF) & (o == NOTHING))
        rows = (self.source.scan(about) if keep is None else self.source.scan(keep).where(about.column(p))).where(~trivial)
        kind = F.when(F.col("o_kind") == "literal", "literal").when(F.col("o_kind") == "bnode", "blank_node").otherwise("resource")
        value = F.when(F.col("o_kind") == "literal", strip(o)).when(F.col("o_kind") == "bnode", F.concat(F.lit("_:"), o)).otherwise(normalize(o))
        literal = lambda c: F.when(F.col("o_kind") == "literal", F.nullif(F.col(c), F.lit("")))
        out = rows.select(
            "s",
            normalize(F.col("s")).alias("subject_canonical_id"),
            p.alias("predicate_original"),
            normalized_local_name(p).alias("predicate_local_name"),
            kind.alias("value_kind"),
            value.alias("value"),
            literal("o_datatype").alias("literal_datatype"),
            literal("o_lang").alias("language"),
        )
        return out.withColumn("map_key", property_key(F.col("predicate_original")))

    @staticmethod
    def hashed(statements: DataFrame) -> DataFrame:
        names = ("subject_canonical_id", "predicate_local_name", "value_kind", "value", "literal_datatype", "language")
        return statements.withColumn("statement_hash", statement_hash(*map(F.col, names)))

    @cached_property
    def hashed_statements(self) -> DataFrame:
        return self.hashed(self.statements)

    @cached_property
    def identity_statements(self) -> DataFrame:
        """Of each entity, that its canonical identifier is its identity."""
        none = F.lit(None).cast("string")
        return self.entities.select(
            "s", "is_thing", F.col("canonical_id").alias("subject_canonical_id"), F.lit("ontology_iri").alias("predicate_original"), F.lit("ontology_iri").alias("predicate_local_name"),
            F.lit("literal").alias("value_kind"), F.col("canonical_id").alias("value"), none.alias("literal_datatype"), none.alias("language"), F.lit("ontology_iri").alias("map_key"),
        )

    # ---- nested entities

    def nested(self) -> DataFrame:
        """One row for each entity with maps of labels, descriptions and aliases, an array of statements, and the content hash.

        All that is said of a subject meets in one exchange; what is said of no entity goes there.
        """
        self.settle()
        c = F.col
        statement = F.struct("subject_canonical_id", "predicate_original", "predicate_local_name", "value_kind", "value", "literal_datatype", "language", "statement_hash")
        parts = {
            "entity": self.entities.select("s", "is_thing", F.struct("canonical_id", "entity_type", "local_name").alias("entity")),
            "label": self.all_labels.select("s", "is_thing", F.struct("lang", "text").alias("label")),
            "description": self.all_descriptions.select("s", F.lit(False).alias("is_thing"), F.struct("lang", "text").alias("description")),
            "alias": self.all_aliases.groupBy("s", "lang").agg(F.sort_array(F.collect_list("text")).alias("text")).select("s", F.lit(False).alias("is_thing"), F.struct("lang", "text").alias("alias")),
            "statement": self.hashed(self.all_statements).select("s", F.lit(False).alias("is_thing"), statement.alias("statement")),
        }
        kinds = {n: df.schema[n].dataType for n, df in parts.items()}
        tagged = [df.select("s", "is_thing", *(c(n) if n == mine else F.lit(None).cast(t).alias(n) for n, t in kinds.items())) for mine, df in parts.items()]
        by_subject = reduce(DataFrame.unionAll, tagged).groupBy("s", "is_thing")
        listed = by_subject.agg(F.first("entity", ignorenulls=True).alias("entity"), *(F.array_sort(F.collect_list(n)).alias(n) for n in kinds if n != "entity")).where("entity is not null")
        out = listed.select(
            "entity.canonical_id",
            c("s").alias("original_id"),
            "entity.entity_type",
            "entity.local_name",
            F.map_from_entries("label").alias("labels"),
            F.map_from_entries("description").alias("descriptions"),
            F.map_from_entries("alias").alias("aliases"),
            c("statement").alias("statements"),
            "is_thing",
        )
        texts = F.sort_array(F.transform("statements", statement_json))
        return out.withColumn("content_hash", entity_hash(c("canonical_id"), c("entity_type"), c("labels"), c("descriptions"), c("aliases"), texts))


def in_order(entities: DataFrame) -> DataFrame:
    """The synthesized owl:Thing first, then by original identifier."""
    return entities.orderBy(F.col("is_thing").desc(), "s")
