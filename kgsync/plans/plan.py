"""The plan: what to do so that the knowledge base holds what the graph says.

Pass A resolves each entity to an item (cache, then remote matches) and compares labels, descriptions and
aliases; pass B compares statements. Both are joins; rows are a bag, all columns text, none null.

Left joins whose key may be missing use a key of the row's own instead of null, so that rows without a
partner are spread like all others.

Fixed values: the names of actions and the texts of reasons, which readers of plans know.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import squeeze
from ..functions.values import comparable, convert
from ..operators.numbering import numbered
from ..operators.ontology import Ontology
from ..operators.validate import message
from ..terms import ATTENTION, NEW_ITEM, PLAN_COLUMNS
from ..written import checkpointed


@dataclass
class Existing:
    """What is known of the knowledge base: a cache, remote matches (None: no lookup), and the state of items that could be read (`items`)."""

    cache: DataFrame
    matches: DataFrame | None = None
    items: DataFrame | None = None
    metadata: DataFrame | None = None
    claims: DataFrame | None = None


def rows(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Plan rows; columns that are not given are ''."""
    value = lambda v: F.lit(v) if isinstance(v, str) else v
    return df.select(*(F.coalesce(value(columns.get(n, "")).cast("string"), F.lit("")).alias(n) for n in PLAN_COLUMNS))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


class Planner:
    def __init__(self, onto: Ontology, mapping: DataFrame, existing: Existing):
        self.onto, self.mapping, self.existing, self.config = onto, mapping, existing, onto.config

    # ---- pass A

    @cached_property
    def identity(self) -> tuple[bool, bool]:
        """Whether the identity property has an id, and whether it is configured in full. The map has a row for each predicate."""
        found = self.mapping.where(F.col("source_predicate") == self.config.identity_property_key).select("pid", "wikibase_datatype").limit(1).collect()
        pid = bool(found and found[0].pid)
        return pid, pid and bool(found[0].wikibase_datatype)

    @property
    def remote(self) -> bool:
        return self.existing.matches is not None and self.identity[0]

    def cache_miss(self) -> DataFrame:
        return self.onto.entities.join(self.existing.cache.select("canonical_id"), "canonical_id", "left_anti")

    def lookup_batches(self) -> DataFrame:
        """(batch, canonical_id): what is to be looked up, in the order of entities, so many at a time."""
        n = numbered(self.cache_miss(), F.col("is_thing").desc(), F.col("s"))
        return n.select(F.floor((F.col("n") - 1) / max(1, self.config.batch_size)).cast("long").alias("batch"), "canonical_id")

    @cached_property
    def resolution(self) -> DataFrame:
        """Entities with label, qid, is_new, source, n_matches and whether they are in the cache."""
        cache = self.existing.cache.select("canonical_id", F.col("qid").alias("cached_qid"), F.lit(True).alias("cached"))
        out = self.onto.display_labels.join(cache, "canonical_id", "left").withColumn("cached", F.coalesce("cached", F.lit(False)))
        if self.remote:
            # every row counts, even the same item twice
            found = self.existing.matches.groupBy(F.col("identity_value").alias("canonical_id")).agg(F.count("*").alias("n_matches"), F.min("qid").alias("remote_qid"))
            out = out.join(found, "canonical_id", "left").withColumn("n_matches", F.when(F.col("cached"), F.lit(0)).otherwise(F.coalesce("n_matches", F.lit(0))))
        else:
            out = out.withColumn("n_matches", F.lit(0).cast("long")).withColumn("remote_qid", F.lit(None).cast("string"))
        conflict, once = F.col("n_matches") > 1, F.col("n_matches") == 1
        qid = F.when(F.col("cached"), F.col("cached_qid")).when(once, F.col("remote_qid"))
        new = qid.isNull() & ~conflict
        source = F.when(conflict, "conflict").when(new, "new").when(F.col("cached"), "cache").otherwise("wikibase_lookup")
        return out.select("s", "is_thing", "canonical_id", "entity_type", "label", qid.alias("qid"), new.alias("is_new"), source.alias("source"), "n_matches", "cached")

    def resolved_rows(self) -> DataFrame:
        r, c = self.resolution, F.col
        known = c("cached") | F.lit(self.remote)
        common = {"entity_type": c("entity_type"), "source_identifier": c("canonical_id"), "label": c("label")}
        conflict = rows(r.where("source = 'conflict'"), action="CONFLICT", severity="BLOCKING", reason=message("{n_matches} Wikibase items already have identity value '{canonical_id}'"), **common)
        create = rows(
            r.where("is_new"), action="CREATE_ITEM", qid=NEW_ITEM, severity=F.when(known, "INFO").otherwise("WARNING"),
            reason=F.when(known, "no existing Wikibase item found").otherwise("no local cache entry and remote duplicate detection unavailable; will create new item"), **common,
        )
        return _all([conflict, create, self.unverified_rows()])

    def unverified(self) -> DataFrame:
        """One entity, the first, of each item that is to be reused and could not be read."""
        reused = self.resolution.where("qid is not null")
        if self.existing.items is not None:
            reused = reused.join(self.existing.items.select("qid").distinct(), "qid", "left_anti")
        first = Window.partitionBy("qid").orderBy(F.col("is_thing").desc(), "s")
        return reused.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")

    def unverified_rows(self) -> DataFrame:
        c = F.col
        return rows(
            self.unverified(), action="SKIP_UNCHANGED", entity_type=c("entity_type"), source_identifier=c("canonical_id"), qid=c("qid"), label=c("label"), severity="WARNING",
            reason="existing item state could not be verified (no Wikibase connection); metadata/statement changes cannot be safely diffed this run",
        )

    def _read(self, table: DataFrame | None) -> DataFrame | None:
        """Of items whose state could be read."""
        return None if table is None or self.existing.items is None else table.join(self.existing.items.select("qid").distinct(), "qid", "left_semi")

    def _with_item(self, values: DataFrame) -> DataFrame:
        """Values of entities that are not in conflict, with the item's key: its id, or one that no item has."""
        r = self.resolution.where("source <> 'conflict'").select("s", "is_thing", "canonical_id", "entity_type", "label", "qid", "is_new")
        joined = values.join(r, ["s", "is_thing"])
        return joined.withColumn("item", F.coalesce("qid", F.concat(F.lit(" "), F.col("s")))).withColumn("shown_qid", F.when(F.col("is_new"), NEW_ITEM).otherwise(F.col("qid")))

    def metadata_values(self) -> DataFrame:
        """(kind, s, is_thing, lang, text, key): what the graph says; an alias is one of many and its own key, others have none."""
        kinds = {"label": self.onto.all_labels, "description": self.onto.all_descriptions.withColumn("is_thing", F.lit(False)), "alias": self.onto.all_aliases.withColumn("is_thing", F.lit(False))}
        key = lambda kind: F.col("text") if kind == "alias" else F.lit("")
        return _all([df.select(F.lit(kind).alias("kind"), "s", "is_thing", "lang", "text", key(kind).alias("key")) for kind, df in kinds.items()])

    def metadata_rows(self, *kinds: str) -> DataFrame:
        """Labels, descriptions and aliases meet their entities, and what the items have of them, together."""
        c, alias = F.col, F.col("kind") == "alias"
        wanted = self._with_item(self.metadata_values().where(c("kind").isin(*kinds)))
        known = self._read(self.existing.metadata)
        if known is None:
            wanted = wanted.withColumn("old", F.lit(None).cast("string"))
        else:
            known = known.withColumn("key", F.when(alias, squeeze(c("text"))).otherwise("")).groupBy("kind", c("qid").alias("item"), "lang", "key").agg(F.min("text").alias("old"))
            wanted = wanted.join(known, ["item", "kind", "lang", "key"], "left")
        none = c("old").isNull()
        changed = wanted.where(none | (~alias & (squeeze(c("old")) != squeeze(c("text")))))
        action = F.when(alias, "ADD_ALIAS").when(c("kind") == "label", "UPDATE_LABEL").when(none, "ADD_DESCRIPTION").otherwise("UPDATE_DESCRIPTION")
        reason = F.when(alias, "alias not present on existing item").when(none, F.concat("kind", F.lit(" missing for this language"))).otherwise(F.concat("kind", F.lit(" differs from OWL source")))
        return rows(
            changed,
            action=action,
            entity_type=c("entity_type"),
            source_identifier=c("canonical_id"),
            qid=c("shown_qid"),
            label=c("label"),
            property_name=F.concat("kind", F.lit("@"), "lang"),
            old_value=F.when(~alias, c("old")),
            new_value=c("text"),
            severity="INFO",
            reason=reason,
        )

    def label_rows(self) -> DataFrame:
        return self.metadata_rows("label")

    def description_rows(self) -> DataFrame:
        return self.metadata_rows("description")

    def alias_rows(self) -> DataFrame:
        return self.metadata_rows("alias")

    def pass_a(self) -> DataFrame:
        wanted = {"label": self.config.update_labels, "description": self.config.update_descriptions, "alias": self.config.update_aliases}
        kinds = [kind for kind, asked in wanted.items() if asked]
        return _all([self.resolved_rows(), *([self.metadata_rows(*kinds)] if kinds else [])])

    # ---- pass B

    @cached_property
    def wanted_statements(self) -> DataFrame:
        """Statements of all entities, with those of their identity if it is mapped in full."""
        own = self.onto.all_statements.withColumn("is_thing", F.lit(False))
        return own.unionByName(self.onto.identity_statements) if self.identity[1] else own

    @cached_property
    def planned_statements(self) -> DataFrame:
        """Statements of resolved subjects with their mapping and, where they point to an item of ours, what that resolved to."""
        c = F.col
        entry = self.mapping.select(c("source_predicate").alias("map_key"), F.nullif("pid", F.lit("")).alias("pid"), F.nullif("wikibase_datatype", F.lit("")).alias("datatype"))
        out = self._with_item(self.wanted_statements).join(entry, "map_key", "left")
        out = out.withColumn("configured", c("pid").isNotNull() & c("datatype").isNotNull())
        out = out.withColumn("to_item", c("configured") & (c("value_kind") == "resource") & (c("datatype") == "wikibase-item"))
        key = F.when(c("to_item"), c("value")).otherwise(F.concat(F.lit(" "), c("s")))
        target = self.resolution.where("source <> 'conflict'").select(c("canonical_id").alias("target_key"), c("qid").alias("target_qid"), c("is_new").alias("target_new")).distinct()
        out = out.withColumn("target_key", key).join(target, "target_key", "left")
        return out.withColumn("target_known", c("target_new").isNotNull()).withColumn("target_new", F.coalesce("target_new", F.lit(False)))

    @cached_property
    def compared_statements(self) -> DataFrame:
        """With `outcome`, `comparable`, `error` and `datavalue`."""
        c = F.col
        converted = convert(c("value_kind"), c("value"), c("datatype"), c("language"), c("target_qid"), self.config.default_language, squeezed=c("squeezed"))
        out = self.planned_statements.withColumn("squeezed", squeeze(c("value"))).withColumn("c", F.when(c("configured") & ~c("target_new"), converted))
        out = out.withColumn("comparable", F.when(c("target_new"), NEW_ITEM).otherwise(c("c.comparable_value"))).withColumn("error", c("c.error")).withColumn("datavalue", c("c.datavalue"))
        known = self._read(self.existing.claims)
        if known is None:
            out = out.withColumn("present", F.lit(False))
        else:
            keys = self.mapping.where("coalesce(pid, '') <> ''").select("pid", c("source_predicate").alias("map_key"), c("wikibase_datatype").alias("datatype"))
            there = known.join(keys, "pid").select(c("qid").alias("item"), "map_key", comparable(c("datatype"), c("value")).alias("comparable"), F.lit(True).alias("present")).distinct()
            out = out.join(there, ["item", "map_key", "comparable"], "left").withColumn("present", F.coalesce("present", F.lit(False)))
        outcome = (
            F.when(~c("configured"), "SKIP_UNMAPPED_PROPERTY")
            .when(c("to_item") & ~c("target_known"), "UNRESOLVED_OBJECT")
            .when(~c("target_new") & ~c("c.success"), "ERROR")
            .when(c("is_new") | c("target_new") | ~c("present"), "ADD_STATEMENT")
            .otherwise("SKIP_UNCHANGED")
        )
        return out.withColumn("outcome", outcome)

    def statement_rows(self) -> DataFrame:
        """One row for each statement; `datavalue` is what a live run writes, '' where it depends on an item that is yet to be made."""
        c = F.col
        stop = "BLOCKING" if self.config.stop_on_unresolved_property else "WARNING"
        case = lambda **k: F.create_map(*(x for n, v in k.items() for x in (F.lit(n), F.lit(v))))[c("outcome")]
        final = c("outcome").isin("ADD_STATEMENT", "SKIP_UNCHANGED")
        unmapped = c("outcome") == "SKIP_UNMAPPED_PROPERTY"
        reason = (
            F.when(unmapped, message("predicate '{map_key}' has no configured PID/datatype in PROPERTY_MAP"))
            .when(c("outcome") == "UNRESOLVED_OBJECT", message("object '{value}' did not resolve to a known/plannable Wikibase item"))
            .when(c("outcome") == "ERROR", message("conversion failed: {error}"))
            .when(c("outcome") == "SKIP_UNCHANGED", "statement already present with the same value")
            .when(c("is_new"), "new item")
            .otherwise("statement not present on existing item")
        )
        given = dict(
            action=c("outcome"), entity_type=c("entity_type"), source_identifier=c("canonical_id"), qid=c("shown_qid"), label=c("label"), pid=F.when(~unmapped, c("pid")), property_name=c("map_key"),
            new_value=F.when(final, c("comparable")).otherwise(c("value")), reason=reason,
            severity=case(SKIP_UNMAPPED_PROPERTY=stop, UNRESOLVED_OBJECT="WARNING", ERROR="ERROR", ADD_STATEMENT="INFO", SKIP_UNCHANGED="INFO"),
            target_source_identifier=F.when(final & c("to_item"), c("value")), literal_datatype=F.when(final, c("literal_datatype")), language=F.when(final, c("language")),
        )
        value = lambda v: F.lit(v) if isinstance(v, str) else v
        return self.compared_statements.select(*(F.coalesce(value(given.get(n, "")).cast("string"), F.lit("")).alias(n) for n in PLAN_COLUMNS), F.when(final, c("datavalue")).alias("datavalue"))

    def pass_b(self) -> DataFrame:
        return self.statement_rows().drop("datavalue")

    def settle(self) -> None:
        """Write the resolution down, so that all that builds on it reads the same rows and none makes them again."""
        if not self.__dict__.get("settled"):
            self.settled = True
            self.onto.settle()
            self.resolution = checkpointed(self.resolution)

    def plan(self) -> DataFrame:
        """All rows; `datavalue` is null but for statements."""
        self.settle()
        a = self.pass_a().withColumn("datavalue", F.lit(None).cast("string"))
        return a.unionAll(self.statement_rows()) if self.config.update_statements else a


def action_counts(plan: DataFrame) -> DataFrame:
    """(action, n), most frequent first."""
    return plan.groupBy("action").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "action")


def plan_summary(plan: DataFrame) -> DataFrame:
    """(kind, name, n): by action, by severity, and the total, in one pass over the plan."""
    counted = plan.groupingSets([["action"], ["severity"], []], "action", "severity").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    kind = F.when(F.col("g") == 1, "action").when(F.col("g") == 2, "severity").otherwise("total")
    return counted.select(kind.alias("kind"), F.coalesce("action", "severity", F.lit("")).alias("name"), "n")


def attention(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("action").isin(list(ATTENTION)))


def preview(plan: DataFrame, n: int = 20) -> DataFrame:
    """The first rows of a plan, in the order of its columns."""
    return plan.select(*PLAN_COLUMNS).orderBy(*PLAN_COLUMNS).limit(n)
