"""Sources of triples. A triple is (s, s_kind, p, o, o_kind, o_datatype, o_lang); kinds are iri, bnode and literal.

A source is asked for the predicates that a plan needs, so that those of no use are never read: a mapped
source leaves their rules out of the plan, a table source filters on `p` in the scan (and prunes
partitions or row groups where the table is laid out by `p`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import normalized_local_name
from ..terms import TRIPLES


def python_local_name(identifier: str) -> str:
    t = identifier.strip()
    for mark in ("http://", "https://"):
        if (at := t.find(mark, 1)) > 0:
            t = t[at:]
            break
    return t.rpartition("#")[2] if "#" in t and not t.endswith("#") else t.rstrip("/").rpartition("/")[2] or t


@dataclass(frozen=True)
class Predicates:
    """Predicates by identifier or by local name in lower case; `other`: all but those."""

    identifiers: tuple[str, ...] = ()
    local_names: tuple[str, ...] = ()
    other: bool = False

    def has(self, predicate: str) -> bool:
        return (predicate in self.identifiers or python_local_name(predicate).lower() in self.local_names) != self.other

    def column(self, predicate: Column) -> Column:
        found = predicate.isin(*self.identifiers) if self.identifiers else F.lit(False)
        if self.local_names:
            found = found | F.lower(normalized_local_name(predicate)).isin(*self.local_names)
        return ~found if self.other else found

    def negated(self) -> Predicates:
        return Predicates(self.identifiers, self.local_names, not self.other)


class TableSource:
    """A DataFrame of triples, made a set when it is loaded (`distinct=False` if it is one already)."""

    def __init__(self, triples: DataFrame, distinct: bool = True):
        self.triples = triples.distinct() if distinct else triples

    @classmethod
    def written(cls, triples: DataFrame, folder: str) -> TableSource:
        """The set of triples as a table, made once and laid out by predicate and subject, so that a scan for some predicates skips the row groups of others."""
        spark = triples.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        triples.distinct().repartitionByRange(parts, "p", "s").sortWithinPartitions("p", "s").write.parquet(folder)
        return cls(spark.read.schema(TRIPLES).parquet(folder), distinct=False)

    def scan(self, keep: Predicates | None = None) -> DataFrame:
        return self.triples if keep is None else self.triples.where(keep.column(F.col("p")))


@dataclass(frozen=True)
class Rule:
    """One triple for each row of a table, or each that meets a condition. Text stands for itself, a column for its value."""

    subject: Column
    predicate: str
    value: Column
    kind: str = "literal"
    lang: Column | None = None
    datatype: str | None = None
    where: Column | None = None
    subject_kind: str = "iri"

    def triple(self) -> Column:
        none = F.lit(None).cast("string")
        t = F.struct(
            self.subject.alias("s"),
            F.lit(self.subject_kind).alias("s_kind"),
            F.lit(self.predicate).alias("p"),
            self.value.alias("o"),
            F.lit(self.kind).alias("o_kind"),
            (F.lit(self.datatype) if self.datatype else none).alias("o_datatype"),
            (self.lang if self.lang is not None else none).alias("o_lang"),
        )
        return t if self.where is None else F.when(self.where, t)


@dataclass
class MappedSource:
    """Triples made from relations by rules: each relation is scanned once, for the columns that the wanted rules use."""

    relations: list[tuple[Callable[[], DataFrame], list[Rule]]] = field(default_factory=list)

    def scan(self, keep: Predicates | None = None) -> DataFrame:
        parts = []
        for relation, rules in self.relations:
            wanted = [r for r in rules if keep is None or keep.has(r.predicate)]
            if wanted:
                triples = relation().select(F.explode(F.array(*(r.triple() for r in wanted))).alias("t"))
                parts.append(triples.where("t is not null").select("t.*"))
        if not parts:
            relation, rules = self.relations[0]
            return relation().select(F.explode(F.array(rules[0].triple())).alias("t")).select("t.*").where("false")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out


def sample(source, n: int = 15) -> DataFrame:
    """The first triples in order: (subject, predicate, object)."""
    return source.scan().select(F.col("s").alias("subject"), F.col("p").alias("predicate"), F.col("o").alias("object")).orderBy("subject", "predicate", "object").limit(n)


def namespaces(source) -> DataFrame:
    """(namespace, n): of the predicates in use, most used first; an identifier up to its last mark."""
    namespace = F.regexp_extract("p", "^(.*[#/])", 1)
    return source.scan().groupBy(F.when(namespace == "", F.col("p")).otherwise(namespace).alias("namespace")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "namespace")
