"""A live run. Writes are made one after the other from the driver: the knowledge base takes some two a second,
and items must be there before statements point to them. Rows come from the executors as a stream.

Each item and each claim is in the run's log at once, so a run that breaks off anywhere goes on where it
was: with the same plan, nothing is made or written twice. A failed write is recorded and the run goes on.
What the driver holds of a run is one entry for each write, which their pace bounds.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import stores
from ..sources.remote import Client
from ..terms import ENTITY_CACHE
from .execute import Execution, guard
from .plan import Planner

log = logging.getLogger("kgsync.live")


class Run:
    """One pass over the phases of a plan; `counts` are those of this pass."""

    def __init__(self, planner: Planner, client: Client, done: stores.RunLog, timestamp: str):
        self.planner, self.client, self.done, self.timestamp = planner, client, done, timestamp
        self.spark: SparkSession = planner.mapping.sparkSession
        self.counts = dict.fromkeys(("items_created", "labels_updated", "descriptions_updated", "aliases_added", "statements_added", "unresolved_targets", "errors"), 0)

    def failed(self, action: str, identifier: str, error: Exception) -> None:
        self.counts["errors"] += 1
        log.error("%s of %s: %s", action, identifier, error)
        self.done.add("failed", action=action, source_identifier=identifier, error=str(error))

    def create(self) -> DataFrame:
        """(s, is_thing, qid, n) of the items that this run made, now or before it broke off."""
        planner = self.planner
        nested = planner.onto.nested().withColumnRenamed("original_id", "s").drop("statements")
        new = planner.resolution.where("is_new").select("s", "is_thing", "label").join(nested, ["s", "is_thing"])
        for e in new.orderBy(F.desc("is_thing"), "s").toLocalIterator():
            if (e.s, e.is_thing) in self.done.made:
                continue
            try:
                qid = self.client.create_item(e.labels, e.descriptions, e.aliases)
            except Exception as x:  # noqa: BLE001  recorded, and the run goes on
                self.failed("CREATE_ITEM", e.canonical_id, x)
                continue
            entry = {"canonical_id": e.canonical_id, "qid": qid, "entity_type": e.entity_type, "source_identifier": e.s, "label": e.label}
            self.done.add("made", **entry, last_seen_owl_hash=e.content_hash, last_synced_at=self.timestamp, is_thing=e.is_thing)
            self.counts["items_created"] += 1
        rows = [(s, is_thing, x["qid"], n) for n, ((s, is_thing), x) in enumerate(self.done.made.items(), 1)]
        return self.spark.createDataFrame(rows, "s string, is_thing boolean, qid string, n long")

    def cache(self) -> DataFrame:
        fresh = [tuple(x.get(c) for c in stores.CACHE_NAMES) for x in self.done.made.values()]
        return stores.upsert(self.planner.existing.cache, self.spark.createDataFrame(fresh, ENTITY_CACHE))

    def update_metadata(self, execution: Execution) -> None:
        """Writing the same texts again changes nothing, so these are not in the log."""
        for m in execution.metadata_updates().toLocalIterator():
            aliases: dict[str, list[str]] = {}
            for a in m.aliases:
                aliases.setdefault(a.lang, []).append(a.text)
            try:
                if not m.qid:
                    raise LookupError("no item")
                self.client.update_metadata(m.qid, m.labels, m.descriptions, aliases)
            except Exception as x:  # noqa: BLE001
                self.failed("UPDATE_METADATA", m.source_identifier, x)
                continue
            self.counts["labels_updated"] += len(m.labels)
            self.counts["descriptions_updated"] += len(m.descriptions)
            self.counts["aliases_added"] += len(m.aliases)

    def add_statements(self, execution: Execution) -> None:
        for b in execution.bound.toLocalIterator():
            if b.status == "unresolved_target":
                self.counts["unresolved_targets"] += 1
                continue
            try:
                if b.status != "added":
                    raise LookupError("no item or no value")
                digest = self.done.claim_digest(b.subject_qid, b.pid, b.datavalue)
                if bytes.fromhex(digest) in self.done.claims:
                    continue
                self.client.add_claim(b.subject_qid, b.pid, "", b.datavalue)
            except Exception as x:  # noqa: BLE001
                self.failed("ADD_STATEMENT", b.source_identifier, x)
                continue
            self.done.add("claim", digest=digest)
            self.counts["statements_added"] += 1


def run_live(planner: Planner, client: Client, cache_path, done: stores.RunLog, timestamp: str) -> dict:
    """Executes the plan and keeps the cache at `cache_path`. Call it again with the log of a run that broke off, and it goes on."""
    guard(planner.config)
    url = client.credentials.url
    _, about = stores.load_cache(planner.mapping.sparkSession, cache_path, url)
    if not stores.belongs_to(about.get("wikibase_url"), url):
        raise ValueError(f"the cache at {cache_path} is one of {about['wikibase_url']}: its items are not those of {url}")
    planner.settle()
    run = Run(planner, client, done, timestamp)
    created = run.create()
    stores.save_cache(run.cache(), cache_path, url, timestamp)
    done.add("phase", name="creations")
    execution = Execution(planner, lambda entities: entities.join(created, ["s", "is_thing"]))
    run.update_metadata(execution)
    run.add_statements(execution)
    done.add("phase", name="synchronization")
    planned = execution.result(done.run_id).first().asDict()
    status = "completed_with_errors" if run.counts["errors"] else "completed"
    done.add("ended", status=status)
    return planned | run.counts | {"status": status} | client.traffic()
