"""Reports on the driver's file system: small summaries as JSON, rows as CSV that is streamed, not collected."""

from __future__ import annotations

import csv
import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import validate
from .plans.plan import action_counts, attention
from .sources.stores import write_json
from .terms import PLAN_COLUMNS

EXPORTED = PLAN_COLUMNS[:-2]


def save_json_report(path, value) -> None:
    write_json(path, value)


def save_csv_report(path, rows: DataFrame, columns: list[str]) -> int:
    path, n = Path(path), 0
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(columns)
        for r in rows.select(*columns).toLocalIterator(prefetchPartitions=True):
            out.writerow(["" if v is None else v for v in r])
            n += 1
    return n


def counts(df: DataFrame, column: str) -> dict[str, int]:
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def save_plan(folder, plan: DataFrame) -> dict:
    """dry_run_plan.csv with all rows and dry_run_plan.json with their counts."""
    total = save_csv_report(Path(folder) / "dry_run_plan.csv", plan, EXPORTED)
    summary = {"action_counts": counts(plan, "action"), "severity_counts": counts(plan, "severity"), "total_actions": total}
    save_json_report(Path(folder) / "dry_run_plan.json", summary)
    return summary


def save_findings(folder, findings: DataFrame, stage: str = "preflight") -> dict:
    """Findings before and after a run have files of their own."""
    summary = {r.severity: r.n for r in validate.summary(findings).collect()}
    save_csv_report(Path(folder) / f"validation_{stage}.csv", findings, ["check", "severity", "message", "source_identifier", "details"])
    save_json_report(Path(folder) / f"validation_{stage}.json", {"summary": summary, "stage": stage})
    return summary


def save_result(folder, result: DataFrame, plan: DataFrame) -> dict:
    value = {"result": result.first().asDict(), "action_counts": {r.action: r.n for r in action_counts(plan).collect()}}
    save_json_report(Path(folder) / "synchronization_report.json", value)
    return value


def save_unresolved(folder, plan: DataFrame) -> int:
    return save_csv_report(Path(folder) / "unresolved_resources.csv", attention(plan), EXPORTED)


def save_statistics(folder, statistics: DataFrame) -> dict:
    value = {r.metric: r.value for r in statistics.collect()}  # 25 rows
    parsed = {k: json.loads(v) for k, v in value.items()}
    save_json_report(Path(folder) / "ontology_statistics.json", parsed)
    save_csv_report(Path(folder) / "ontology_statistics.csv", statistics, ["metric", "value"])
    return parsed


def save_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Large reports: written by the executors."""
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)


def file_hash(spark, path: str) -> str:
    """SHA-256 of a file's bytes."""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]


def configure_logging(folder, run_id: str, level: int = logging.INFO) -> logging.Logger:
    """To the console and to pipeline.log, each line with the run's id. Handlers of an earlier call are replaced."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    log = logging.getLogger("kgsync")
    for h in list(log.handlers):
        log.removeHandler(h)
        h.close()
    form = logging.Formatter(f"%(asctime)s [{run_id}] %(levelname)s %(name)s: %(message)s")
    for h in (logging.StreamHandler(), logging.FileHandler(Path(folder) / "pipeline.log", encoding="utf-8")):
        h.setFormatter(form)
        log.addHandler(h)
    log.setLevel(level)
    return log
