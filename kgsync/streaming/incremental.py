"""Incremental loading: new N-Triples files become rows of a triples table, each file once.

The checkpoint remembers which files were read; a batch that runs again writes nothing twice, as triples
are compared with those that the table has in the buckets (a hash of the subject, by which the table is
laid out) that the batch touches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.rdf import ntriples
from ..sources.triples import TableSource
from ..terms import TRIPLES
from ..written import exists

BUCKETS = 256


def append_new(batch: DataFrame, table: str) -> None:
    """Adds the triples that the table does not have. Any fault in reading it is one: nothing is added then."""
    spark = batch.sparkSession
    rows = batch.distinct().withColumn("bucket", F.pmod(F.xxhash64("s"), F.lit(BUCKETS)).cast("int"))
    if exists(spark, table):
        touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # BUCKETS numbers at most
        old = spark.read.schema(f"{TRIPLES}, bucket int").parquet(table).where(F.col("bucket").isin(touched))
        same = reduce(Column.__and__, (rows[c].eqNullSafe(old[c]) for c in rows.columns))
        rows = rows.join(old, same, "left_anti")
    rows.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(table)


def source(spark: SparkSession, table: str) -> TableSource:
    """The table as a graph; what is in it is a set already."""
    names = [c.split()[0] for c in TRIPLES.split(", ")]
    return TableSource(spark.read.schema(f"{TRIPLES}, bucket int").parquet(table).select(*names), distinct=False)


def stream_ntriples(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """Reads what is there and what comes; `awaitTermination` or `processAllAvailable` as usual."""
    lines = spark.readStream.text(folder)
    return lines.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: append_new(ntriples(batch), table)).start()
