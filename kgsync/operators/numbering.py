"""Dense numbers in an order, without a window over all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..written import checkpointed


def numbered(df: DataFrame, *order: Column | str, name: str = "n") -> DataFrame:
    """Adds 1, 2, 3 ... in the given order, which must be total.

    Rows are range-partitioned and sorted; the result is written down, as ranges found by sampling may
    differ from one evaluation to the next; one count for each partition meets in one place.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = checkpointed(placed).withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_id", "_part", "_at", "_before")
