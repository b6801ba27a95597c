"""What the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from ..written import checkpointed, remove, shared_folder

#: ASCII white space: U+0020 and U+0009 to U+000D. Words are the runs of all other characters.
SPACES = " \t\n\x0b\x0c\r"
#: Text bytes for each lane of a keyed exchange whose lanes are held in memory one at a time.
LANE_BYTES = 32 << 20
#: Lanes into which one exchange deals; with more of them the rows of a block would become too small.
MOST_LANES = 4096
#: Text bytes for each partition of such an exchange.
PARTITION_BYTES = 128 << 20

_work: contextvars.ContextVar[str | None] = contextvars.ContextVar("kgsync_work", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only on a local master where none is set (tests)."""
    return shared_folder(spark)


def remove_folder(spark: SparkSession, folder: str) -> None:
    remove(spark, folder)


@contextlib.contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared one for the tables that are written down meanwhile; removed at the end, when what was made of them must be written."""
    folder = f"{checkpoint_dir(spark)}/work-{uuid.uuid4().hex}"
    token = _work.set(folder)
    try:
        yield folder
    finally:
        _work.reset(token)
        remove_folder(spark, folder)


def write_down(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, read back with its columns pruned; survives the loss of any executor."""
    folder = f"{_work.get() or checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: survives the loss of any executor."""
    return checkpointed(df)


def lanes(spark: SparkSession) -> int:
    """How many partitions a keyed exchange should have; the cluster's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one scan of that column."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def deal(spark: SparkSession, size: int) -> tuple[int, int]:
    """Partitions and lanes of a keyed exchange of so many text bytes: both grow with the input, neither task nor lane does."""
    parts = max(lanes(spark), -(-size // PARTITION_BYTES))
    return parts, max(2 * lanes(spark), -(-size // LANE_BYTES))


def arrow(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow, for workers that can import this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def let(value: Column, body) -> Column:
    """Evaluate `value` once and use it many times in `body` (a one-element transform)."""
    return F.transform(F.array(value), body)[0]
