"""Where the jobs may write intermediate tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a folder of one machine would lose data with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tezgah-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never one used before."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The frame with its lineage cut by a reliable checkpoint.

    Used where a frame is read more than once and must be the same each
    time, also after an executor is lost.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, reader: SparkSession | None = None) -> DataFrame:
    """The frame written to the shared folder as Parquet and read back, by ``reader`` if given.

    As ``cut``, but columnar: later reads open only the columns they use.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


#: Of intermediate files and warehouse tables: smaller than Spark's default.
CODEC = "zstd"
#: Whether Spark removes a query's shuffle files when it ends, and not once the driver collects its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session with another value of a setting, as it was before once the block ends."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: Bytes of shuffled data a task reads at most, so that its sorts and folds fit its memory.
TASK_BYTES = 8 << 20
#: Input rows for each shuffle partition, and the most partitions that are asked for.
ROWS_A_PARTITION, MOST_PARTITIONS = 200_000, 4_000


def sized_tasks(spark: SparkSession, rows: int) -> None:
    """Sets the session so that tasks after a shuffle stay small however large the input is.

    A fixed number of shuffle partitions gives each task more memory to hold the
    more rows there are. Here it is one for each ``ROWS_A_PARTITION``, if that is more
    than the session has; adaptive execution merges small ones up to ``TASK_BYTES``,
    or the size that the session was given.
    """
    conf, number, size = spark.conf, "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    conf.set(number, max(int(conf.get(number)), min(-(-rows // ROWS_A_PARTITION), MOST_PARTITIONS)))
    if conf.get(size, None) is None:
        conf.set(size, TASK_BYTES)
