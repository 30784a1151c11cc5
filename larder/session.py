"""Session settings and the shared folder used for cutting lineage and scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "larder", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; anything the cluster already sets can be overridden in ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``. Where it is unset, a local master uses the warehouse folder, and
    a cluster is refused: its executors would each write to a disk of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/larder/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: the lineage is cut, and the result survives the loss of any executor.

    A written table is preferred to a checkpoint because its size is known to the planner and because it does not carry
    the plan's constraints along, which pile up over the rounds of an iterative job.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop_cut(*tables: DataFrame) -> None:
    """Remove what ``cut`` wrote, once nothing reads it any more: a round of an iteration whose successor is written."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def keep(df: DataFrame) -> DataFrame:
    """Hold a small aggregate that several later steps read; what an executor loses is worked out again."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def broadcast_if_within(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Hint a broadcast only after counting the rows; beyond ``max_rows`` the join stays a shuffled one.

    ``df`` should be small to recompute (a dimension or a kept aggregate): at most ``max_rows + 1`` rows
    are counted.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread_scan(df: DataFrame, *keys: str) -> DataFrame:
    """A scan in fewer parts than there are slots is dealt out, so that costly expressions use all of them; a scan of
    many parts stays as it is."""
    slots = parallelism(df.sparkSession)
    return df.repartition(slots, *keys) if df.rdd.getNumPartitions() < slots else df


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def tasks_for(spark: SparkSession, pieces: int) -> int:
    """Tasks for so many pieces of work: no more than there are pieces, a few per slot at most."""
    return max(1, min(4 * parallelism(spark), pieces))


# Rows that a task sorts, joins or adds up at a time, and bytes of a file that it reads, where a job's tasks are cut to size.
PART_ROWS, PART_BYTES = 250_000, 16 << 20


@contextmanager
def tasks_of(spark: SparkSession, rows: int, part_rows: int = PART_ROWS) -> Iterator[int]:
    """What is worked out inside is dealt out by the rows, about ``part_rows`` to a task, and not into a fixed number of parts: a task's memory then stays
    as it is when the input grows. Only what ends inside (``cut``, ``first``) is held to it; the session's settings come back after that."""
    parts = max(spark.sparkContext.defaultParallelism, -(-rows // part_rows))
    wanted = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": str(PART_BYTES),
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield parts
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
