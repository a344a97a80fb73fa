"""Session defaults and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Settings that may change in a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JIT compiler skips methods above 8000 bytes; Spark then falls back to smaller generated methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
DEFAULT_PARTITIONS = "200"
TASKS_PER_CORE = 4
OWN_PARTITIONS = "spark.evenhand.initialPartitionNum"
PART_BYTES = 128 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MAX_PARTS = 100_000  # a million map tasks with as many parts each would be too many blocks


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings this package relies on to a session that somebody else built.

    Where the number of shuffle parts was left at Spark's default it is fitted to the cores. On a cluster
    shuffles start with several parts per core: adaptive execution merges small parts but cannot split the few
    large ones that the default would give. A local session gets one per core, which streaming state needs most:
    its parts are never merged.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    if spark.conf.get(SHUFFLE_PARTITIONS) == DEFAULT_PARTITIONS:
        if spark.sparkContext.master.startswith("local"):
            spark.conf.set(SHUFFLE_PARTITIONS, str(cores))
        elif spark.conf.get(INITIAL_PARTITIONS, None) is None and TASKS_PER_CORE * cores > int(DEFAULT_PARTITIONS):
            spark.conf.set(INITIAL_PARTITIONS, str(TASKS_PER_CORE * cores))
    return spark


def fit_shuffles(*inputs: DataFrame) -> int | None:
    """Let shuffles start with enough parts for these inputs, PART_BYTES each by Spark's own estimate of their size.

    A number of parts by cores alone makes parts grow with the data. Adaptive execution merges the small ones. Numbers
    that somebody chose are kept; returns what was set.
    """
    spark = inputs[0].sparkSession
    chosen = spark.conf.get(SHUFFLE_PARTITIONS) != DEFAULT_PARTITIONS or spark.conf.get(INITIAL_PARTITIONS, None) not in (None, _set_parts(spark))
    if chosen or spark.sparkContext.master.startswith("local"):
        return None
    size = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs)
    parts = min(MAX_PARTS, max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-size // PART_BYTES)))
    spark.conf.set(INITIAL_PARTITIONS, str(parts))
    spark.conf.set(OWN_PARTITIONS, str(parts))
    return parts


def _set_parts(spark: SparkSession) -> str | None:
    """What this package set itself."""
    own = spark.conf.get(OWN_PARTITIONS, None)
    by_cores = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return own or (by_cores if spark.conf.get(INITIAL_PARTITIONS, None) == by_cores else None)


def build_session(app: str = "evenhand", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``.

    A temporary folder stands in only where that setting is absent and everything runs in one local process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="evenhand-")
    return f"{base.rstrip('/')}/evenhand-{label}-{uuid.uuid4().hex}"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that are made and run herein go when the query ends, not when the driver collects garbage.

    For queries that run once and whose result is collected or written.
    """
    chosen = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if chosen is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, chosen)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder.

    For rows that several steps read: their lineage runs once, and a lost executor costs no recomputation. The table
    goes when the driver ends.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.parquet(path)
