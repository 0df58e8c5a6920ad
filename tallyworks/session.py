"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1024 * 1024

# A shuffle has (scan tasks) x (shuffle partitions) blocks, so both are bounded: at
# 100 TB about 100,000 scan tasks of 1 GB meet 30,000 partitions. Queries shuffle a few
# columns only, which leaves well under 1 GB in a partition.
SCAN_SPLIT = 128 * MB
MAX_SCAN_SPLIT = 1024 * MB
SCAN_TASKS = 100_000
BYTES_PER_PARTITION = 256 * MB
MAX_PARTITIONS = 30_000

_RUNTIME_SETTINGS = {
    # Log lines carry no zone: parsing must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast by its bytes, as measured while the query runs.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * MB),
    # Split a hot join key even where a later groupBy has to shuffle again for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_input_bytes: dict[tuple[str, str], int] = {}


def tune(spark: SparkSession, data_dir: str | None = None) -> SparkSession:
    """Apply the settings the operators expect; size shuffles for ``data_dir``."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if data_dir is not None:
        mark = (spark.sparkContext.applicationId, data_dir)
        if mark not in _input_bytes:
            _input_bytes[mark] = input_bytes(spark, data_dir)
        size_tasks(spark, _input_bytes[mark])
    return spark


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files under a path. The files are listed, not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.agg(F.sum("length")).first()[0] or 0


def partitions_for(size: int) -> int:
    return min(MAX_PARTITIONS, max(1, math.ceil(size / BYTES_PER_PARTITION)))


def scan_split_for(size: int) -> int:
    return min(MAX_SCAN_SPLIT, max(SCAN_SPLIT, math.ceil(size / SCAN_TASKS)))


def size_tasks(spark: SparkSession, size: int) -> None:
    """Raise shuffle partitions and scan splits where the input calls for more.

    The shuffle starts with the raised number; AQE merges what turns out small.
    """
    partitions = partitions_for(size)
    if partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        )
    if scan_split_for(size) > SCAN_SPLIT:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(scan_split_for(size)))


def spread_evenly(df: DataFrame) -> DataFrame:
    """``df`` in as many equal parts as shuffles have, for costly work on each row.

    A scan is cut by bytes: millions of short rows may come in one split.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shared_root(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the cluster names it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tallyworks-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; each call gives another one."""
    return f"{shared_root(spark)}/tallyworks/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute a small ``df`` now and keep it in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_path(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def keep_table(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and keep it as a table in the shared folder: for any size."""
    path = work_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
