"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only settings that change how skew is handled; sizes stay with the cluster's own configuration.
_RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot order or part is split even when the aggregate above then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort where every shuffled build partition turns out to be this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}

# Stored input per shuffle partition, up to so many partitions; beyond them, a larger share of input for each.
_INPUT_PER_PARTITION, _MOST_PARTITIONS, _LARGE_INPUT_PER_PARTITION = 16 << 20, 10_000, 4 << 30
# Shuffled bytes that adaptive execution merges into one task. Sums by product and order take some thirty times their
# shuffled size in a task's hash tables.
_MERGED = 16 << 20


def local_session(cores: int | str = "*", app: str = "tillwright") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _byte_size(text: str) -> int:
    """A size setting such as `64MB`, `8m` or `1024` in bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * (" kmgtp".index(unit) if unit else 0)


def tune(spark: SparkSession, *inputs: str) -> SparkSession:
    """Adaptive settings for the given session, with enough shuffle partitions for the input paths.

    Adaptive execution merges small partitions but never cuts large ones, so the first number has to
    grow with the input. It never falls below the session's own number, and merged partitions stay small.
    """
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    if inputs:
        own = int(spark.conf.get("spark.sql.shuffle.partitions"))
        stored = sum(stored_bytes(spark, path) for path in inputs)
        needed = max(min(-(-stored // _INPUT_PER_PARTITION), _MOST_PARTITIONS), -(-stored // _LARGE_INPUT_PER_PARTITION))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(own, needed)))
        merged = min(_byte_size(spark.conf.get(_ADVISORY)), _MERGED)
        spark.conf.set(_ADVISORY, f"{merged}b")
    return spark


def located(spark: SparkSession, path: str):
    """The Hadoop file system and path of a location."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = located(spark, path)
    return system.exists(place)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a stored table, from the file system's own summary."""
    system, place = located(spark, path)
    return system.getContentSummary(place).getLength()


def _work_folder(spark: SparkSession) -> str:
    """This application's folder below the cluster's `spark.checkpoint.dir`.

    A machine-local folder is used only in local mode, where one machine holds all executors.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillwright-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/tillwright-{context.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """New folder for a written table of this application."""
    return f"{_work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def close(spark: SparkSession) -> None:
    """Remove all tables that this application wrote for its own use. Call it when no result is read any more."""
    system, folder = located(spark, _work_folder(spark))
    system.delete(folder, True)


def written(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame once and read it back.

    Used where several branches need one costly result. The table cuts the lineage, survives lost
    executors, reads back in a fixed order, and gives Catalyst a real size, so that it broadcasts
    the table only below `spark.sql.autoBroadcastJoinThreshold`.
    """
    path = work_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
