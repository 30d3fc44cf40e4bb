"""Views, mart tables and report files."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillwright.session import located, path_exists

POINTER = "CURRENT"
# Versions that readers or other rebuilds may still hold are kept for so long.
RETAIN_SECONDS = 24 * 3600


def as_view(frame: DataFrame, name: str) -> DataFrame:
    """Publish a relation that is recomputed by each reader."""
    frame.createOrReplaceTempView(name)
    return frame


def _version(spark: SparkSession, path: str) -> str | None:
    """Folder name of the version that readers see."""
    if not path_exists(spark, f"{path}/{POINTER}"):
        return None
    return spark.read.text(f"{path}/{POINTER}").first()["value"]


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Switch readers to a version: a small file is written aside and renamed over the old one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    system, pointer = located(spark, f"{path}/{POINTER}")
    _, aside = located(spark, f"{path}/{POINTER}-{version}")
    out = system.create(aside, True)
    out.write(bytearray(version.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), conf)
    files.rename(system.makeQualified(aside), system.makeQualified(pointer), overwrite)


def as_table(frame: DataFrame, folder: str, name: str, retain_seconds: float = RETAIN_SECONDS) -> DataFrame:
    """Rebuild a mart below `folder` and read it back.

    The new version is written beside the old ones, and readers see the old one until the pointer is switched: a
    failed job leaves the old mart, and a mart may be rebuilt from itself. Rebuilds at the same time each write
    their own version; the one that switches last is current. Versions are removed by age only, never the current one.
    """
    spark, path = frame.sparkSession, f"{folder.rstrip('/')}/{name}"
    version = f"version-{uuid.uuid4().hex}"
    frame.write.parquet(f"{path}/{version}")
    _point_to(spark, path, version)
    system, top = located(spark, path)
    oldest = (time.time() - retain_seconds) * 1000
    expired = [
        status.getPath() for status in system.listStatus(top)
        if status.getPath().getName().startswith("version-") and status.getModificationTime() < oldest
    ]
    current = _version(spark, path)
    for place in expired:
        if place.getName() not in (version, current):
            system.delete(place, True)
    return spark.read.schema(frame.schema).parquet(f"{path}/{version}")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The current version of a mart."""
    path = f"{folder.rstrip('/')}/{name}"
    version = _version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no mart at {path}")
    return spark.read.parquet(f"{path}/{version}")


def as_csv(frame: DataFrame, path: str, compression: str = "none") -> None:
    """CSV files with a header, one per partition. Compressed ones (`gzip`) are each read by one task."""
    frame.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)


def as_json(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)
