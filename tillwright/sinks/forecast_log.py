"""Append-only log of forecasts.

One schema for every run: the series a forecast belongs to is a map of its columns, empty for a single
series. Rows are partitioned by the day they were logged. Any number of writers may append at once: each reserves its
range of ids by a small commit file that only one of them can create.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.contract import FEATURES
from tillwright.session import located, path_exists

# Columns of a log row, and the bounds and default of a log read.
LOG_SCHEMA = (
    "id bigint, model string, series map<string,string>, target_month date, lag_1 double, lag_2 double, lag_3 double, "
    "month_of_year int, rolling_mean_3 double, rolling_mean_6 double, prediction double, created_at timestamp"
)
MAX_READ = 100
DEFAULT_READ = 10
DAY = "created_on"
COMMITS = "_id_ranges"

_ROW_BITS = 33  # monotonically_increasing_id() holds the partition above 33 bits of row number


def numbered(frame: DataFrame, first: int) -> DataFrame:
    """Dense ids from `first` on, without moving the rows into one task.

    Ids are the row's place in its partition plus the rows of the partitions before it. Both sides
    must number the same rows, so `frame` has to be a written table.
    """
    placed = frame.withColumn("_place", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_place", _ROW_BITS)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    row = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return placed.join(offsets, "_part").select((first + F.col("_offset") + row).alias("id"), *frame.columns)


def _days(spark: SparkSession, path: str) -> list[str]:
    """Folders of the logged days, the newest first."""
    if not path_exists(spark, path):
        return []
    system, top = located(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(top)]
    return [f"{path.rstrip('/')}/{name}" for name in sorted(names, reverse=True) if name.startswith(f"{DAY}=")]


def _last_id(spark: SparkSession, path: str) -> int:
    """Highest id of the newest day: ids only grow."""
    days = _days(spark, path)
    if not days:
        return 0
    newest = spark.read.schema("id bigint").parquet(days[0])
    return newest.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).first()["id"]


def _published(spark: SparkSession, content: str, path: str) -> bool:
    """Create a small file with its whole content; False if another writer has created it.

    Renaming onto an existing file fails in HDFS and alike. A local rename would replace it, a link does not. Stores
    without an atomic rename are not for logs with several writers.
    """
    system, place = located(spark, path)
    _, aside = located(spark, f"{path}-{uuid.uuid4().hex}")
    out = system.create(aside, False)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        if system.getScheme() != "file":
            return system.rename(aside, place)
        files, java_path = spark.sparkContext._jvm.java.nio.file.Files, spark.sparkContext._jvm.java.nio.file.Path
        try:
            files.createLink(java_path.of(place.toUri().getPath(), _none(spark)), java_path.of(aside.toUri().getPath(), _none(spark)))
            return True
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
    finally:
        system.delete(aside, False)


def _none(spark: SparkSession):
    """The empty rest of a Java call's arguments."""
    return spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.String, 0)


def _last_commit(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number of the last reservation, the last id it took, and its time in microseconds."""
    commits = f"{path.rstrip('/')}/{COMMITS}"
    numbers = []
    if path_exists(spark, commits):
        system, top = located(spark, commits)
        numbers = [int(n) for n in (s.getPath().getName() for s in system.listStatus(top)) if n.isdigit()]
    if not numbers:
        return 0, _last_id(spark, path), 0
    newest = max(numbers)
    found = json.loads(spark.read.option("wholetext", True).text(f"{commits}/{newest:012d}").first()["value"])
    return newest, found["last_id"], found["micros"]


def reserve_ids(spark: SparkSession, path: str, count: int) -> tuple[int, int]:
    """Reserve `count` ids: the first of them, and a time not before that of any smaller id, in microseconds.

    Ranges follow each other without gaps. Where another writer was faster, the next range is tried.
    """
    while True:
        number, last, micros = _last_commit(spark, path)
        micros = max(micros, time.time_ns() // 1000)
        content = json.dumps({"last_id": last + count, "micros": micros})
        if _published(spark, content, f"{path.rstrip('/')}/{COMMITS}/{number + 1:012d}"):
            return last + 1, micros


def append_forecasts(forecasts: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Append forecasts with the features they came from; several writers may do so at once.

    `forecasts` is a written table of (keys, model, target_month, features, prediction). Rows are written aside, since
    two jobs that write to one folder remove each other's unfinished files, and then moved file by file: a reader may
    see some of a run's files before the others. A writer that fails leaves its range of ids unused. No rows change nothing.
    """
    spark, count = forecasts.sparkSession, forecasts.count()
    if not count:
        return
    first, micros = reserve_ids(spark, path, count)
    pairs = [x for key in keys for x in (F.lit(key), F.col(key).cast("string"))]
    series = F.create_map(*pairs).cast("map<string,string>")
    created = F.timestamp_micros(F.lit(micros)).alias("created_at")
    rows = forecasts.select("model", series.alias("series"), "target_month", *FEATURES, "prediction", created)
    logged = numbered(rows, first).to(spark.createDataFrame([], LOG_SCHEMA).schema)
    aside = f"{path.rstrip('/')}/_aside-{uuid.uuid4().hex}"
    system, staged = located(spark, aside)
    try:
        logged.withColumn(DAY, F.to_date("created_at")).write.partitionBy(DAY).parquet(aside)
        for day in _days(spark, aside):
            target = f"{path.rstrip('/')}/{day.rsplit('/', 1)[1]}"
            system.mkdirs(located(spark, target)[1])
            for status in system.listStatus(located(spark, day)[1]):
                name = status.getPath().getName()  # holds the job's own id
                if name.startswith("part-") and not system.rename(status.getPath(), located(spark, f"{target}/{name}")[1]):
                    raise OSError(f"{name} was not moved to {target}")
    finally:
        system.delete(staged, True)


def latest_forecasts(spark: SparkSession, path: str, limit: int = DEFAULT_READ) -> DataFrame:
    """The newest log rows, latest first. Ids grow with the days, so days are opened from the newest on, until they
    hold enough rows; older ones are not read."""
    if not 1 <= limit <= MAX_READ:
        raise ValueError(f"limit must lie between 1 and {MAX_READ}")
    found, opened = 0, []
    for day in _days(spark, path):
        opened.append(day)
        found += spark.read.schema(LOG_SCHEMA).parquet(day).count()  # from the files' footers
        if found >= limit:
            break
    if not opened:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(*opened).orderBy(F.desc("id")).limit(limit)
