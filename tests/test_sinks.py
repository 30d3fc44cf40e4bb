"""Marts rebuilt side by side, log reads that open the newest days only, and logs with several writers."""

import os
import time
from datetime import datetime, timedelta
from multiprocessing.pool import ThreadPool

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from tillwright.sinks import forecast_log, tables


def versions(folder):
    return sorted(n for n in os.listdir(f"{folder}/m") if n.startswith("version-"))


def test_interleaved_rebuilds_keep_each_others_data(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    frame = lambda n: spark.range(n, n + 3)
    ids = lambda rows: sorted(r["id"] for r in rows.collect())
    tables.as_table(frame(0), folder, "m")
    held = tables.read_table(spark, folder, "m")
    point, inner = tables._point_to, []

    def interrupted(session, path, version):
        if not inner:  # another writer rebuilds the mart before this one switches
            inner.append(None)
            inner[0] = tables.as_table(frame(20), folder, "m")
        point(session, path, version)

    monkeypatch.setattr(tables, "_point_to", interrupted)
    outer = tables.as_table(frame(10), folder, "m")
    assert ids(outer) == ids(tables.read_table(spark, folder, "m")) == [10, 11, 12]
    assert ids(inner[0]) == [20, 21, 22] and ids(held) == [0, 1, 2]
    assert len(versions(folder)) == 3


def test_versions_go_by_age(spark, tmp_path):
    folder = str(tmp_path)
    for n in range(3):
        tables.as_table(spark.range(n), folder, "m")
    for name in versions(folder):
        os.utime(f"{folder}/m/{name}", (time.time() - 7200,) * 2)
    tables.as_table(spark.range(9), folder, "m", retain_seconds=3600)
    assert len(versions(folder)) == 1 and tables.read_table(spark, folder, "m").count() == 9


def test_latest_forecasts_open_the_newest_days(spark, tmp_path):
    path, start = str(tmp_path / "log"), datetime(2020, 1, 1)
    rows = [(n, "rf", {}, None, *[1.0] * 3, 1, 1.0, 1.0, float(n), start + timedelta(days=n // 4)) for n in range(1, 40)]
    frame = spark.createDataFrame(rows, forecast_log.LOG_SCHEMA)
    frame.withColumn(forecast_log.DAY, F.to_date("created_at")).write.partitionBy(forecast_log.DAY).parquet(path)
    for limit in (1, 4, 5, 30, 100):
        found = forecast_log.latest_forecasts(spark, path, limit)
        assert [r["id"] for r in found.collect()] == list(range(39, 0, -1))[:limit]
        days = {os.path.basename(os.path.dirname(f)) for f in found.inputFiles()}
        assert len(days) <= -(-limit // 4) + 1 if limit < 39 else len(days) == 10
    assert forecast_log.latest_forecasts(spark, str(tmp_path / "none")).collect() == []


def forecasts(spark, tmp_path, name, rows):
    made = spark.range(rows).selectExpr(
        f"'{name}' AS model", "concat('s', id) AS s", "date'2020-01-01' AS target_month", "1D AS lag_1", "1D AS lag_2",
        "1D AS lag_3", "1 AS month_of_year", "1D AS rolling_mean_3", "1D AS rolling_mean_6", "cast(id AS double) AS prediction",
    )
    made.repartition(3).write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def logged(spark, path):
    rows = [r for day in forecast_log._days(spark, path) for r in spark.read.schema(forecast_log.LOG_SCHEMA).parquet(day).collect()]
    return sorted(rows, key=lambda r: r["id"])


def test_a_writer_that_was_overtaken_takes_the_next_ids(spark, tmp_path, monkeypatch):
    path, publish, overtaken = str(tmp_path / "log"), forecast_log._published, []
    outer, inner = forecasts(spark, tmp_path, "outer", 7), forecasts(spark, tmp_path, "inner", 5)

    def interrupted(session, content, place):
        if not overtaken:  # another writer logs its rows between this one's look and its commit
            overtaken.append(place)
            forecast_log.append_forecasts(inner, path, ["s"])
            assert publish(session, content, place) is False
            return False
        return publish(session, content, place)

    monkeypatch.setattr(forecast_log, "_published", interrupted)
    forecast_log.append_forecasts(outer, path, ["s"])
    rows = logged(spark, path)
    assert [r["id"] for r in rows] == list(range(1, 13)) and [r["model"] for r in rows] == ["inner"] * 5 + ["outer"] * 7
    assert [r["created_at"] for r in rows] == sorted(r["created_at"] for r in rows)
    assert not [n for n in os.listdir(path) if n.startswith("_aside")]
    assert forecast_log.latest_forecasts(spark, path, 8).count() == 8


def test_writers_at_the_same_time_get_dense_different_ids(spark, tmp_path):
    path, parts = str(tmp_path / "log"), [forecasts(spark, tmp_path, f"m{n}", n + 1) for n in range(6)]
    with ThreadPool(6) as pool:
        pool.map(inheritable_thread_target(spark)(lambda part: forecast_log.append_forecasts(part, path, ["s"])), parts)
    rows = logged(spark, path)
    assert [r["id"] for r in rows] == list(range(1, 22))
    by_model = {}
    for r in rows:
        by_model.setdefault(r["model"], []).append(r["id"])
    assert all(ids == list(range(ids[0], ids[0] + int(m[1:]) + 1)) for m, ids in by_model.items())
    # The log's own partitions are found by a plain read of it, too.
    assert spark.read.parquet(path).count() == 21


def test_logs_without_reservations_go_on_and_failed_writes_leave_no_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    old = spark.createDataFrame([(41, "rf", {}, None, *[1.0] * 3, 1, 1.0, 1.0, 1.0, datetime(2020, 1, 1))], forecast_log.LOG_SCHEMA)
    old.withColumn(forecast_log.DAY, F.to_date("created_at")).write.partitionBy(forecast_log.DAY).parquet(path)
    with monkeypatch.context() as broken, pytest.raises(ZeroDivisionError):
        broken.setattr(forecast_log, "numbered", lambda rows, first: 1 / 0)
        forecast_log.append_forecasts(forecasts(spark, tmp_path, "broken", 2), path, ["s"])
    forecast_log.append_forecasts(forecasts(spark, tmp_path, "none", 0), path, ["s"])
    forecast_log.append_forecasts(forecasts(spark, tmp_path, "next", 2), path, ["s"])
    assert [(r["id"], r["model"]) for r in logged(spark, path)] == [(41, "rf"), (44, "next"), (45, "next")]


def test_compressed_csv_reads_back_the_same(spark, tmp_path):
    frame = spark.range(5000).selectExpr("id", "concat('order ', id % 7, ', \"x\"') AS text", "nullif(id % 3, 1) AS few")
    for name, codec in (("plain", []), ("small", ["gzip"])):
        tables.as_csv(frame, str(tmp_path / name), *codec)
    size = {n: sum(f.stat().st_size for f in (tmp_path / n).glob("part-*")) for n in ("plain", "small")}
    assert size["small"] * 3 < size["plain"]
    read = spark.read.schema(frame.schema).option("header", True).option("enforceSchema", False).csv(str(tmp_path / "small"))
    assert sorted(read.collect()) == sorted(frame.collect())
