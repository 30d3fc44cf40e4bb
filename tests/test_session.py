import pytest

from tillwright import session


def test_work_tables_share_a_folder_that_close_removes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_work_folder", lambda spark: str(tmp_path / "work"))
    first, second = session.written(spark.range(5), "one"), session.written(spark.range(7), "two")
    assert (first.count(), second.count()) == (5, 7)
    assert len(list((tmp_path / "work").iterdir())) == 2
    session.close(spark)
    assert not (tmp_path / "work").exists()


def test_the_work_folder_belongs_to_the_application(spark):
    assert f"tillwright-{spark.sparkContext.applicationId}/" in session.work_path(spark, "x")


def test_sizes_are_those_of_the_moment(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    small = session.stored_bytes(spark, path)
    spark.range(100_000).write.mode("append").parquet(path)
    assert session.stored_bytes(spark, path) > small
    assert not session.path_exists(spark, str(tmp_path / "none"))
    with pytest.raises(Exception):
        session.stored_bytes(spark, str(tmp_path / "none"))


def test_tasks_stay_small_as_the_input_grows(spark, monkeypatch):
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for text, size in (("64MB", 64 << 20), ("8m", 8 << 20), ("1024", 1024), ("16k", 16 << 10), ("7b", 7)):
            assert session._byte_size(text) == size
        for own, kept in (("64MB", 16 << 20), ("8m", 8 << 20)):
            spark.conf.set(names[1], own)
            for stored in (1 << 30, 6 << 30, 100 << 30):
                monkeypatch.setattr(session, "stored_bytes", lambda spark, path: stored)
                session.tune(spark, "input")
                assert stored / int(spark.conf.get(names[0])) <= 16 << 20
                assert session._byte_size(spark.conf.get(names[1])) == kept
        monkeypatch.setattr(session, "stored_bytes", lambda spark, path: 100 << 40)
        session.tune(spark, "input")
        assert int(spark.conf.get(names[0])) == 25_600
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
