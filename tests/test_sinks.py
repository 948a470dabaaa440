import datetime as dt

import os

import pytest

from vintner.plans.load_store import load_and_store
from vintner.sources import cache, sinks, storage


def frame(spark, rows=((1, "a"), (2, "b")), schema="k int, v string"):
    return spark.createDataFrame(list(rows), schema)


def test_parquet_overwrite_and_append_by_name(spark, folder):
    sink = sinks.make_sink("parquet", folder)
    sink.write("t", frame(spark))
    sink.write("t", frame(spark, [("c", 3, True)], "v string, k int, extra boolean"), overwrite=False)
    rows = sorted(map(tuple, sinks.read(spark, sink.path("t"), merge_schema=True).select("k", "v", "extra").collect()))
    assert rows == [(1, "a", None), (2, "b", None), (3, "c", True)]
    sink.write("t", frame(spark, [(9, "z")]))
    assert sinks.read(spark, sink.path("t")).count() == 1


def test_csv_append_by_position(spark, folder):
    sink = sinks.make_sink("csv", folder)
    sink.write("t", frame(spark), overwrite=False)
    sink.write("t", frame(spark, [(3, "c")], "x int, y string"), overwrite=False)
    stored = spark.read.option("header", True).csv(sink.path("t"))
    assert stored.columns == ["k", "v"]
    assert sorted(map(tuple, stored.collect())) == [("1", "a"), ("2", "b"), ("3", "c")]
    with pytest.raises(ValueError, match="columns"):
        sink.write("t", frame(spark).select("k"), overwrite=False)


def test_csv_renders_lists_and_records(spark, folder):
    sink = sinks.make_sink("csv", folder)
    sink.write("n", spark.createDataFrame([(["a", "b"], (1, True))], "l array<string>, r struct<x: int, y: boolean>"))
    stored = spark.read.option("header", True).csv(sink.path("n")).first()
    assert tuple(stored) == ('["a","b"]', '{"x":1,"y":true}')


def test_table_sink(spark):
    sink = sinks.make_sink("table", spark=spark)
    rows = [(dt.datetime(2024, 1, 2, 3), dt.date(2024, 1, 2), 1)]
    df = spark.createDataFrame(rows, "ts timestamp, d date, n int")
    sink.write("vintner_sink_test", df.limit(0))
    assert not spark.catalog.tableExists("vintner_sink_test")  # nothing is written for no rows
    try:
        sink.write("vintner_sink_test", df)
        sink.write("vintner_sink_test", df, overwrite=False)
        stored = sinks.read(spark, "vintner_sink_test")
        assert stored.columns == ["TS", "D", "N"]
        assert [tuple(r) for r in stored.collect()] == [("2024-01-02", "2024-01-02", 1)] * 2
    finally:
        spark.sql("drop table if exists vintner_sink_test")


@pytest.mark.parametrize(("kind", "message"), [("parquet", "folder"), ("csv", "folder"), ("table", "session"), ("x", "unknown")])
def test_sink_arguments(kind, message):
    with pytest.raises(ValueError, match=message):
        sinks.make_sink(kind)


def test_frames_of_a_destination_are_one_append(spark):
    written = []

    class Recorder:
        def write(self, name, df, overwrite=True):
            written.append((name, df.count(), df.columns, overwrite))

    more = frame(spark, [(3, 1.0)], "k int, w double")
    sinks.append_all({"a": [frame(spark), more], "empty": [frame(spark).limit(0)]}, Recorder())
    assert written == [("a", 3, ["k", "v", "w"], False)]


def test_cache_builds_once_and_repairs_half_written_folders(spark, folder):
    calls = []

    def build():
        calls.append(1)
        return frame(spark)

    for _ in range(2):
        assert cache.load_through(spark, folder, "k", build).count() == 2
    assert len(calls) == 1
    cache.load_through(spark, folder, "k", build, enabled=False)
    assert len(calls) == 2
    stored = f"{folder}/k-{cache.fingerprint([])}.parquet"
    os.remove(f"{stored}/_SUCCESS")
    assert cache.load_through(spark, folder, "k", build).count() == 2
    assert len(calls) == 3


def test_cache_tells_arguments_and_sources_apart(spark, folder):
    frame(spark).write.parquet(f"{folder}/source")
    source = spark.read.parquet(f"{folder}/source")
    load = lambda source, **args: cache.load_through(spark, folder, "k", lambda: source, sources=[source], **args)
    first = load(source, day=1).inputFiles()
    assert load(spark.read.parquet(f"{folder}/source"), day=1).inputFiles() == first
    assert load(source, day=2).inputFiles() != first
    assert load(source.filter("k = 1"), day=1).count() == 1
    frame(spark, [(9, "z")]).write.mode("overwrite").parquet(f"{folder}/source")
    assert [r["k"] for r in load(spark.read.parquet(f"{folder}/source"), day=1).collect()] == [9]


def test_load_and_store(spark, folder):
    sink = sinks.make_sink("parquet", folder)
    load_and_store(lambda: frame(spark), sink, "RAW")
    assert sinks.read(spark, sink.path("RAW")).count() == 2


def test_cut_forgets_the_lineage_in_the_shared_folder(spark):
    df = storage.cut(frame(spark).filter("k > 1"))
    plan = df._jdf.queryExecution().toString()
    assert "Filter" not in plan and "ExistingRDD" in plan
    assert storage.scratch_path(spark, "n").startswith(storage.shared_dir(spark))


def test_shared_dir_is_required_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())
