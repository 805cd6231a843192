"""Streams run over several micro-batches, with late and repeated rows, and
again after failures."""
import shutil

import pytest
from pyspark.sql import functions as F

from ticklake.operators import evals
from ticklake.sources import sinks
from ticklake.streaming import incremental as STR

SCHEMA = "event_id long, ts string, user_id long, event_type string, value double, props string"
#: three files: new rows, then late and repeated ones
FILES = [[(1, "2024-01-01 00:00:05", 7, "view"), (2, "2024-01-01 00:00:09", 8, "view"), (3, "2024-01-01 00:00:01", 7, "view")],
         [(4, "2024-01-01 00:00:04", 7, "view"), (5, "2024-01-02 00:00:00", 8, "view"), (2, "2024-01-01 00:00:09", 8, "view")],
         [(6, "2024-03-01 00:00:00", 9, "click"), (1, "2024-01-01 00:00:05", 7, "view"), (7, "2024-03-01 00:00:00", 7, "click")]]


@pytest.fixture
def source(spark, tmp_path):
    folder = tmp_path / "src"
    folder.mkdir()
    for i, rows in enumerate(FILES):
        df = spark.createDataFrame([(*r, 1.0, "{}") for r in rows], SCHEMA).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1)
        df.write.parquet(str(tmp_path / f"w{i}"))
        part = next(p for p in (tmp_path / f"w{i}").iterdir() if p.name.endswith(".parquet"))
        shutil.copy(part, folder / f"{i}.parquet")
    return str(folder)


def stream(spark, source):
    return STR.file_stream(spark, source, STR.EVENTS_SCHEMA, max_files=1)


def test_newer_rows_again_after_a_lost_commit(spark, source):
    root = STR.scratch(spark, "t-newer")

    def run(checkpoint):
        got = STR.stream_newer(stream(spark, source), f"{root}/marks", f"{root}/out", "user_id", "ts", f"{root}/{checkpoint}")
        return sorted(r.event_id for r in got.collect())

    first = run("a")
    assert len(sinks._versions(spark, f"{root}/out")) == 3
    assert run("b") == first  # all epochs once more over the same tables
    assert {6, 7} <= set(first) and 4 not in first


def test_upsert_again_and_without_a_version(spark, source):
    root = STR.scratch(spark, "t-upsert")

    def run(checkpoint):
        got = STR.stream_upsert(stream(spark, source), f"{root}/t", ["user_id", "event_type"], ["ts", "event_id"], f"{root}/{checkpoint}")
        return sorted((r.user_id, r.event_type, r.event_id) for r in got.collect())

    assert run("a") == run("b")
    # an unfinished version is not read
    sinks.write_version(spark.range(3), f"{root}/t", 99)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/t/v=0000000099/_SUCCESS")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    assert run("c") == run("a")


def test_once_for_all_time(spark, source):
    root = STR.scratch(spark, "t-once")
    known = spark.createDataFrame([(9,)], "user_id long")

    def run(checkpoint):
        got = STR.stream_once_ever(stream(spark, source), ["user_id"], f"{root}/out", f"{root}/{checkpoint}", known)
        return sorted(r.user_id for r in got.collect())

    assert run("a") == [7, 8] and run("b") == [7, 8]


def test_snapshots(spark):
    root = STR.scratch(spark, "t-snap")
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, root)
    for n in (3, 5):
        sinks.write_snapshot(spark.range(n), root)
        assert sinks.read_current(spark, root).count() == n
    assert sinks.read_below(spark, root, 1).count() == 3 and sinks.read_below(spark, root, 0) is None


def test_deep_trees_cycles_and_orphans(spark):
    chain = [(i, i - 1 if i % 1000 else None) for i in range(3000)]
    odd = [(5001, 5002), (5002, 5003), (5003, 5001), (6001, 999999), (6002, 6001), (7001, 7001)]
    df = spark.createDataFrame(chain + odd, "id long, parent_trace_id long")
    got = {r.id: (r.root_id, r.depth) for r in evals.trace_tree(spark, df).collect()}
    assert got == {i: (i - i % 1000, i % 1000) for i in range(3000)}
    assert evals.trace_tree(spark, df, max_depth=2).count() == 9
    assert evals.trace_tree(spark, df.where("id > 5000")).count() == 0


def test_results_follow_a_changed_directory(spark, tmp_path):
    from ticklake.sources import fixtures as fx
    schema = "c_custkey long, c_name string, c_acctbal double, c_mktsegment string"
    for n in (10, 20):
        spark.createDataFrame([(i, f"n{i}", 1.0, "BUILDING") for i in range(n)], schema).write.mode("overwrite").parquet(str(tmp_path / "customer.parquet"))
        spark.catalog.clearCache()
        assert fx.ticker(spark, str(tmp_path)).count() == n


def test_upsert_keeps_rows_without_a_key(spark):
    target = spark.createDataFrame([(1, "a", "x"), (None, "b", "y")], "k int, v string, w string")
    source = spark.createDataFrame([(1, "A"), (None, "B"), (2, "C")], "k int, v string")
    got = sorted(sinks.upsert(target, source, ["k"], order=["v"]).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(1, "A", "x"), (2, "C", None), (None, "B", None), (None, "b", "y")], key=str)
