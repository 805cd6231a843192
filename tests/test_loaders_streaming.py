"""Overrides loader, strict insert and streaming re-runs."""
import json

from pyspark.sql import functions as F

from ticklake.operators import financials as fin
from ticklake.sources import sinks
from ticklake.streaming import incremental as STR


def test_load_overrides_json(spark, tmp_path):
    p = tmp_path / "overrides.json"
    p.write_text(json.dumps({"overrides": [{"concept": "custom:CustomMetric", "line_code": "revenue"},
                                           {"concept": "", "line_code": "x"},
                                           {"concept": "y", "line_code": None}]}))
    got = {r.key: r.line_code for r in fin.load_overrides(spark, str(p)).collect()}
    assert got == {"custom:CustomMetric": "revenue", "custommetric": "revenue"}


def test_insert_unique_ok(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "b")], "k int, v string")
    assert sorted(r.k for r in sinks.insert_unique(target, source, ["k"]).collect()) == [1, 2]


def test_stream_upsert_rerun_is_idempotent(spark, tmp_path):
    src = tmp_path / "src"
    rows = [(1, "2024-01-01 00:00:01", 7, "view", 1.0, "{}"), (2, "2024-01-01 00:00:02", 7, "view", 2.0, "{}"),
            (3, "2024-01-01 00:00:03", 8, "click", 3.0, "{}")]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, "
                                     "props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.parquet(str(src / "part1"))
    root = STR.scratch(spark, "test-upsert")
    stream = STR.file_stream(spark, str(src / "part1"), STR.EVENTS_SCHEMA)
    t1 = STR.stream_upsert(stream, f"{root}/table", ["user_id", "event_type"], ["ts", "event_id"],
                           f"{root}/_checkpoint")
    first = sorted((r.user_id, r.event_id) for r in t1.collect())
    assert first == [(7, 2), (8, 3)]
    # same checkpoint, nothing new: the published table does not change
    stream = STR.file_stream(spark, str(src / "part1"), STR.EVENTS_SCHEMA)
    t2 = STR.stream_upsert(stream, f"{root}/table", ["user_id", "event_type"], ["ts", "event_id"],
                           f"{root}/_checkpoint")
    assert sorted((r.user_id, r.event_id) for r in t2.collect()) == first
