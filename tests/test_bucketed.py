"""Bucketed tables: a write touches the buckets of its keys only."""
import os

from pyspark.sql import functions as F

from ticklake.sources import bucketed as B
from ticklake.sources import sinks
from ticklake.streaming import incremental as STR


def folders(path):
    return sorted(n for n in os.listdir(path) if n.startswith("bucket="))


def test_a_small_batch_writes_few_buckets(spark, tmp_path):
    table = f"{tmp_path}/t"
    first = spark.range(5000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert len(B.upsert(table, first, ["k"], 1, buckets=1000)) > 900
    batch = spark.createDataFrame([(i * 700, "b") for i in range(10)], "k long, v string")
    touched = B.upsert(table, batch, ["k"], 2, buckets=1000)
    assert len(touched) <= 10 and folders(f"{table}/data/v=0000000002") == sorted(f"bucket={b}" for b in touched)
    want = sinks.upsert(first, batch, ["k"]).collect()
    assert sorted(map(tuple, B.read(spark, table, first.schema).collect())) == sorted(map(tuple, want))
    # again, as after a failure; and the state before it is still there
    B.upsert(table, batch, ["k"], 2, buckets=1000)
    assert sorted(map(tuple, B.read(spark, table, first.schema).collect())) == sorted(map(tuple, want))
    assert B.read(spark, table, first.schema, below=2).where("v = 'b'").count() == 0


def test_a_write_without_manifest_is_not_read(spark, tmp_path):
    table = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    B.upsert(table, df, ["k"], 1, buckets=4)
    df.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{table}/data/v=0000000002")
    assert sorted(map(tuple, B.read(spark, table, df.schema).collect()), key=str) == [(1, "a"), (None, "n")]
    B.upsert(table, df.limit(0), ["k"], 2, buckets=4)  # an empty batch
    assert B.read(spark, table, df.schema).count() == 2
    assert B.read(spark, f"{tmp_path}/none", df.schema).count() == 0


def test_once_ever_over_epochs(spark, tmp_path):
    src = f"{tmp_path}/src"
    for i, keys in enumerate([[1, 2, 2], [2, 3], [1, 3, 4, 9]]):
        spark.createDataFrame([(k,) for k in keys], "k int").coalesce(1).write.mode("append").parquet(src)
    stream = STR.file_stream(spark, src, "k int", max_files=1)
    got = STR.stream_once_ever(stream, ["k"], f"{tmp_path}/out", f"{tmp_path}/c", spark.createDataFrame([(9,)], "k int"))
    assert sorted(r.k for r in got.collect()) == [1, 2, 3, 4] and len(sinks._versions(spark, f"{tmp_path}/out")) == 3
