"""Structured Streaming forms of the incremental jobs.

Sources are file streams (``readStream`` with an explicit schema); sinks are
versioned parquet tables written from ``foreachBatch``.  Keyed tables are bucketed
(``sources.bucketed``): an epoch reads and writes the buckets of its keys only.
Epoch e writes version e + 1 (0 may hold what was there before the stream) and
reads the newest complete version below it.  An epoch that is run again, after a failure at any
point, therefore reads what it read before and writes the same version again:
the table is exactly-once.  A table belongs to one stream and its checkpoint.
Checkpoints and tables live below ``spark.checkpoint.dir`` (shared storage).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path
from ..sources import bucketed, sinks

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(directory)


def run_available(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str,
                  output_mode: str = "append") -> None:
    """Process everything available now and stop (``trigger(availableNow)``)."""
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(batch_fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_upsert(stream: DataFrame, table_dir: str, keys: Sequence[str], order: Sequence[str],
                  checkpoint: str, buckets: int = bucketed.BUCKETS) -> DataFrame:
    """Keep a keyed table current from a stream (upsert per micro-batch,
    last row by ``order`` wins).  Returns the published table."""
    def batch(df: DataFrame, epoch: int) -> None:
        bucketed.upsert(table_dir, df, list(keys), epoch + 1, buckets=buckets, order=list(order), winner="last")

    run_available(stream, batch, checkpoint)
    return bucketed.read(stream.sparkSession, table_dir, stream.schema)


def stream_once(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Each key processed once while its duplicates can still arrive
    (``dropDuplicatesWithinWatermark``; NTZ event time is cast to TIMESTAMP)."""
    s = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return s.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_once_ever(stream: DataFrame, keys: Sequence[str], out_dir: str, checkpoint: str,
                     known: DataFrame | None = None) -> DataFrame:
    """I2 (+J5): each key processed once for all time, whenever its duplicates
    come, and not at all if ``known`` holds it.

    The keys seen are state of the stream (``dropDuplicates`` without a
    watermark), so an epoch costs what its own rows cost, however long the
    stream has run; only keys that are new look at ``known``.  Every epoch
    writes its new keys to a folder of its own.  For more keys than executors
    hold in memory, set the session's state store to RocksDB."""
    spark, keys = stream.sparkSession, list(keys)

    def batch(df: DataFrame, epoch: int) -> None:
        new = df if known is None else df.join(known.select(*keys), keys, "left_anti")
        sinks.write_version(new, out_dir, epoch)

    run_available(stream.select(*keys).dropDuplicates(keys), batch, checkpoint)
    done = sinks.written_before(spark, out_dir)
    return spark.createDataFrame([], stream.select(*keys).schema) if done is None else done


def stream_newer(stream: DataFrame, cursor_dir: str, out_dir: str, key: str, ts: str, checkpoint: str,
                 buckets: int = bucketed.BUCKETS) -> DataFrame:
    """Drop late rows at or before the key's stored high-water mark, append
    the rest and advance the stored marks (P21 inside ``foreachBatch``).  Only
    the marks in the buckets of the epoch's keys are read and written."""
    spark = stream.sparkSession
    schema = stream.schema
    cur_schema = T.StructType([T.StructField(key, schema[key].dataType), T.StructField("_hwm", schema[ts].dataType)])

    def batch(df: DataFrame, epoch: int) -> None:
        touched = [r[0] for r in df.select(bucketed.bucket_of([key], buckets)).distinct().collect()]
        marks = bucketed.read(spark, cursor_dir, cur_schema, epoch + 1, touched)
        new = df.join(marks, key, "left").where(F.col("_hwm").isNull() | (F.col(ts) > F.col("_hwm"))).drop("_hwm")
        sinks.write_version(new, out_dir, epoch)
        newest = new.groupBy(key).agg(F.max(ts).alias("_hwm"))  # above the stored mark, as the rest was dropped
        bucketed.upsert(cursor_dir, newest, [key], epoch + 1, cur_schema, buckets)

    run_available(stream, batch, checkpoint)
    done = sinks.written_before(spark, out_dir)
    return spark.createDataFrame([], schema) if done is None else done


def stream_run_state(run_log: DataFrame, table_dir: str, checkpoint: str, ts: str = "ts",
                     seq: str = "event_id") -> DataFrame:
    """I4: continuously folded run state (streaming aggregation in update mode;
    each epoch merges the keys that changed).  Same columns as
    ``incremental.run_state``."""
    from ..operators.incremental import run_state

    spark = run_log.sparkSession
    agg = run_state(run_log, ts, seq)
    keys = ["ticker_id", "process_name"]

    def batch(df: DataFrame, epoch: int) -> None:
        bucketed.upsert(table_dir, df, keys, epoch + 1, order=keys)

    run_available(agg, batch, checkpoint, output_mode="update")
    return bucketed.read(spark, table_dir, agg.schema)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir for one streaming run."""
    return shared_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")
