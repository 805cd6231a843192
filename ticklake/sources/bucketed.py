"""Keyed tables in hash buckets, where a write touches only the buckets of its keys.

``data/v=<number>/bucket=<b>`` holds a bucket's rows as version ``number`` wrote
them; ``manifest/v=<number>`` names for every bucket the version that holds it
(one row a bucket).  A version writes the buckets its batch touches, then its
manifest; readers follow the newest complete manifest, so a write that fails
leaves the table as it was, and one that runs again writes the same.  A batch of
ten keys reads and writes ten buckets at most, however large the table is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sinks

BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, table_dir: str, below: int | None) -> dict[int, int]:
    """Bucket -> version of the newest complete manifest (below a number)."""
    done = [path for n, path in sinks._versions(spark, f"{table_dir}/manifest") if below is None or n < below]
    return {r.bucket: r.version for r in spark.read.parquet(done[-1]).collect()} if done else {}


def _rows(spark: SparkSession, table_dir: str, held: dict[int, int], schema: T.StructType) -> DataFrame:
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{table_dir}/data/v={v:010d}/bucket={b}" for b, v in sorted(held.items())])


def read(spark: SparkSession, table_dir: str, schema: T.StructType, below: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """The table (as it was before version ``below``; the buckets of ``only``);
    empty if nothing was written."""
    held = _manifest(spark, table_dir, below)
    return _rows(spark, table_dir, held if only is None else {b: v for b, v in held.items() if b in set(only)}, schema)


def upsert(table_dir: str, source: DataFrame, keys: Sequence[str], number: int, schema: T.StructType | None = None,
           buckets: int = BUCKETS, **how) -> set[int]:
    """S9 as version ``number``: ``sinks.upsert`` of the buckets that ``source``
    touches.  ``how`` goes to ``sinks.upsert``.  Returns the touched buckets;
    ``buckets`` belongs to the table and must not change."""
    spark, schema = source.sparkSession, schema or source.schema
    held = _manifest(spark, table_dir, number)
    touched = {r[0] for r in source.select(bucket_of(keys, buckets)).distinct().collect()}  # ``buckets`` numbers at most
    if touched:
        before = _rows(spark, table_dir, {b: v for b, v in held.items() if b in touched}, schema)
        after = sinks.upsert(before, source, keys, **how).withColumn("bucket", bucket_of(keys, buckets))
        # the write itself deals by bucket, so a bucket is one file
        after.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table_dir}/data/v={number:010d}")
    entries = sorted((held | dict.fromkeys(touched, number)).items())
    sinks.write_version(spark.createDataFrame(entries, "bucket int, version long").coalesce(1), f"{table_dir}/manifest", number)
    return touched
