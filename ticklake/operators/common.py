"""Small building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColLike = str | Column


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def latest_by(df: DataFrame, keys: Sequence[ColLike], order: Sequence[ColLike],
              payload: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    Expressed as ``groupBy(keys).agg(max_by(struct(payload), struct(order)))`` so
    Spark runs a partial (map-side) aggregate before the shuffle: a hot key is
    reduced to one row per input partition, never gathered in one task.  NULL
    fields inside the order struct sort lowest, i.e. DESC NULLS LAST.  The order
    must be unique inside a key for a deterministic result.
    """
    key_cols = [_c(k) for k in keys]
    key_names = [k if isinstance(k, str) else f"_k{i}" for i, k in enumerate(keys)]
    key_cols = [c.alias(n) for c, n in zip(key_cols, key_names)]
    payload = list(payload) if payload is not None else [c for c in df.columns if c not in key_names]
    agg = df.groupBy(*key_cols).agg(
        F.max_by(F.struct(*[F.col(p) for p in payload]), F.struct(*[_c(o) for o in order])).alias("_w")
    )
    keep = [n for n in key_names if not n.startswith("_k")]
    return agg.select(*keep, *[F.col("_w")[p].alias(p) for p in payload])


def first_by(df: DataFrame, keys: Sequence[ColLike], order: Sequence[ColLike],
             payload: Sequence[str] | None = None) -> DataFrame:
    """Like ``latest_by`` but keeps the smallest ``order`` tuple (NULLs first)."""
    key_cols = [_c(k) for k in keys]
    key_names = [k if isinstance(k, str) else f"_k{i}" for i, k in enumerate(keys)]
    key_cols = [c.alias(n) for c, n in zip(key_cols, key_names)]
    payload = list(payload) if payload is not None else [c for c in df.columns if c not in key_names]
    agg = df.groupBy(*key_cols).agg(
        F.min_by(F.struct(*[F.col(p) for p in payload]), F.struct(*[_c(o) for o in order])).alias("_w")
    )
    keep = [n for n in key_names if not n.startswith("_k")]
    return agg.select(*keep, *[F.col("_w")[p].alias(p) for p in payload])


def top_k_per_group(df: DataFrame, keys: Sequence[ColLike], order: Sequence[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """``row_number() <= k`` per group.  Spark plans a WindowGroupLimit below the
    shuffle, so each input partition keeps only its own top k per key first."""
    from pyspark.sql import Window

    w = Window.partitionBy(*[_c(x) for x in keys]).orderBy(*order)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


def dense_ids(df: DataFrame, order_cols: Sequence[ColLike], start, name: str = "id",
              partitions: int | None = None) -> DataFrame:
    """Deterministic dense ids ``start + 1 .. start + n`` in ``order_cols`` order.

    Range-partition and sort, tag each row with its partition and position
    (``monotonically_increasing_id`` = partition << 33 | position), cut lineage
    with a reliable checkpoint so that both passes see one partitioning, then add
    per-partition offsets from a table with one row per partition.  No
    single-partition window over the data; ``order_cols`` must be a total order.
    """
    from pyspark.sql import Window

    from ..session import cut_lineage

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    oc = [_c(c) for c in order_cols]
    tagged = (
        df.repartitionByRange(n, *oc).sortWithinPartitions(*oc)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
    )
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, ["_off"])
    out = tagged.join(F.broadcast(offs), "_pid")
    return out.withColumn(name, F.lit(start).cast("bigint") + F.col("_off") + F.col("_pos") + 1).drop(
        "_pid", "_pos", "_off")
