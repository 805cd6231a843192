"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, whole; any path Spark's readers understand."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, A_Z, a_z)


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared
    folder (``spark.checkpoint.dir``), so a lost executor loses no data."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tasks(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
