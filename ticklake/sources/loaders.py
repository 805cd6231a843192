"""Typed readers for the raw inputs (no schema inference on growing data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.financials import load_overrides, period_columns  # noqa: F401  (S7 re-exported)
from ..operators.market import load_company_info, load_prices, load_splits  # noqa: F401  (S1-S3 re-exported)

FILING_SCHEMA = T.StructType([
    T.StructField("accession_no", T.StringType()), T.StructField("form", T.StringType()),
    T.StructField("filing_date", T.DateType()), T.StructField("ticker", T.StringType()),
])


def load_filings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Filing index (accession, form, filing date, ticker), typed read."""
    r = spark.read.schema(FILING_SCHEMA)
    return r.option("header", True).csv(path) if fmt == "csv" else r.format(fmt).load(path)


def load_statement_rows(spark: SparkSession, path: str) -> DataFrame:
    """S4 for many frames at once: JSON lines, one object a row of a frame, whose
    period columns differ from file to file.

    Every object is melted in the scan as a map of its own columns, so no schema
    is inferred over files and one plan reads any number of frames.  Gives
    (statement, filing_accession, concept, period, value): date-named columns are
    periods, as in P9; the three named columns are the row's."""
    row = F.from_json("value", "map<string,string>")
    melted = spark.read.text(path).select(row.alias("m"))
    fixed = [F.col("m").getItem(c).alias(c) for c in ("statement", "filing_accession", "concept")]
    return melted.select(*fixed, F.explode("m").alias("column", "value")).select(
        "statement", "filing_accession", "concept", F.regexp_extract("column", r"^\s*(\d{4}-\d{2}-\d{2})", 1).try_cast("date").alias("period"),
        "value").where(F.col("period").isNotNull())


def load_statement(spark: SparkSession, path: str, statement: str, fmt: str = "parquet") -> DataFrame:
    """A wide statement frame whose period columns are data.  The frame is
    read as is (its columns are the periods); the statement name is attached
    as a column so several statements can be processed in one pass."""
    df = spark.read.format(fmt).option("header", True).load(path)
    if not period_columns(df):
        raise ValueError(f"{path}: no date-named period column")
    return df.withColumn("statement", F.lit(statement))
