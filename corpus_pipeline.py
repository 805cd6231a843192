"""The corpus pipeline: ``documents`` through five stages.

``STAGES`` are (name, function) pairs; each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``.  All but the last return the columns
of ``documents``.  Rows get a running id within a stage, so repeated rows, rows
without an id and rows with equal ids are told apart.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import jaccard_join, mixing, piece_bpe, quality_rules, queries, suffix_dedup
from ticklake.llm.common import table
from ticklake.session import cut_lineage, shared_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: row ids that are sent to all tasks at most: 32 MB
FEW = 4_000_000


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row id; the rows of a Parquet table keep their order."""
    return docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row"))


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` but those whose row id is in ``gone``.  The ids are counted first:
    up to ``FEW`` go to all tasks, so that no text is shuffled for them; more are
    joined by shuffling both sides."""
    gone = cut_lineage(gone)
    return rows.join(F.broadcast(gone) if gone.count() <= FEW else gone, "row", "left_anti").select(*COLUMNS)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    rows = _numbered(docs)
    return _without(rows, quality_rules.rejected_rows(rows, "row"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones stays."""
    rows = _numbered(docs)
    return _without(rows, jaccard_join.surplus_rows(rows, "row"))


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text that stands in an earlier document goes, as far as it is whole
    characters; documents stay, also with an empty text."""
    kept = suffix_dedup.remove_repeats(docs, carry={"lang": "lang", "source": "source"})
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated as the mix takes them."""
    rows = _numbered(docs)
    copies = mixing.mix(rows, row_col="row").where("copies > 0").select("row", "copies")
    return rows.join(copies, "row").select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers and digests of the ids of every document."""
    return piece_bpe.encode_documents(docs, queries.model_file())


STAGES = [("quality rules", good), ("n-gram Jaccard join", distinct), ("suffix-array dedup", unrepeated),
          ("mixing sources", mixed), ("SentencePiece", encoded)]

#: The stages iterate and encode; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each stage's rows written to
    the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = shared_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
    return docs
