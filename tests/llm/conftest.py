import pytest


@pytest.fixture(scope="session")
def documents(spark, smoke_dir):
    """The documents of the smoke tables as (doc_id, text, source) rows."""
    rows = spark.read.parquet(f"{smoke_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    return [tuple(r) for r in rows]


EDGES = [(900001, None, "src0"), (900002, "", "src0"), (900003, "one", None), (900004, "  \n\t ", "src1"), (900005, "same text here", "src1"),
         (900005, "same text here", "src1"), (900006, "same text here", None), (None, "no id at all", "src2"), (900007, "long " * 30000, "src0")]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns whose
    names the operators use themselves."""
    rows = [(*r, i, "x", 1.0) for i, r in enumerate(EDGES)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, batch string, node double")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
