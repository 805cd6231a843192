"""Documents dealt into batches, and hashing of their text with numpy.

Several operators look at all documents through short keys (hashes of shingles,
of minimizers): each batch of documents sends its distinct keys to the buckets
they fall into, each bucket counts its keys over all batches and answers every
batch, and the batch looks at its documents again with the answers.  A key that
a third of all documents hold is one key a batch, so no bucket is hot.  Messages
are packed arrays, one for each batch and bucket, so Spark moves few, dense rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of text in a batch, about
BATCH_BYTES = 4 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


#: a 64-bit number for every byte
BYTE_CODE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def deal(docs: DataFrame, id_col: str, text_col: str, batch_bytes: int = BATCH_BYTES, carry: dict[str, str] | None = None) -> tuple[DataFrame, int]:
    """(doc_id, text, batch) and the columns of ``carry`` (new name: old name),
    and the number of batches, by a hash of the id.  Rows without an id are dealt by their text."""
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), *(docs[old].alias(new) for new, old in (carry or {}).items()))
    total = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // batch_bytes))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return picked.withColumn("batch", F.pmod(key, F.lit(n))), n


def ordered(table: pa.Table) -> pa.Table:
    """A batch's documents in an order that depends on nothing but them."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def text_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes one after the other, and where each begins (with
    the end); null texts have none."""
    texts = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    texts = texts.fill_null("").cast(pa.large_binary())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def ids(column: pa.ChunkedArray, null: int = np.iinfo(np.int64).max) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``null`` for missing ones, and which are there."""
    there = ~column.combine_chunks().is_null().to_numpy(zero_copy_only=False)
    return column.combine_chunks().fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64), there


def pieces(offsets: np.ndarray, size: int = 1 << 19) -> list[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together, so that the arrays made
    for each byte stay small."""
    cuts = [0]
    while cuts[-1] < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[cuts[-1]] + size))
        cuts.append(min(max(end, cuts[-1] + 1), len(offsets) - 1))
    return list(zip(cuts, cuts[1:], strict=False))
