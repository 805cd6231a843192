"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers, ``floor(scale * x)``.  Rows are dealt into
blocks by a hash; within a block, rows are sorted by id and every attribute is
stored as bit slices: one bitmap over the rows for each binary digit (after the
block's smallest value is subtracted, so that digits are not negative).

For a query, the score of all rows of a block at once is a sum of slices: for
each binary digit of a query component, the slices of that attribute, shifted by
that digit.  Negative components add the complemented slices instead, which
differs from the score by a constant.  The sum is made with bitmap arithmetic:
carry-save adders take three bitmaps of one weight to one of that weight and one
of the next.  The result is again one bitmap per binary digit of the score.

The best rows are then found from the most significant digit down: rows with the
digit set are chosen while fewer than ``k`` are, else the search goes on among
them alone.  Rows that tie at the boundary are resolved exactly, by id.

Each (block, group of queries) is a task of bounded size.  Queries are every row
whose id is divisible by ``query_every``, against all rows, in blocks; each
block gives at most ``k`` rows a query, and a window merges these.

Defined results: rows with a null id, a null vector, or a null or non-finite
component take no part.  Vectors of different lengths are compared as if zeros
followed.  A query's own rows are those with its id; repeated rows of other ids
are candidates each.  Repeated equal rows of a query id are one query.  Scores
are exact within 64 bits.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import reliable

ROWS, QUERIES = 32_768, 256


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id and the integer vector ``v`` of the rows that take part."""
    v = F.col("x")
    whole = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("x"))
            .where(F.col("vec_id").isNotNull() & whole)
            .select("vec_id", F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x)).alias("v")))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class BitSlices:
    """Bit slices of a block of integer rows."""

    def __init__(self, rows: np.ndarray):
        self.n, self.width = rows.shape
        self.low = int(rows.min(initial=0))
        above = rows - self.low
        self.digits = max(1, int(above.max(initial=0)).bit_length())
        words = -(-max(1, self.n) // 64)
        self.words = words
        planes = np.zeros((self.width, self.digits, words * 8), np.uint8)
        for d in range(self.digits):
            bits = np.packbits(((above >> d) & 1).astype(np.uint8).T, axis=1, bitorder="little")
            planes[:, d, : bits.shape[1]] = bits
        # attribute, sign, digit: the slices and their complements
        plain = planes.view(np.uint64)
        self.slices = np.stack([plain, ~plain], axis=1)
        valid = np.zeros(words * 8, np.uint8)
        packed = np.packbits(np.ones(self.n, np.uint8), bitorder="little")
        valid[: len(packed)] = packed
        self.valid = valid.view(np.uint64)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """The scores' binary digits, each a bitmap over the rows (lowest
        first), up to a constant for the query."""
        weighted: dict[int, list[tuple[int, int, int]]] = {}
        for i, q in enumerate(query.tolist()):
            m = abs(q)
            for s in range(m.bit_length()):
                if m >> s & 1:
                    for d in range(self.digits):
                        weighted.setdefault(s + d, []).append((i, int(q < 0), d))
        out: list[np.ndarray] = []
        carried: np.ndarray | None = None
        t, top = 0, max(weighted, default=-1)
        while t <= top or (carried is not None and len(carried)):
            at = weighted.get(t)
            stack = self.slices[tuple(np.array(at).T)] if at else np.zeros((0, self.words), np.uint64)
            if carried is not None and len(carried):
                stack = np.concatenate([stack, carried])
            carries = []
            while len(stack) > 1:
                k = len(stack) // 3
                if k:
                    a, b, c = stack[:k], stack[k:2 * k], stack[2 * k:3 * k]
                    x = a ^ b
                    carries.append((a & b) | (x & c))
                    stack = np.concatenate([x ^ c, stack[3 * k:]])
                else:
                    carries.append(stack[:1] & stack[1:])
                    stack = stack[:1] ^ stack[1:]
            out.append(stack[0] if len(stack) else np.zeros(self.words, np.uint64))
            carried = np.concatenate(carries) if carries else None
            t += 1
        return out

    def best(self, query: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
        """Places of the ``k`` best rows but ``own``; of equal ones the first."""
        left = self.valid.copy()
        for place in own.tolist():
            left[place // 64] &= ~np.uint64(1 << (place % 64))
        chosen, need = np.zeros_like(left), k
        for digit in reversed(self.sums(query)):
            high = left & digit
            n = int(np.bitwise_count(high).sum())
            if n >= need:
                left = high
            else:
                chosen |= high
                need -= n
                left &= ~digit
        return np.concatenate([self._places(chosen), self._places(left)[:need]])

    @staticmethod
    def _places(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if rows.num_rows and queries.num_rows:
            rows = rows.sort_by("vec_id")
            width = max(int(np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max()) for t in (rows, queries))
            x, q = _matrix(rows.column("v"), width), _matrix(queries.column("v"), width)
            ids, keys = rows.column("vec_id").to_numpy(), queries.column("query_key").to_pylist()
            index = BitSlices(x)
            for i, query_id in enumerate(queries.column("query_id").to_pylist()):
                own = np.arange(np.searchsorted(ids, query_id), np.searchsorted(ids, query_id, "right"))
                found = index.best(q[i], k, own)
                out[0] += [query_id] * len(found)
                out[1] += [keys[i]] * len(found)
                out[2] += ids[found].tolist()
                out[3] += (x[found] @ q[i]).tolist()
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, query_every: int = 50,
          scale: int = 256, block_rows: int = ROWS, group_queries: int = QUERIES) -> DataFrame:
    """The ``k`` highest integer inner products of each query, ties to the
    smaller id: query_id, rank, vec_id, score."""
    rows = reliable(quantised(vectors, id_col, vector_col, scale))
    queries = rows.where(F.col("vec_id") % query_every == 0).distinct().withColumn("query_key", F.xxhash64("v"))
    blocks = -(-max(1, rows.count()) // block_rows)
    groups = -(-max(1, queries.count()) // group_queries)
    dealt = rows.select("vec_id", "v", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    asked = queries.select(F.col("vec_id").alias("query_id"), "query_key", "v", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("part"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    near = (dealt.groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
            .applyInArrow(_search(k), "query_id long, query_key long, vec_id long, score long"))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""
