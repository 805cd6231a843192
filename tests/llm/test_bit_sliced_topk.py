import math
import random

import numpy as np

from ticklake.llm import bit_sliced_topk as T


def brute(rows, k=5, scale=256):
    whole = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def ours(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>") if isinstance(rows, list) else rows
    return sorted(tuple(r) for r in T.top_k(df, **kw).collect())


def test_smoke_table_in_many_blocks(spark, smoke_dir):
    df = spark.read.parquet(f"{smoke_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert ours(spark, df) == brute(rows)
    assert ours(spark, df, block_rows=70, group_queries=3) == brute(rows)


def test_ties_and_large_values(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 2.0, 1000.25]) for _ in range(3)]) for i in range(400)]
    rows += [(1000 + i, [.25, .25, .25]) for i in range(300)]
    rng.shuffle(rows)
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, rows, block_rows=64) == brute(rows)


def test_few_rows_and_awkward_ones(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -.001]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]), (50, [.5, .5]), (7, [0.0, 0.0]), (-50, [-1.0, 3.0])]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, [(0, [1.0])]) == [] and ours(spark, [(0, []), (1, [])]) == [(0, 1, 1, 0)]
    assert ours(spark, spark.createDataFrame([], "vec_id long, embedding array<float>, v int, block int")) == []
    twice = ours(spark, [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])])
    assert twice == [(0, 1, 1, 131072), (0, 2, 1, 131072)]


def test_sums_of_slices():
    rng = np.random.default_rng(1)
    rows, query = rng.integers(-300, 300, (130, 7)), rng.integers(-200, 200, 7)
    index = T.BitSlices(rows)
    digits = index.sums(query)
    sums = sum((np.unpackbits(d.view(np.uint8), bitorder="little")[:130].astype(np.int64) << t) for t, d in enumerate(digits))
    assert len(set((sums - rows @ query).tolist())) == 1
