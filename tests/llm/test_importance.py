import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from ticklake.llm import importance as I


def tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def runs(text, most):
    w = tokens(text)
    return [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, buckets=I.BUCKETS, most=1, min_words=I.MIN_WORDS, percent=I.PERCENT):
    code = lambda r: zlib.crc32(r.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(code, runs(text, most)))
    for text in target:
        t.update(map(code, runs(text, most)))
    ss, tt = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for d, text in rows:
        got = runs(text, most)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * ss / ((s[b] + 1) * tt))) for b in map(code, got))
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), None, len(tokens(text))])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def ours(spark, docs, target, **kw):
    return sorted(map(tuple, I.resample(docs, spark.createDataFrame([(t, 1) for t in target], "text string, bucket int"), **kw).collect()), key=str)


def test_smoke_table_like_brute_force(spark, documents, smoke_dir):
    target = [r.text for r in spark.read.parquet(f"{smoke_dir}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t, _ in documents]
    df = spark.createDataFrame(documents, "doc_id long, text string, source string")
    assert ours(spark, df, target) == brute(rows, target)
    assert ours(spark, df, target, buckets=97, most=3, min_words=5, percent=50) == brute(rows, target, 97, 3, 5, 50)


def test_awkward_rows(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    for target in ([None, "", "Long same TEXT"], []):
        assert ours(spark, awkward, target, min_words=1, percent=100) == brute(rows, target, min_words=1, percent=100)
    assert ours(spark, empty, ["a"]) == []


def test_shifted_runs_over_pieces(monkeypatch):
    rng = random.Random(5)
    texts = [None, "", "...", "é1 Ünder x", *(" ".join(rng.choice(["A", "b", "cé", "d9"]) for _ in range(rng.randrange(40))) for _ in range(60))]
    for size in (1, 50, 10_000):
        monkeypatch.setattr(I, "_PIECE", size)
        held = {}
        for lo, n_words, owner, run, code in I.features(pa.array(texts), 1000, 3):
            for i, n in enumerate(n_words.tolist()):
                assert n == len(tokens(texts[lo + i]))
                held[lo + i] = Counter(code[run[owner == i]].tolist())
        assert held == {i: Counter(zlib.crc32(r.encode()) % 1000 for r in runs(t, 3)) for i, t in enumerate(texts)}


def test_gains_prefer_the_target():
    g = I.gains({1: 100, 2: 1}, {2: 50}, 4)
    assert isinstance(g, np.ndarray) and g[2] > g[0] > g[1]
