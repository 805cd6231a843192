import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticklake.llm import collocations as C
from ticklake.llm import count_automata as A


def pieces(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", text)]


def counted(texts, longest):
    f = Counter()
    for text in texts:
        for w in pieces(text):
            f.update(tuple(w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    return f


def brute(rows, shortest=2, longest=3, least=10, inside=50, top=2000):
    out = []
    for lang in {x or "und" if x is None else x for _, x in rows}:
        f = counted([t for t, x in rows if ("und" if x is None else x) == lang], longest)
        n = sum(a for p, a in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) >= shortest and a >= least}
        gone = {q for p, b in found.items() for m in range(shortest, len(p)) for i in range(len(p) - m + 1) for q in [p[i:i + m]] if q in found and 100 * b >= inside * found[q]}
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, r, n, -s) for i, (s, a, p, left, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def ours(df, **kw):
    return sorted(map(tuple, C.collocations(df, **kw).collect()))


def made(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "été", "d", "Éx", "zz", "q\0r"]
    return [("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rng.randrange(60))), rng.choice(["en", "f\tr", "", None])) for _ in range(n)]


@pytest.mark.parametrize("kw", [{}, {"messages": 0, "shard_bytes": 300, "range_bytes": 900}, {"longest": 5, "least": 4, "inside": 70, "top": 7}])
def test_like_brute_force(spark, kw):
    rows = made(3, 150)
    df = spark.createDataFrame([(t, x, 1, "p") for t, x in rows], "text string, lang string, a int, phrase string")
    assert ours(df, **kw) == brute(rows, **{k: v for k, v in kw.items() if k in ("longest", "least", "inside", "top")})


def test_smoke_table(spark, smoke_dir):
    df = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    assert ours(df) == brute([(r.text, r.lang) for r in df.collect()])


def test_awkward_rows_and_empty(spark):
    text = "new york city, " * 4000  # one long text
    rows = [(None, "en"), ("", "en"), (" \t.", None), (text, "en"), *[("one two one two", None)] * 12]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = ours(df)
    assert got == brute(rows) and ("en", 1, "new york city", 4000, 4000, 4000, 12000, 1_000_000) in got
    assert ours(spark.createDataFrame([], "text string, lang string")) == []
    assert ours(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")) == []


def flat(counts):
    return {(counts.langs[x], p): w for lang, phrase, weight in A.phrases(counts) for x, p, w in zip(lang.tolist(), phrase.to_pylist(), weight.tolist(), strict=True) if w}


def automaton(rows, longest=3):
    return C.shard_counts(pa.array([t for t, _ in rows]), pa.array(["und" if x is None else x for _, x in rows]), longest)


def wanted(rows, longest=3):
    return {(lang, " ".join(p)): a for lang in {"und" if x is None else x for _, x in rows}
            for p, a in counted([t for t, x in rows if ("und" if x is None else x) == lang], longest).items()}


def test_automata_add_split_and_pack():
    one, two = made(1, 40), made(2, 40)
    a, b = automaton(one), automaton(two)
    assert flat(a) == wanted(one) and flat(A.unpack(A.pack(a))) == wanted(one)
    both = A.union([A.unpack(A.pack(a)), b])
    assert flat(both) == wanted(one + two)
    parts = dict(A.split(both, 5))
    assert sum((list(flat(p)) for p in parts.values()), []).__len__() == len(flat(both))
    assert flat(A.union([A.unpack(A.pack(p)) for p in parts.values()])) == flat(both)
    often = A.frequent(both, 3)
    assert flat(often).items() >= {k: v for k, v in flat(both).items() if v >= 3}.items()


def test_equal_states_are_shared():
    rows = [("".join(f"w{i} x{j}. " for i in range(200) for j in range(20)), "en")]
    other = [("".join(f"w{i} x{(j * 7 + i * i) % 97}. " for i in range(200) for j in range(20)), "en")]
    assert len(A.pack(automaton(rows))) < len(A.pack(automaton(other))) / 2
    assert flat(A.unpack(A.pack(automaton(rows)))) == wanted(rows)


def test_compose_gives_the_weights_of_parts():
    rows = made(4, 60)
    counts, want = automaton(rows), wanted(rows)
    keys = [*list(want)[::3], ("en", "not there"), ("xx", "a")]
    langs = sorted({x for x, _ in keys})
    query, length, node = A.from_phrases(langs, np.array([langs.index(x) for x, _ in keys]), pa.array([p for _, p in keys]))
    weights = A.compose(query, counts)
    assert [int(weights[n - 1][i]) for n, i in zip(length, node, strict=True)] == [want.get(k, 0) for k in keys]


def test_ranges_are_the_same_for_columns(spark):
    counts = automaton(made(5, 30))
    got = {}
    for (lang, phrase, _), h in zip(A.phrases(counts), A.prefix_hashes(counts), strict=True):
        got |= {(counts.langs[x], p): int(v) % 13 for x, p, v in zip(lang.tolist(), phrase.to_pylist(), h.tolist(), strict=True)}
    df = spark.createDataFrame(list(got), "lang string, phrase string")
    rows = df.select("lang", "phrase", C.prefix_range(F.col("lang"), F.split("phrase", " "), 13).alias("r")).collect()
    assert {(r.lang, r.phrase): r.r for r in rows} == got
