import math
import re
from collections import defaultdict

from ticklake.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def goals(rows):
    """Targets by sharing out again and again."""
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(size.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * size[s]]
        if not above:
            return size, fixed | share
        fixed |= {s: 3.0 * size[s] for s in above}


def checked(rows, got):
    size, goal = goals(rows)
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=str) == sorted(((d, len(WORD.findall(t or ""))) for d, t, _ in rows), key=str)
    by_doc = {d: s for d, _, s in rows}
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        s = by_doc[r["doc_id"]]
        assert r["source_size"] == size[s] and math.isclose(r["target"], goal[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    for s in size:
        assert abs(taken[s] - goal[s]) <= max(1, longest[s] / 2, .02 * goal[s]), (s, taken[s], goal[s], longest[s])


def test_smoke_table(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string, source string")
    got = M.mix(df).collect()
    checked(documents, got)
    again = M.mix(df.repartition(3)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_unequal_sources_and_equal_sizes(spark):
    rows = [(i, "w " * (3 if i % 2 else 40), "hot") for i in range(600)] + [(1000 + i, "w " * i, "b") for i in range(40)]
    rows += [(2000, "x y", "c"), (2001, "z " * 900, None), (2002, None, "d"), (2003, "", "e")]
    checked(rows, M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_rates_minimise_relative_entropy(spark):
    rows = [(i, "w " * (1 + i % 50), "a") for i in range(3000)] + [(5000 + i, "w " * (1 + i % 30), "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(df).collect()
    checked(rows, got)
    size, goal = goals(rows)
    # the same tilt by bisection
    sizes = [len(WORD.findall(t)) for _, t, s in rows if s == "a"]
    lo, hi = -50.0, 50.0
    for _ in range(200):
        t = (lo + hi) / 2
        lo, hi = (t, hi) if sum(x * min(3, math.exp(t * x / 30)) for x in sizes) < goal["a"] else (lo, t)
    mean = defaultdict(list)
    for r in got:
        if r["doc_id"] < 5000:
            mean[r["size"]].append(r["copies"])
    for x, copies in mean.items():
        assert abs(sum(copies) / len(copies) - min(3, math.exp(lo * x / 30))) < .05


def test_awkward_rows_and_empty(spark, awkward, empty):
    got = M.mix(awkward).collect()
    assert len(got) == awkward.count()
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert M.mix(empty).collect() == []
