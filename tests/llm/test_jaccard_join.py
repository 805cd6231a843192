import random

from ticklake.llm import jaccard_join as J

SPACES = " \t\n\x0b\x0c\r"


def brute_sets(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACES[1:]:
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    """(doc_id, n_shingles, component_id) with every pair compared."""
    sets = [brute_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = {}
    for i, s in enumerate(sets):
        for e in s:
            lists.setdefault(e, []).append(i)
    seen = set()
    for members in lists.values():
        for x in range(len(members)):
            for y in range(x):
                pair = (members[y], members[x])
                if pair not in seen:
                    seen.add(pair)
                    a, b = sets[pair[0]], sets[pair[1]]
                    both = len(a & b)
                    if 100 * both >= 80 * (len(a) + len(b) - both):
                        parent[find(pair[0])] = find(pair[1])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def ours(spark, rows, schema="doc_id long, text string"):
    df = spark.createDataFrame(rows, schema) if isinstance(rows, list) else rows
    return sorted((tuple(r) for r in J.jaccard_components(df).collect()), key=str)


def test_smoke_table_like_brute_force(spark, documents):
    rows = [(d, t) for d, t, _ in documents]
    assert ours(spark, rows) == brute(rows)


def test_near_copies_of_all_sizes(spark):
    rng, rows = random.Random(5), []
    for base in range(60):
        size = rng.choice([1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 20, 30, 60, 120])
        words = [f"w{rng.randrange(400)}" for _ in range(size)]
        for _ in range(rng.randrange(1, 9)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
            copy = copy[: len(copy) - rng.choice([0, 0, 1])] + [f"y{rng.randrange(9)}"] * rng.choice([0, 0, 1, 2])
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    assert ours(spark, rows) == brute(rows)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(90)]
    rows = []
    for d in range(300):
        copy = list(words)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(90)] = f"x{rng.randrange(1000)}"
        rows.append((d, " ".join(copy)))
    rows += [(1000 + d, " ".join([f"z{d}_{i}" for i in range(30)] + words[:40])) for d in range(100)]
    assert ours(spark, rows) == brute(rows)


def test_boundary_is_by_cost():
    assert J.small_limit(80, 0) == 0
    assert 3 <= J.small_limit(80, 8) <= J.small_limit(80, 1000)


def test_awkward_rows(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert ours(spark, awkward) == brute(rows)


def test_empty(spark, empty):
    assert ours(spark, empty) == []
