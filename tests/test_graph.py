import random

from ticklake.operators import graph as G

VERTEX = "id string, label string, name string, labels array<string>, props map<string,string>"
EDGE = "eid string, src string, dst string, type string, props map<string,string>"


def drawn(spark, seed=5):
    """Companies, metrics, a few countries that all share; parallel edges, loops,
    a vertex that comes twice, one without label and edges to nowhere."""
    rnd = random.Random(seed)
    v = [(f"c{i}", "Company", f"n{i}") for i in range(12)] + [(f"m{i}", "Metric", f"m{i}") for i in range(15)] + [(f"r{i}", "Risk", "r") for i in range(3)]
    v += [("m3", "Metric", "again"), ("s0", "Strategy", "s"), ("u", None, "u"), ("c4", "Company", "twice")]
    e = [(f"c{rnd.randrange(12)}", f"m{rnd.randrange(15)}", "REPORTS") for _ in range(70)]
    e += [(f"c{i}", f"r{i % 3}", "FACES") for i in range(12)] + [("c1", "c1", "FACES"), ("c2", "s0", "FACES"), ("s0", "u", "X"), ("m1", "gone", "X"), ("c3", "r0", "X"), ("m2", None, "X")]
    rows = [(f"e{i}", *x, {"kind": x[2]}) for i, x in enumerate(e)]
    return v, rows, spark.createDataFrame([(*x, [x[1]], {"name": x[2], "k": x[0]}) for x in v], VERTEX), spark.createDataFrame(rows, EDGE)


def densities(v, e, threshold):
    labels = {}
    for i, label, _ in v:
        labels.setdefault(i, []).append(label)
    out = []
    for hub in {i for i, label, _ in v if label == "Company"}:
        count = sum(labels.get(s, []).count("Company") * labels.get(d, []).count("Metric") for _, s, d, t, _ in e if t == "REPORTS" and s == hub)
        if count <= threshold:
            continue
        ends = [(i, a, b) for i, s, d, _, _ in e for a, b in ((s, d), (d, s))]
        near = [(i, b) for i, a, b in ends if a == hub]
        nodes = {b for _, b in near} | {b for i, x in near for j, a, b in ends if a == x and (b != hub or sum(y == x for _, y in near) >= 2)}
        got = [x for n in nodes for x in labels.get(n, [])]
        out += [(hub, n, count, ",".join(sorted({x for x in got if x})), len(got)) for i, _, n in v if i == hub]
    return sorted(out)


def test_network_density_against_brute_force(spark):
    for seed in (5, 6):
        rows, edges, v, e = drawn(spark, seed)
        want = densities(rows, edges, 4)
        assert len(want) > 3
        for shared in (0, 2, 64):
            assert sorted(tuple(r) for r in G.network_density(v, e, 4, shared).collect()) == want


def test_network_density_shares_what_hubs_share(spark, monkeypatch):
    """Hubs in one country: no rows for hubs x neighbours of the country."""
    v = spark.createDataFrame([(f"c{i}", "Company", "n", ["Company"], {}) for i in range(300)] + [("m", "Metric", "m", ["Metric"], {}), ("r", "Risk", "r", ["Risk"], {})], VERTEX)
    e = spark.createDataFrame([(f"a{i}", f"c{i}", "m", "REPORTS", {}) for i in range(300)] + [(f"b{i}", f"c{i}", "r", "FACES", {}) for i in range(300)], EDGE)
    joined = []
    union = type(e).unionByName
    monkeypatch.setattr(type(e), "unionByName", lambda a, b, **k: joined.append(union(a, b, **k)) or joined[-1])
    got = G.network_density(v, e, 0)
    assert got.count() == 300 and {r.network_size for r in got.collect()} == {301}
    assert max(x.count() for x in joined) <= 2000


def _triplets(v, edges):
    by_id = {}
    for x in v:
        by_id.setdefault(x[0], []).append(x)
    return [(a, r, b) for r in edges for a in by_id.get(r[1], []) for b in by_id.get(r[2], [])]


def test_schema_overview_joins_names_only(spark):
    rows, edges, v, e = drawn(spark)
    count = {}
    for a, r, b in _triplets(rows, edges):
        count[a[1], r[3], b[1]] = count.get((a[1], r[3], b[1]), 0) + 1
    got = G.schema_overview(v, e)
    assert "a_props" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r[:4]): tuple(r[4:]) for r in got.collect()} == {(*k, n): ("k,name", "kind", "k,name") for k, n in count.items()}


def test_rel_samples_look_up_a_few_edges(spark):
    rows, edges, v, e = drawn(spark)
    got = G.rel_samples(v, e, examples=2)
    assert "strategy=broadcast" in got._jdf.queryExecution().optimizedPlan().toString()
    for r in got.collect():
        of = [t for t in _triplets(rows, edges) if t[1][3] == r.rel_type]
        assert r.source_labels == ",".join(sorted({a[1] for a, _, _ in of if a[1]}))
        two = sorted((x[0], f"{a[1] or ''}|k,name|{x[3]}|kind|{b[1] or ''}|k,name") for a, x, b in of)[:2]
        if all(a[1] and b[1] for a, _, b in of):
            assert r.sample_triplets == ";".join(t for _, t in two)
