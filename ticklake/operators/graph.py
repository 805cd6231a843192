"""Property-graph patterns over two tables.

vertices(id, label, name, labels ARRAY<STRING>, props MAP<STRING,STRING>)
edges(eid, src, dst, type, props MAP<STRING,STRING>)

Every pattern is a chain of equi-joins on vertex ids.  Edges inside one
pattern must be different edges (``e1.eid <> e2.eid``).  Every LIMIT is given a
total order (the source queries leave ties open) so results do not depend on
partitioning; top-k uses ``orderBy().limit()`` which Spark runs as a per-partition
top-k followed by a merge (TakeOrderedAndProject).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..session import cut_lineage
from .common import top_k_per_group


def _v(v: DataFrame, prefix: str, label: str | None = None) -> DataFrame:
    out = v.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("id", "label", "name", "props")])
    if label is not None:
        out = out.where(F.col(f"{prefix}_label") == label)
    return out


def _e(e: DataFrame, prefix: str, types: Sequence[str] | None = None) -> DataFrame:
    out = e.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("eid", "src", "dst", "type", "props")])
    if types:
        out = out.where(F.col(f"{prefix}_type").isin(*types))
    return out


def hop(v: DataFrame, e: DataFrame, src_label: str | None, types: Sequence[str] | None,
        dst_label: str | None, a: str = "a", r: str = "r", b: str = "b") -> DataFrame:
    """(a:src_label)-[r:types]->(b:dst_label) as one row per matching edge."""
    ed = _e(e, r, types)
    out = ed.join(_v(v, a, src_label), F.col(f"{r}_src") == F.col(f"{a}_id"))
    return out.join(_v(v, b, dst_label), F.col(f"{r}_dst") == F.col(f"{b}_id"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """L1: whole-table top-k with a caller-supplied total order."""
    return df.orderBy(*order).limit(k)


def sample_k(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """L2: a repeatable pseudo-random sample of k rows, in the order of the
    digest of ``seed:key``, which is the same in every engine."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key)).limit(k)


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """L3: first k rows per group (WindowGroupLimit below the shuffle)."""
    return top_k_per_group(df, keys, order, k)


def _ranked_sources(v: DataFrame, e: DataFrame, src_label: str, rel: str, dst_label: str, k: int,
                    cnt: str) -> DataFrame:
    h = hop(v, e, src_label, [rel], dst_label, "c", "r", "m")
    counts = h.groupBy("c_id").agg(F.count("r_eid").alias(cnt))
    return top_k(counts, [F.col(cnt).desc(), F.col("c_id")], k)


def _edges_of(e: DataFrame, top: DataFrame) -> DataFrame:
    """The edges that leave the few vertices of ``top``."""
    return e.join(F.broadcast(top.select(F.col("c_id").alias("src"))), "src", "left_semi")


def top_reporters(v: DataFrame, e: DataFrame, k: int = 5, limit: int = 50) -> DataFrame:
    """G1: the k companies with most REPORTS edges to metrics, then their edges."""
    top = _ranked_sources(v, e, "Company", "REPORTS", "Metric", k, "report_count")
    # k rows (bounded by the parameter) cut the edges before any vertex is looked up
    out = hop(v, _edges_of(e, top), "Company", ["REPORTS"], "Metric", "c", "r", "m").join(F.broadcast(top), "c_id")
    out = top_k(out, [F.col("report_count").desc(), F.col("c_id"), F.col("r_eid")], limit)
    return out.select("c_id", "c_name", "r_eid", "m_id", "m_name", "report_count")


def risk_networks(v: DataFrame, e: DataFrame, k: int = 3, limit: int = 40) -> DataFrame:
    """The k companies facing most risks, then their FACES / IMPLEMENTS /
    PRODUCES edges to any entity."""
    top = _ranked_sources(v, e, "Company", "FACES", "Risk", k, "risk_count")
    out = hop(v, _edges_of(e, top), "Company", ["FACES", "IMPLEMENTS", "PRODUCES"], None, "c", "r", "x").join(F.broadcast(top), "c_id")
    out = top_k(out, [F.col("risk_count").desc(), F.col("c_id"), F.col("r_eid")], limit)
    return out.select("c_id", "c_name", "r_eid", "r_type", "x_id", "x_label", "risk_count")


def _two_hop(v: DataFrame, e: DataFrame, l1: str | None, t1: Sequence[str] | None, l2: str | None,
             t2: Sequence[str] | None, l3: str | None, k: int | None = None, others: bool = False) -> DataFrame:
    """Two-hop paths, with ``k`` the first of them by (start, first edge, second
    edge); with ``others`` only paths that end elsewhere than they start.  Each first hop
    that continues gives a path, so the first ``k`` of them are enough: they are
    cut before the second hop is joined."""
    h1 = hop(v, e, l1, t1, l2, "a", "r1", "b")
    h2 = _e(e, "r2", t2).join(_v(v, "c", l3), F.col("r2_dst") == F.col("c_id"))
    goes_on = (F.col("r2_src") == F.col("b_id")) & (F.col("r1_eid") != F.col("r2_eid"))
    if others:
        goes_on = goes_on & (F.col("a_id") != F.col("c_id"))
    if k is None:
        return h1.join(h2, goes_on)
    ends = h2.select("r2_src", "r2_eid", "c_id")
    h1 = top_k(h1.join(ends, goes_on, "left_semi"), [F.col("a_id"), F.col("r1_eid")], k)
    return top_k(h1.join(h2, goes_on), [F.col("a_id"), F.col("r1_eid"), F.col("r2_eid")], k)


def metric_chains(v: DataFrame, e: DataFrame, paths: int = 20) -> DataFrame:
    """G3 + U4: the first ``paths`` company-REPORTS->metric-RELATED_TO->metric
    paths, as the distinct (node, relationship) pairs of those paths."""
    p = _two_hop(v, e, "Company", ["REPORTS"], "Metric", ["RELATED_TO"], "Metric", paths)
    nodes = F.array(F.col("a_id"), F.col("b_id"), F.col("c_id"))
    rels = F.array(F.col("r1_eid"), F.col("r2_eid"))
    return p.select(F.explode(nodes).alias("node_id"), rels.alias("rels")).select(
        "node_id", F.explode("rels").alias("rel_id")).distinct()


def frequent_edges(v: DataFrame, e: DataFrame, limit: int = 30, by_edge: bool = True) -> DataFrame:
    """(company, metric[, edge]) groups by frequency.  Grouped by the edge
    itself, as in the source query, every frequency is 1."""
    h = hop(v, e, "Company", ["REPORTS"], "Metric", "c", "r", "m")
    keys = ["c_id", "m_id", "r_eid"] if by_edge else ["c_id", "m_id"]
    g = h.groupBy(*keys).agg(F.count(F.lit(1)).alias("freq"))
    return top_k(g, [F.col("freq").desc(), *[F.col(k) for k in keys]], limit)


def ego(v: DataFrame, e: DataFrame, name: str, limit: int = 50) -> DataFrame:
    """Outgoing edges of the company with the given name."""
    h = hop(v, e, "Company", None, None, "c", "r", "x").where(F.col("c_name") == name)
    return top_k(h, [F.col("c_id"), F.col("r_eid")], limit).select("c_id", "r_eid", "r_type", "x_id", "x_label")


def strategy_networks(v: DataFrame, e: DataFrame, limit: int = 30) -> DataFrame:
    """Company-IMPLEMENTS->strategy with an optional MENTIONED_IN hop.

    Rows are ordered by (company, r1, r2); each (company, r1) yields at least one
    row, so only the first ``limit`` of them can appear: they are cut before the
    optional hop, which keeps the fan-out bounded by ``limit``."""
    h = hop(v, e, "Company", ["IMPLEMENTS"], "Strategy", "c", "r1", "s")
    h = top_k(h, [F.col("c_id"), F.col("r1_eid")], limit)
    r2 = _e(e, "r2", ["MENTIONED_IN"])
    j = h.join(r2, (F.col("r2_src") == F.col("s_id")) & (F.col("r2_eid") != F.col("r1_eid")), "left")
    j = j.join(_v(v, "t"), F.col("r2_dst") == F.col("t_id"), "left")
    out = top_k(j, [F.col("c_id"), F.col("r1_eid"), F.col("r2_eid").asc_nulls_first()], limit)
    return out.select("c_id", "r1_eid", "s_id", "r2_eid", "t_id")


def product_metrics(v: DataFrame, e: DataFrame, limit: int = 25) -> DataFrame:
    """Company-PRODUCES->product-RELATED_TO->metric, first ``limit`` paths.
    The first hop is cut to the first ``limit`` pairs that continue."""
    h = hop(v, e, "Company", ["PRODUCES"], "Product", "c", "r1", "p")
    cont = _e(e, "r2", ["RELATED_TO"]).join(_v(v, "m", "Metric"), F.col("r2_dst") == F.col("m_id"))
    has = cont.select(F.col("r2_src").alias("p_id")).distinct()
    h = top_k(h.join(has, "p_id", "left_semi"), [F.col("c_id"), F.col("r1_eid")], limit)
    j = h.join(cont, (F.col("r2_src") == F.col("p_id")) & (F.col("r2_eid") != F.col("r1_eid")))
    out = top_k(j, [F.col("c_id"), F.col("r1_eid"), F.col("r2_eid")], limit)
    return out.select("c_id", "r1_eid", "p_id", "r2_eid", "m_id")


def cross_mentions(v: DataFrame, e: DataFrame, limit: int = 20) -> DataFrame:
    """Company-REPORTS->metric-MENTIONED_IN->company with two different companies."""
    out = _two_hop(v, e, "Company", ["REPORTS"], "Metric", ["MENTIONED_IN"], "Company", limit, others=True)
    return out.select(F.col("a_id").alias("c1_id"), "r1_eid", F.col("b_id").alias("m_id"), "r2_eid",
                      F.col("c_id").alias("c2_id"))


def _keys_text(props: Column, n: int) -> Column:
    return F.array_join(F.slice(F.sort_array(F.map_keys(props)), 1, n), ",")


def rel_samples(v: DataFrame, e: DataFrame, examples: int = 3, limit: int = 20) -> DataFrame:
    """Per relationship type the source and target labels and up to
    ``examples`` example triplets (first by edge id; cut per type below the
    shuffle, never by collecting the whole type)."""
    h = hop(v, e, None, None, None, "a", "r", "b")
    labels = h.groupBy(F.col("r_type").alias("rel_type")).agg(
        F.array_join(F.sort_array(F.collect_set("a_label")), ",").alias("source_labels"),
        F.array_join(F.sort_array(F.collect_set("b_label")), ",").alias("target_labels"))
    # the examples' edges are chosen by ids alone; the rest is looked up for these few
    ids = v.select(F.col("id").alias("end"))
    there = e.select("eid", "src", "dst", "type").join(ids, F.col("src") == F.col("end"), "left_semi").join(
        ids, F.col("dst") == F.col("end"), "left_semi")
    few = first_k(there, ["type"], [F.col("eid")], examples).select("eid", "src", "dst", "type").distinct()
    few = F.broadcast(few.alias("few"))
    same = (F.col("edge.eid").eqNullSafe(F.col("few.eid")) & (F.col("edge.src") == F.col("few.src"))
            & (F.col("edge.dst") == F.col("few.dst")) & F.col("edge.type").eqNullSafe(F.col("few.type")))
    ed = _e(e.alias("edge").join(few, same, "left_semi"), "r")
    ex = F.broadcast(ed).join(_v(v, "a"), F.col("r_src") == F.col("a_id"))
    ex = F.broadcast(ex).join(_v(v, "b"), F.col("r_dst") == F.col("b_id"))
    ex = first_k(ex, ["r_type"], [F.col("r_eid")], examples)
    trip = F.concat_ws("|", F.col("a_label"), _keys_text(F.col("a_props"), 3), F.col("r_type"),
                       _keys_text(F.col("r_props"), 3), F.col("b_label"), _keys_text(F.col("b_props"), 3))
    exs = ex.groupBy(F.col("r_type").alias("rel_type")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r_eid", trip.alias("t")))),
                                 lambda x: x["t"]), ";").alias("sample_triplets"))
    return top_k(labels.join(exs, "rel_type"), [F.col("rel_type")], limit)


def triplet_view(v: DataFrame, e: DataFrame, k: int = 25, seed: int = 42) -> DataFrame:
    """K pseudo-random triplets with up to two 'key: value' strings per element."""
    h = hop(v, e, None, None, None, "a", "r", "b")

    def kv(props: Column) -> Column:
        ks = F.slice(F.sort_array(F.map_keys(props)), 1, 2)
        return F.array_join(F.transform(ks, lambda x: F.concat(x, F.lit(": "), props[x])), ",")

    s = sample_k(h, "r_eid", k, seed)
    return s.select(F.col("a_label").alias("source_node_type"), kv(F.col("a_props")).alias("source_sample_props"),
                    F.col("r_type").alias("relationship_type"), kv(F.col("r_props")).alias("rel_sample_props"),
                    F.col("b_label").alias("target_node_type"), kv(F.col("b_props")).alias("target_sample_props"))


def pattern_counts(v: DataFrame, e: DataFrame) -> DataFrame:
    """G11: 'A -[:R]-> B' frequencies with every label of both ends unwound."""
    a = v.select(F.col("id").alias("src"), F.explode("labels").alias("sl"))
    b = v.select(F.col("id").alias("dst"), F.explode("labels").alias("tl"))
    j = e.select("src", "dst", "type").join(a, "src").join(b, "dst")
    g = j.groupBy("sl", "type", "tl").agg(F.count(F.lit(1)).alias("frequency"))
    return g.select(F.concat(F.col("sl"), F.lit(" -[:"), F.col("type"), F.lit("]-> "), F.col("tl")).alias("pattern"),
                    "frequency")


def label_properties(v: DataFrame, sample: int = 100) -> DataFrame:
    """Per node label the property names seen on its first ``sample`` nodes."""
    x = v.select("id", "props", F.explode("labels").alias("node_type"))
    x = first_k(x, ["node_type"], [F.col("id")], sample)
    k = x.select("node_type", F.explode(F.map_keys("props")).alias("p"))
    return k.groupBy("node_type").agg(F.array_join(F.sort_array(F.collect_set("p")), ",").alias("properties"))


def rel_properties(e: DataFrame, sample: int = 100) -> DataFrame:
    """Per relationship type the property names of its first ``sample`` edges."""
    x = first_k(e.select("eid", "type", "props"), ["type"], [F.col("eid")], sample)
    k = x.select(F.col("type").alias("relationship_type"), F.explode(F.map_keys("props")).alias("p"))
    return k.groupBy("relationship_type").agg(F.array_join(F.sort_array(F.collect_set("p")), ",").alias("properties"))


def schema_overview(v: DataFrame, e: DataFrame, limit: int = 20) -> DataFrame:
    """(source label, type, target label) with counts and sample property
    names (the smallest key list, first 5 names)."""
    def keys(prefix):
        return F.array_join(F.slice(F.sort_array(F.map_keys("props")), 1, 5), ",").alias(f"{prefix}_keys")

    # property names, not values, go through the joins; rows are counted by all
    # names first, as the least of texts would be found by sorting all rows
    a = v.select(F.col("id").alias("src"), F.col("label").alias("a_label"), keys("a"))
    b = v.select(F.col("id").alias("dst"), F.col("label").alias("b_label"), keys("b"))
    h = e.select("src", "dst", F.col("type").alias("r_type"), keys("r")).join(a, "src").join(b, "dst")
    n = h.groupBy("a_label", "r_type", "b_label", "a_keys", "r_keys", "b_keys").agg(F.count(F.lit(1)).alias("n"))
    g = n.groupBy(F.col("a_label").alias("source_type"), F.col("r_type").alias("relationship_type"),
                  F.col("b_label").alias("target_type")).agg(
        F.sum("n").alias("count"),
        F.min("a_keys").alias("sample_source_properties"),
        F.min("r_keys").alias("sample_rel_properties"),
        F.min("b_keys").alias("sample_target_properties"))
    return top_k(g, [F.col("count").desc(), F.col("source_type"), F.col("relationship_type"), F.col("target_type")],
                 limit)


def meta_graph(v: DataFrame, e: DataFrame) -> DataFrame:
    """The schema graph: distinct (source label, type, target label)."""
    h = hop(v, e, None, None, None, "a", "r", "b")
    return h.select(F.col("a_label").alias("source_label"), F.col("r_type").alias("rel_type"),
                    F.col("b_label").alias("target_label")).distinct()


#: a neighbour with more hubs and more neighbours than this is worked out once for all hubs
SHARED = 64


def network_density(v: DataFrame, e: DataFrame, threshold: int = 20, shared: int = SHARED) -> DataFrame:
    """Companies with more than ``threshold`` REPORTS edges to metrics and
    their undirected 1..2-hop neighbourhood: label set and distinct size.

    Relationship uniqueness (e2 <> e1) is applied after collapsing parallel
    edges: from hub h through x, every neighbour y <> h of x is reachable, and h
    itself is reachable only when h and x share two or more edges.  So the hop
    joins distinct (h, x) pairs with distinct (x, y) pairs instead of edge rows.

    A neighbour x of many hubs that has many neighbours itself (a country, say)
    would give hubs x neighbours rows.  Such neighbours are left out of the join:
    hubs with the same set of them reach the same nodes through them, so these
    are joined and counted by label once for each set that occurs, and of the
    other nodes of a hub those outside its set's nodes are added.  What is left
    has ``shared`` rows an edge at most.
    """
    # read several times below: computed once, kept in the shared folder
    e = cut_lineage(e.select("eid", "src", "dst", "type")).withColumn("props", F.lit(None).cast("map<string,string>"))
    h = hop(v, e, "Company", ["REPORTS"], "Metric", "c", "r", "m")
    hubs = cut_lineage(h.groupBy("c_id").agg(F.count("r_eid").alias("metric_count")).where(
        F.col("metric_count") > threshold))
    und = e.select(F.col("src").alias("a"), F.col("dst").alias("b")).unionByName(
        e.select(F.col("dst").alias("a"), F.col("src").alias("b")))
    # only edges at the hubs and at their neighbours are ever needed (semi-joins
    # on small key sets), then parallel edges are collapsed to distinct pairs
    at_hub = und.join(hubs.select(F.col("c_id").alias("a")), "a", "left_semi")
    n1 = cut_lineage(at_hub.groupBy(F.col("a").alias("hub"), F.col("b").alias("x")).agg(F.count(F.lit(1)).alias("n_edges")))
    xs = n1.groupBy("x").agg(F.count(F.lit(1)).alias("n_hubs"))
    pairs = cut_lineage(und.join(xs.select(F.col("x").alias("a")), "a", "left_semi").select(F.col("a").alias("x"), F.col("b").alias("y")).distinct())
    many = pairs.groupBy("x").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shared)
    many = cut_lineage(xs.where(F.col("n_hubs") > shared).join(many, "x", "left_semi").select("x"))

    # sets of shared neighbours, the nodes that they reach, and how many rows of each label
    sets = n1.join(many, "x", "left_semi").groupBy("hub").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    numbered = cut_lineage(sets.select("xs").distinct().withColumn("set", F.monotonically_increasing_id()))
    of_hub = sets.join(numbered, "xs").select("hub", "set")
    reach = cut_lineage(numbered.select("set", F.explode("xs").alias("x")).join(pairs, "x").select("set", F.col("y").alias("node")).distinct())
    label = v.select(F.col("id").alias("node"), "label")
    through = of_hub.join(reach.join(label, "node").groupBy("set", "label").agg(F.count(F.lit(1)).alias("n")), "set")

    others = pairs.join(many, "x", "left_anti")
    rest = n1.select("hub", F.col("x").alias("node")).unionByName(
        n1.join(others, "x").select("hub", F.col("y").alias("node"))).where(F.col("node") != F.col("hub")).distinct()
    rest = rest.join(of_hub, "hub", "left").join(reach, ["set", "node"], "left_anti")
    rest = rest.join(label, "node").groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"))

    # the hub itself: not by the edge that led away from it
    back = n1.groupBy("hub").agg(F.max(((F.col("x") == F.col("hub")) | (F.col("n_edges") >= 2)).cast("long")).alias("n"))
    itself = back.join(of_hub, "hub", "left").select(F.col("hub").alias("node"), (F.col("n") - F.col("set").isNotNull().cast("long")).alias("n"))
    itself = itself.where(F.col("n") != 0).join(label, "node").select(F.col("node").alias("hub"), "label", "n")

    counts = through.select("hub", "label", "n").unionByName(rest).unionByName(itself).groupBy("hub", "label").agg(F.sum("n").alias("n"))
    g = counts.where(F.col("n") > 0).groupBy("hub").agg(
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("connected_types"),
        F.sum("n").alias("network_size"))
    names = v.select(F.col("id").alias("hub"), F.col("name").alias("central_company"))
    return g.join(hubs.withColumnRenamed("c_id", "hub"), "hub").join(names, "hub").select(
        "hub", "central_company", "metric_count", "connected_types", "network_size")


def _weight(col: Column, table: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for t, w in reversed(list(table.items())):
        out = F.when(col == t, F.lit(w)).otherwise(out)
    return out


def important_chains(v: DataFrame, e: DataFrame, limit: int = 25) -> DataFrame:
    """Two-edge chains from a company scored by relationship weights; the
    top ``limit`` by score (ties by start, first edge, second edge).

    The score depends only on the two relationship types, so the number of
    chains per (type1, type2) is computed first from degrees (sum over middle
    nodes of in-degree from companies x out-degree; no chain is materialised),
    the type pairs are taken in score order until ``limit`` chains are covered,
    and only chains of those type pairs are joined.  The degree table holds one
    row per (type1, type2): types x types rows, read on the driver."""
    e = cut_lineage(e.select("eid", "src", "dst", "type")).withColumn("props", F.lit(None).cast("map<string,string>"))
    comp = v.where(F.col("label") == "Company").select(F.col("id").alias("src"))
    e1 = e.join(comp, "src", "left_semi")
    indeg = e1.groupBy(F.col("dst").alias("mid"), F.col("type").alias("t1")).agg(F.count(F.lit(1)).alias("n1"))
    outdeg = e.groupBy(F.col("src").alias("mid"), F.col("type").alias("t2")).agg(F.count(F.lit(1)).alias("n2"))
    # mid must exist as a vertex for the chain to match (inner join in the pattern)
    known = v.select(F.col("id").alias("mid"))
    combos = indeg.join(outdeg, "mid").join(known, "mid", "left_semi").groupBy("t1", "t2").agg(
        F.sum(F.col("n1") * F.col("n2")).alias("n")).collect()

    def weight(t, table, other):
        return table.get(t, other)

    ranked = sorted(((weight(r.t1, schemas.CHAIN_WEIGHT_FIRST, schemas.CHAIN_WEIGHT_FIRST_ELSE)
                      + weight(r.t2, schemas.CHAIN_WEIGHT_SECOND, schemas.CHAIN_WEIGHT_SECOND_ELSE), r.t1, r.t2, r.n)
                     for r in combos), key=lambda x: -x[0])
    keep, covered, cut = [], 0, None
    for sc, t1, t2, n in ranked:
        if cut is not None and sc < cut:
            break
        keep.append((t1, t2))
        covered += n
        if covered >= limit and cut is None:
            cut = sc  # every pair with the same score must stay (ties by ids)
    if not keep:
        keep = [(None, None)]
    cond = None
    for t1, t2 in keep:
        c = (F.col("r1_type") == t1) & (F.col("r2_type") == t2)
        cond = c if cond is None else cond | c
    t1s = sorted({t for t, _ in keep if t is not None})
    t2s = sorted({t for _, t in keep if t is not None})
    p = _two_hop(v, e, "Company", t1s or None, None, t2s or None, None).where(cond)
    score = (_weight(F.col("r1_type"), schemas.CHAIN_WEIGHT_FIRST, schemas.CHAIN_WEIGHT_FIRST_ELSE)
             + _weight(F.col("r2_type"), schemas.CHAIN_WEIGHT_SECOND, schemas.CHAIN_WEIGHT_SECOND_ELSE))
    p = p.withColumn("importance_score", score)
    top = top_k(p, [F.col("importance_score").desc(), F.col("a_id"), F.col("r1_eid"), F.col("r2_eid")], limit)
    chain = F.concat(F.col("a_name"), F.lit(" -["), F.col("r1_type"), F.lit("]-> "), F.col("b_name"),
                     F.lit(" -["), F.col("r2_type"), F.lit("]-> "), F.col("c_name"))
    return top.select(
        F.col("a_name").alias("start_entity"), F.col("a_label").alias("start_type"),
        F.col("r1_type").alias("first_relationship"), F.col("b_name").alias("middle_entity"),
        F.col("b_label").alias("middle_type"), F.col("r2_type").alias("second_relationship"),
        F.col("c_name").alias("end_entity"), F.col("c_label").alias("end_type"),
        "importance_score", chain.alias("full_chain"))
