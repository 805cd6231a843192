"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

A document's set is its distinct word n-grams, as 64-bit hashes.  Two sets link
when their Jaccard similarity is at least ``percent`` / 100; then their overlap
is at least ``need(a, b) = ceil(percent * (a + b) / (100 + percent))``.

*Small sets*: every subset that a link could share, of the fixed size
``need(a, b)`` for each partner size ``b``, becomes a key.  Sets with the same
key overlap enough and link; no pair has to be looked at.

*Large sets*: inverted lists.  Elements are ordered by how many documents hold
them, rarest first; two linked sets share one of their first
``a - ceil(percent * a / 100) + 1`` elements, so only these are listed, and only
those that two documents hold.  Lists also hold the small sets that could link
with a large one.

The boundary is the largest size whose subsets cost less than scanning its
lists would (``list_cost`` a listed element).

Candidates are pairs in a list that their sizes and places allow; the overlap is
then counted exactly.  First each list gives pairs with three of its members
only (a star): the two with the fewest elements of their own, which are nearest
to what the group has in common, and one by hash.  Only between different
components of these links the lists then give all remaining pairs that could
link.  There a sketch of each set, which has a bit flipped for each element,
rules pairs out: where two sketches differ in more bits than linked sets could
differ in elements, the sets do not link.  So a large group of near copies costs
a few pairs a member and no link that joins components is lost.  Components are
found by passing the smallest label along links, with pointer jumping.

Equal sets are one node.  Elements are counted by batch before they are
shuffled (see ``batched``), so neither an element nor a set that a third of all
documents share is a hot key; lists and joins are by element and by node.

Defined results: null texts and texts without words have no set and link with
nothing; their component is themselves.  A text with fewer words than n has one
element.  Rows without an id take part through their text; a component of such
rows alone has no id.  Repeated rows are kept.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .batched import BYTE_CODE, deal, mixed, ordered, pieces, text_bytes
from .common import A_Z, a_z, reliable, tasks

N, PERCENT, LIST_COST, SKETCH = 5, 80, 8, 1024
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C55)


def need(a, b, percent: int):
    return -(-percent * (a + b) // (100 + percent))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts, and how many words come
    before each text (with the end)."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[:-1][(offsets[:-1] < len(data))]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    before = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    at = np.flatnonzero(solid)
    word = np.cumsum(first[at]) - 1
    place = at - starts[word]
    powers = np.ones(int(place.max()) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(powers) - 1, _STEP, np.uint64), out=powers[1:])
    codes = BYTE_CODE[_LOWER[data[at]]]
    codes *= powers[place]
    return mixed(np.add.reduceat(codes, np.searchsorted(at, starts))), before


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = N) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of every text."""
    words, before = word_hashes(data, offsets)
    if len(words) >= n:
        grams = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            grams = mixed(grams + words[k:len(words) - n + 1 + k])
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)  # fewer words: one element, apart from those of n words
            for w in words[a:b]:
                h = mixed(h + w)
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def small_limit(percent: int = PERCENT, list_cost: int = LIST_COST) -> int:
    """The largest size whose subsets cost less than its lists."""
    size = 0
    while subsets(size + 1, percent) <= list_cost * (size + 1 - (-(-percent * (size + 1) // 100)) + 1):
        size += 1
    return size


def partners(a: int, percent: int) -> range:
    return range(-(-percent * a // 100), 100 * a // percent + 1)


def subsets(a: int, percent: int) -> int:
    return sum(comb(a, need(a, b, percent)) for b in partners(a, percent))


def subset_keys(elements: np.ndarray, percent: int, limit: int) -> list[tuple[int, bool]]:
    """(key, whether this set is the smaller or equal one) for every subset
    that a link with another small set could share."""
    a, out = len(elements), []
    values = elements.tolist()
    for b in partners(a, percent):
        if b > limit:
            continue
        for chosen in itertools.combinations(values, need(a, b, percent)):
            raw = np.array([min(a, b), max(a, b), *chosen], np.uint64).tobytes()
            out.append((int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True), a <= b))
    return out


class _Batch:
    """The sets of a batch of documents, equal sets once."""

    def __init__(self, docs: pa.Table, n: int, buckets: int):
        docs = ordered(docs)
        data, offsets = text_bytes(docs.column("text"))
        sets = [s for a, b in pieces(offsets) for s in shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], n)]
        self.doc_ids = docs.column("doc_id").to_pylist()
        self.rows = docs.column("row").to_pylist() if "row" in docs.column_names else [None] * docs.num_rows
        self.nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        self.sizes = [len(s) for s in sets]
        self.distinct = {node: s for node, s in zip(self.nodes, sets, strict=True) if node is not None}
        everything = np.concatenate([np.zeros(0, np.uint64), *self.distinct.values()])
        # a key: the bucket, then 32 bits; two elements with one key are only counted together
        coded = self.coded(everything, buckets)
        self.keys, self.counts = np.unique(coded, return_counts=True)
        self.buckets = buckets

    @staticmethod
    def coded(elements: np.ndarray, buckets: int) -> np.ndarray:
        return ((elements >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (elements & np.uint64(0xFFFFFFFF))

    def messages(self, batch: int) -> pa.Table:
        bucket = (self.keys >> np.uint64(32)).astype(np.int64)
        found, at = np.unique(bucket, return_index=True)
        ends = np.append(at[1:], len(bucket))[: len(at)]
        low, counts = self.keys.astype(np.uint32), np.minimum(self.counts, 255).astype(np.uint8)
        return pa.table({"batch": pa.array([batch] * len(found), pa.int64()), "bucket": pa.array(found, pa.int64()),
                         "keys": pa.array([low[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()),
                         "counts": pa.array([counts[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())})


def _count(messages: pa.Table) -> pa.Table:
    """In a bucket: how many documents hold each key, for every batch."""
    raw = messages.column("keys").to_pylist()
    keys = np.concatenate([np.frombuffer(x, np.uint32) for x in raw])
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in messages.column("counts").to_pylist()])
    _, where = np.unique(keys, return_inverse=True)
    total = np.minimum(np.bincount(where, counts), 65535).astype(np.uint16)[where]
    ends = np.cumsum([len(x) // 4 for x in raw])
    return pa.table({"batch": messages.column("batch"), "bucket": messages.column("bucket"),
                     "held": pa.array([part.tobytes() for part in np.split(total, ends[:-1])], pa.binary())})


_FOUND = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("doc_id", pa.int64()), ("node", pa.binary()), ("size", pa.int32()),
                    ("place", pa.int32()), ("lead", pa.int32()), ("elements", pa.list_(pa.int64())), ("sketch", pa.binary())])
_FOUND_DDL = "kind string, key long, doc_id long, node binary, size int, place int, lead int, elements array<long>, sketch binary"


def _emit(batch: _Batch, held: np.ndarray, percent: int, limit: int) -> pa.Table:
    """Members, subset keys and list entries of a batch, and the sets listed."""
    members = {"kind": pa.array(["member"] * len(batch.nodes)), "key": pa.array(batch.rows, pa.int64()), "doc_id": pa.array(batch.doc_ids, pa.int64()),
               "node": pa.array(batch.nodes, pa.binary()), "size": pa.array(batch.sizes, pa.int32())}
    parts = [pa.table([members.get(f.name, pa.nulls(len(batch.nodes), f.type)) for f in _FOUND], schema=_FOUND)]
    rows: list[tuple] = []
    for node, elements in batch.distinct.items():
        size = len(elements)
        if size <= limit:
            rows += [("subset", key, None, node, size, int(low), None, None, None) for key, low in subset_keys(elements, percent, limit)]
        if 100 * size >= percent * (limit + 1):
            often = held[np.searchsorted(batch.keys, batch.coded(elements, batch.buckets))]
            order = np.lexsort((elements, often))[: size - (-(-percent * size // 100)) + 1]
            listed = order[often[order] > 1]
            if len(listed):
                signed, places = elements.view(np.int64), np.flatnonzero(often[order] > 1).tolist()
                rows += [("list", key, None, node, size, place, places[0], None, None) for key, place in zip(signed[listed].tolist(), places, strict=True)]
                rows.append(("set", None, None, node, size, None, None, signed, sketch(elements)))
    if rows:
        parts.append(pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)], schema=_FOUND))
    return pa.concat_tables(parts)


def sketch(elements: np.ndarray) -> bytes:
    """A bitmap in which every element flips one bit.  Two sketches differ in
    at most as many bits as the sets in elements."""
    bits = np.bincount((elements >> np.uint64(20)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in ``links`` (a, b): the smallest node
    that links reach."""
    both = reliable(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = reliable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        jumped = lower.join(labels.select(F.col("node").alias("now"), F.col("component").alias("far")), "now")
        moved = reliable(jumped.select("node", "was", F.least("now", "far").alias("component")))
        labels = moved.select("node", "component")
        if not moved.where("was <> component").limit(1).count():
            return labels


def _stars(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of each list's members with three of them."""
    entry = F.struct("node", "size", "place")
    centres = lists.groupBy("key").agg(F.min_by(entry, F.struct("lead", "node")).alias("x"), F.min_by(entry, F.struct("lead", F.xxhash64("node"))).alias("y"),
                                       F.min_by(entry, F.xxhash64("node")).alias("z"), F.count("*").alias("n"))
    pairs = lists.join(centres.where("n > 1"), "key").select("node", "size", "place", F.explode(F.array("x", "y", "z")).alias("c"))
    return _allowed(pairs.select("node", "size", "place", F.col("c.node").alias("node2"), F.col("c.size").alias("size2"), F.col("c.place").alias("place2")), percent)


def _allowed(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of the pairs that sizes and places allow."""
    least = F.ceil(percent * (F.col("size") + F.col("size2")) / F.lit(100.0 + percent) - 1e-9)
    room = F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2"))
    return (pairs.where((F.col("node") != F.col("node2")) & (room >= least))
            .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct())


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    first = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    second = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb"))
    return (pairs.join(first, "a").join(second, "b")
            .where(100 * both >= percent * (F.size("ea") + F.size("eb") - both)).select("a", "b"))


def _between(lists: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs in lists whose members are in different components."""
    told = lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed_lists = told.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")

    def pairs(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        node, component = (table.column(c).to_pylist() for c in ("node", "component"))
        size, place = (table.column(c).to_numpy().astype(np.int64) for c in ("size", "place"))
        names: dict[bytes, int] = {}
        label = np.array([names.setdefault(c, len(names)) for c in component])
        keys, out = table.column("key").to_numpy(), set()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(keys), -1)
        ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
        room = size - place
        start = 0
        for end in ends.tolist():
            for i in range(start, end - 1):
                rest = slice(i + 1, end)
                least = need(size[i], size[rest], percent)
                at = np.flatnonzero((label[rest] != label[i]) & (np.minimum(room[i], room[rest]) >= least))
                differ = np.bitwise_count(sketches[at + i + 1] ^ sketches[i]).sum(axis=1, dtype=np.int64)
                at = at[differ <= size[i] + size[rest][at] - 2 * least[at]] + i + 1
                out.update((min(node[i], node[j]), max(node[i], node[j])) for j in at.tolist())
            start = end
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    bucket = F.pmod(F.xxhash64("key"), F.lit(4 * tasks(lists.sparkSession)))
    return (told.join(mixed_lists, "key", "left_semi").join(sets.select("node", "sketch"), "node").withColumn("bucket", bucket).groupBy("bucket")
            .applyInArrow(pairs, "a binary, b binary").where("a <> b").distinct())


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT,
                       list_cost: int = LIST_COST) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return _joined(docs, id_col, text_col, n, percent, list_cost).select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def surplus_rows(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT,
                 list_cost: int = LIST_COST) -> DataFrame:
    """The row ids (``row_col``) of all but one document of each component: the
    one with the smallest id stays, of rows with one id the first row."""
    joined = _joined(docs, id_col, text_col, n, percent, list_cost, row_col).where("component is not null")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = joined.groupBy("component").agg(F.min_by("row", order).alias("stays"))
    return joined.join(first, "component").where("row <> stays").select(F.col("row").alias(row_col))


def _joined(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int, list_cost: int, row_col: str | None = None) -> DataFrame:
    """row, doc_id, n_shingles, component (null without a set), component_id."""
    spark = docs.sparkSession
    dealt, batches = deal(docs, id_col, text_col, carry={"row": row_col} if row_col else {})
    buckets, limit = batches, small_limit(percent, list_cost)

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        return _Batch(table, n, buckets).messages(key[0].as_py())

    def answer(table: pa.Table, answers: pa.Table) -> pa.Table:
        batch = _Batch(table, n, buckets)
        held = np.frombuffer(b"".join(answers.sort_by("bucket").column("held").to_pylist()), np.uint16)
        return _emit(batch, held, percent, limit)

    asked = dealt.groupBy("batch").applyInArrow(ask, "batch long, bucket long, keys binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(_count, "batch long, bucket long, held binary")
    found = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(answer, _FOUND_DDL)
    path = shared_path(spark, f"jaccard-{uuid.uuid4().hex}")
    found.write.partitionBy("kind").parquet(path)
    found = spark.read.schema(_FOUND_DDL).parquet(path)

    members = found.where("kind = 'member'").select(F.col("key").alias("row"), "doc_id", F.col("size").cast("long").alias("n_shingles"), "node")
    sets = found.where("kind = 'set'").dropDuplicates(["node"]).select("node", "elements", "sketch")
    lists = found.where("kind = 'list'").select("key", "node", "size", "place", "lead").distinct()
    # sets of the smaller size that share a subset link with each other and with those of the larger size
    keyed = found.where("kind = 'subset'").select("key", "node", "size", F.col("place").alias("low")).distinct()
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("low").alias("any_low")).where("any_low = 1")
    linked_small = (keyed.join(hubs, "key").where("node <> hub")
                    .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    linked = reliable(linked_small.union(_verified(_stars(lists, percent), sets, percent)))
    labels = components(linked)
    more = _verified(_between(lists, labels, sets, percent), sets, percent)
    labels = components(linked.union(more))
    least = members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return members.join(named.join(smallest, "component").select("node", "component", "component_id"), "node", "left").drop("node")


SQL = f"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{A_Z}', '{a_z}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT r, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS (
  SELECT x, y FROM (SELECT a.r AS x, b.r AS y, count(*) AS common FROM shingles a JOIN shingles b USING (s) GROUP BY ALL)
  JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT words.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN words.doc_id ELSE least END AS component_id
FROM words LEFT JOIN sizes USING (r)
LEFT JOIN (SELECT reach.x AS r, min(w.doc_id) AS least FROM reach JOIN words w ON w.r = reach.y GROUP BY ALL) USING (r)
"""
