import zlib
from collections import defaultdict

from ticklake.llm import label_shards as L


def checked(rows, got, shards=16):
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == sorted(
        ((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows), key=str)
    by = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and 0 <= r["shard"] < shards and r["grown_shard"] is None
        by[r["shard"]].append(r)
    for members in by.values():
        assert sorted(m["slot"] for m in members) == list(range(len(members)))
    load = [sum(m["size"] for m in by.get(s, [])) for s in range(shards)]
    longest = max((r["size"] for r in got), default=0)
    assert max(load) - min(load) <= 2 * longest, load
    return by


def split_groups(rows, got):
    text, where, count = {d: t for d, t, _ in rows}, defaultdict(set), defaultdict(int)
    for r in got:
        where[text[r["doc_id"]]].add(r["shard"])
        count[text[r["doc_id"]]] += 1
    return sum(len(where[t]) > 1 for t in where if count[t] > 1), sum(n > 1 for n in count.values())


def test_smoke_table(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string, source string")
    got = L.shard_documents(df).collect()
    checked(documents, got)
    again = L.shard_documents(df.repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_linked_documents_share_shards(spark):
    rows = [(i, f"text {i // 3} " * 20, "a") for i in range(1500)] + [(10000 + i, f"alone {i} " * 20, "a") for i in range(3000)]
    got = L.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    checked(rows, got)
    split, groups = split_groups(rows, got)
    assert groups == 500 and split <= 25


def test_a_group_larger_than_a_shard(spark):
    rows = [(i, "the same text", "a") for i in range(2000)] + [(10000 + i, f"alone {i}", "a") for i in range(4000)]
    got = L.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = checked(rows, got)
    assert sum(any(m["doc_id"] < 10000 for m in members) for members in by.values()) < 16


def test_groups_larger_than_a_shard_are_gathered(spark):
    for part, most in ((1 / 3, 7), (1 / 5, 5), (1 / 10, 3)):
        hot = round(4500 * part)
        rows = [(i, "the same words", "a") for i in range(hot)] + [(10000 + i, f"alone {i:08d}", "a") for i in range(4500 - hot)]
        got = L.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
        by = checked(rows, got)
        assert sum(any(m["doc_id"] < 10000 for m in members) for members in by.values()) <= most, part


def test_small_groups_beside_a_large_one(spark):
    rows = [(i, "the same words", "a") for i in range(1500)] + [(10000 + i, f"pair {i // 3:09d}", "a") for i in range(600)]
    rows += [(20000 + i, f"alone {i:08d}", "a") for i in range(2400)]
    got = L.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = checked(rows, got)
    assert sum(any(m["doc_id"] < 10000 for m in members) for members in by.values()) <= 8
    split, groups = split_groups(rows, got)
    assert groups == 201 and split <= 11


def test_awkward_rows_and_empty(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    checked(rows, L.shard_documents(awkward).collect())
    assert L.shard_documents(empty).collect() == []
