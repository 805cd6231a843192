import hashlib
from collections import Counter

import sentencepiece

import corpus_pipeline as C
from ticklake.llm.queries import model_file

from test_jaccard_join import brute as components
from test_quality_rules import brute as judged
from test_suffix_dedup import brute as cut


def test_stages_like_brute_force(spark, smoke_dir, tmp_path):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}

    def stage(i, df):
        out = C.STAGES[i][1](spark, df, smoke_dir)
        assert i == 4 or [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
        out.write.parquet(str(tmp_path / str(i)))
        return spark.read.parquet(str(tmp_path / str(i)))

    first = stage(0, docs)
    kept = {d for d, *_, ok in judged([(d, r["text"], r["source"]) for d, r in rows.items()]) if ok}
    assert sorted(map(tuple, first.collect())) == sorted(tuple(r) for d, r in rows.items() if d in kept)

    second = stage(1, first)
    stays = {d for d, n, c in components([(d, rows[d]["text"]) for d in kept]) if d == c}
    assert sorted(map(tuple, second.collect())) == sorted(tuple(rows[d]) for d in stays)

    third = stage(2, second)
    left = {r["doc_id"]: r for r in third.collect()}
    assert left.keys() == stays
    for d, _, n_removed, _, sha in cut([(d, rows[d]["text"]) for d in stays]):
        text = left[d]["text"]
        assert left[d]["n_chars"] == len(text) and left[d]["source"] == rows[d]["source"]
        if hashlib.sha256(text.encode()).hexdigest() != sha:  # a character was cut
            assert len(text.encode()) > len(rows[d]["text"].encode()) - n_removed

    fourth = stage(3, third)
    copies = Counter(r["doc_id"] for r in fourth.collect())
    assert max(copies.values()) <= 3 and all(tuple(r) == tuple(left[r["doc_id"]]) for r in fourth.collect())

    library = sentencepiece.SentencePieceProcessor(model_file=model_file())
    last = stage(4, fourth).collect()
    assert Counter(r["doc_id"] for r in last) == copies
    for r in last:
        ids = library.encode(left[r["doc_id"]]["text"])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_rows_without_ids_and_repeated_rows(spark):
    long = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(1, long, "en", "a", 1), (1, long, "en", "a", 1), (None, other, "en", None, 1), (None, None, None, None, None), (2, "short", "en", "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = C.shared_path(spark, "rows-" + C.uuid.uuid4().hex)
    docs.write.parquet(path)
    df = spark.read.parquet(path)
    df = C.good(spark, df, "")
    assert sorted((r["doc_id"] or 0, len(r["text"])) for r in df.collect()) == [(0, len(other)), (1, len(long)), (1, len(long))]
    df.write.parquet(path + "b")
    df = C.distinct(spark, spark.read.parquet(path + "b"), "")
    assert sorted((r["doc_id"] or 0) for r in df.collect()) == [0, 1]
    df = C.unrepeated(spark, df, "")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in df.collect()) == [(0, other), (1, long)]


def test_run(spark, smoke_dir):
    got = C.run(spark, smoke_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0
