"""Target-distribution importance resampling.

A document's features are its runs of ``1..most`` consecutive words, hashed into
buckets.  The corpus holds s of its S features in a bucket, the target texts t
of their T; the bucket's *gain* is the scaled log ratio of its two smoothed
shares, and a document's weight the sum of its features' gains.  Adding Gumbel
noise, drawn from a hash of the id, to the weights and keeping the highest sums
is sampling without replacement in proportion to the importance weights.

Texts go through Arrow kernels, a few megabytes at a time: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` turn them
into one run of dictionary indices; indices shifted by one, two, ... places and
numbered by their distinct pairs are the longer runs.  Each distinct run is
hashed once (CRC-32), ``take`` hands its bucket or gain to every place, and a
segmented sum over the places of a document makes its weight.

Counting sends one row a task and bucket that occurs in it, so a hot bucket,
source or group of copies is a row a task.  What goes through the driver is one number a bucket
(``buckets`` is a parameter).  The draw sorts rows of four numbers by range and
numbers them with the offsets of the ranges; no text is shuffled at all.

Defined results: null texts have no words and weight 0.  A row without an id
takes its noise from the empty id and stands after equal scores with one.
Repeated rows are documents of their own; they share noise and score, and get
different ranks.  Without target texts all t are 0.  Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import dense_ids
from .batched import pieces, text_bytes
from .common import reliable

BUCKETS, MOST, SEED, SCALE = 10_000, 1, 2024, 1000
MIN_WORDS, PERCENT = 20, 10
#: bytes of text that the kernels see at a time; a longer text is a piece of its own
_PIECE = 4 << 20
#: the bytes between words
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All words as indices into a dictionary, the number of words of each text,
    and the dictionary."""
    # a slice is laid out anew first: ``ascii_lower`` misreads texts whose offsets do not begin at 0
    data, offsets = text_bytes(texts)
    whole = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(np.ascontiguousarray(data)))
    lists = pc.split_pattern_regex(pc.ascii_lower(whole), _GAPS)
    flat = pc.list_flatten(lists)
    there = pc.not_equal(flat, "")
    parents = pc.filter(pc.list_parent_indices(lists), there).to_numpy(zero_copy_only=False)
    coded = pc.dictionary_encode(pc.filter(flat, there))
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.bincount(parents, minlength=len(texts)), coded.dictionary


def _crc(runs: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(runs)
    raw, crc = data.tobytes(), zlib.crc32
    ends = offsets.tolist()
    return np.fromiter((crc(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)), np.int64, len(runs))


def features(texts: pa.Array, buckets: int = BUCKETS, most: int = MOST) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For pieces of the texts: the number of the first text, the number of words
    of each, and for all features the text, the distinct run, and the runs' buckets."""
    texts = texts.fill_null("")
    _, offsets = text_bytes(texts)
    for lo, hi in pieces(offsets, _PIECE):
        place, n_words, words = _words(texts[lo:hi])
        text = np.repeat(np.arange(hi - lo), n_words)
        runs, owners, codes = [place], [text], [_crc(words) % buckets]
        spelled, current, owner, known = words, place, text, len(words)
        for n in range(2, most + 1):
            # a run of n words: the run of n - 1 before it, and the next word of the same text
            inside = owner[:len(owner) - 1] == text[n - 1:] if len(owner) > 1 else np.zeros(0, bool)
            pair = (current[:-1] * len(words) + place[n - 1:])[inside]
            distinct, current_inside = np.unique(pair, return_inverse=True)
            before, last = np.divmod(distinct, max(1, len(words)))
            spelled = pc.binary_join_element_wise(spelled.take(pa.array(before)), words.take(pa.array(last)), pa.scalar(" ", pa.large_string()))
            codes.append(_crc(spelled) % buckets)
            runs.append(current_inside + known)
            owners.append(owner[:-1][inside])
            known += len(distinct)
            # runs keep one entry a place, so that the next shift lines up; others end their text
            current = np.zeros(len(inside), np.int64)
            current[inside] = current_inside
            owner = np.where(inside, owner[:-1], -1)
        yield lo, n_words, np.concatenate(owners), np.concatenate(runs), np.concatenate(codes)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most: int = MOST) -> DataFrame:
    """(bucket, n) over all texts; buckets that do not occur have no row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, run, code in features(batch.column(0), buckets, most):
                total += np.bincount(code.take(run), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return texts.select(texts[text_col].alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket."""
    whole, aimed = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(SCALE * math.log((target.get(b, 0) + 1) * whole / ((corpus.get(b, 0) + 1) * aimed))) for b in range(buckets)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Scaled Gumbel noise of a document."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, count, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for lo, n_words, owner, run, code in features(batch.column(1), buckets, most):
                hi = lo + len(n_words)
                words[lo:hi] = n_words
                order = np.argsort(owner, kind="stable")
                owner, value = owner[order], gain.take(code).take(run[order])
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                if len(first):
                    weight[lo + owner[first]] = np.add.reduceat(value, first)
                count[lo:hi] = np.bincount(owner, minlength=hi - lo)
            luck = np.fromiter(map(functools.partial(noise, seed=seed), batch.column(0).to_pylist()), np.int64, n)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (words, count, weight, weight + luck))],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return picked.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS,
             most: int = MOST, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row (null: not drawn);
    ``percent`` of the documents with ``min_words`` words are drawn."""
    # at most ``buckets`` rows each
    corpus = dict(bucket_counts(docs, text_col, buckets, most).collect())
    aimed = dict(bucket_counts(target, target_col, buckets, most).collect())
    scored = reliable(weigh(docs, gains(corpus, aimed, buckets), id_col, text_col, most, seed))
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    placed = dense_ids(scored.where(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], 0, "place")
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    out = placed.withColumn("rank", rank).drop("place").unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 from its polynomial: the 256 remainders of one byte, then a fold over the bytes of each distinct word.
SQL = f"""
WITH RECURSIVE rest AS (
  SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) AS t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM rest WHERE k < 8
), remainders AS (
  SELECT list(c ORDER BY i) AS r FROM rest WHERE k = 8
), words AS (
  SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 't', NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark
), bytes AS (
  SELECT w, list_transform(range(1, octet_length(encode(w)) + 1), lambda i: ('0x' || substr(hex(encode(w)), 2 * i - 1, 2))::BIGINT) AS b FROM (SELECT DISTINCT w FROM words)
), coded AS (
  SELECT w, xor(list_reduce(b, lambda c, x: xor(c >> 8, r[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket FROM bytes, remainders
), held AS (
  SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 't') AS t FROM words JOIN coded USING (w) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0) + {BUCKETS} AS ss, coalesce(sum(t), 0) + {BUCKETS} AS tt FROM held
), gain AS (
  SELECT bucket, floor({SCALE} * ln((t + 1)::DOUBLE * ss::DOUBLE / ((s + 1)::DOUBLE * tt::DOUBLE)))::BIGINT AS g FROM held, totals
), weighed AS (
  SELECT doc_id, count(*) AS n, sum(g) AS weight FROM words JOIN coded USING (w) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT
         + floor(-{SCALE} * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weighed USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= {MIN_WORDS}
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= able * {PERCENT} // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""
