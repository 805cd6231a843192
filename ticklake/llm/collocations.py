"""Phrase collocation mining with weighted acyclic automata.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and
pieces into words at blanks.  For every language the occurrences of all runs of
up to ``longest`` words inside a piece are counted:

1. each task reads its texts a few megabytes (a *shard*) at a time, counts the
   shard's runs in sorted order and builds their count automaton; the part of
   every range of prefixes (language and first two words) is sent as one packed
   automaton, so no text and no single run is shuffled, and a word, line or
   passage that a third of all documents hold is one arc of a shard;
2. each range adds its automata.  Runs with ``least`` occurrences become
   candidates; no part of a candidate is rarer than it;
3. the parts of all candidates (first k words, and the rest) are asked once each
   at the range that owns them: the automaton of the asked parts is composed
   with the range's count automaton, which gives their counts.

A candidate is dropped if a candidate of one more word that begins or ends with
it has ``inside`` percent of its occurrences.  Longer ones need not be looked
at: the run of one more word inside them occurs as often at least.  A cut scores
``floor(SCALE * a * a / (l * r))`` in 38-digit decimals, exact up to 10**15
occurrences; the lowest cut counts.  Each language's best ``top`` are returned.

With many ranges, shards would send very small messages.  Above ``MESSAGES``
messages they send ``COARSE`` groups of ranges instead, which are added for
some hundred shards at a time and cut into ranges then.

Defined results: null and empty texts have no words; a null language is
``und``.  Repeated rows count each.  A language without candidates, and an empty
table, give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batched import text_bytes
from .common import reliable, tasks
from .count_automata import Counts, build, compose, frequent, from_phrases, in_order, pack, phrases, split, union, unpack

SHORTEST, LONGEST, LEAST, TOP, SCALE, INSIDE = 2, 3, 10, 2000, 1_000_000, 50
UNKNOWN = "und"
#: bytes of text in a shard and for each range, about
SHARD, RANGE = 4 << 20, 6 << 20
MESSAGES, COARSE = 4_000_000, 170
_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: blank, 2: end of a piece
_KIND[list(_BLANKS)], _KIND[list(_BREAKS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shard_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words in order; of every word its text, its number, and how many
    words its piece has from it on."""
    data, offsets = text_bytes(texts)
    if not len(data):
        none = np.zeros(0, np.int64)
        return pa.array([], pa.large_string()), none, none, none
    kind = _KIND[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    begins[edges] = inside[edges]
    start = np.flatnonzero(begins)
    # words without the bytes between them are the buffer of an Arrow array
    kept = np.cumsum(inside, dtype=np.int32 if len(data) < 2**31 else np.int64)
    cut = np.append(kept[start] - 1, kept[-1]).astype(np.int64)
    del kept, begins
    coded = pc.dictionary_encode(pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(cut), pa.py_buffer(_LOWER[data[inside]])))
    words, rank = in_order(coded.dictionary)
    word = rank[coded.indices.to_numpy(zero_copy_only=False)] if len(start) else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, start, "right") - 1
    ends = np.flatnonzero(kind == 2)
    piece = np.searchsorted(ends, start) + text  # ends of pieces and texts before a word
    new = np.flatnonzero(np.append(piece[1:] != piece[:-1], True))
    return words, text, word, new[np.searchsorted(new, np.arange(len(start)))] + 1 - np.arange(len(start))


def shard_counts(texts: pa.Array, langs: pa.Array, longest: int) -> Counts | None:
    """The count automaton of a shard; none without words."""
    words, text, word, left = shard_words(texts)
    if not len(word):
        return None
    coded = pc.dictionary_encode(langs)
    lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return build(coded.dictionary.to_pylist(), words, lang[text], word, left, longest)


def prefix_range(lang: Column, words: Column, ranges: int) -> Column:
    """The range that owns a phrase (an array of words)."""
    h = F.xxhash64(F.element_at(words, 1)).bitwiseXOR(F.shiftleft(F.xxhash64(lang), 2))
    two = F.when(F.size(words) > 1, F.shiftleft(F.xxhash64(F.try_element_at(words, F.lit(2))), 1)).otherwise(F.lit(0).cast("long"))
    return F.shiftrightunsigned(h.bitwiseXOR(two), 1) % F.lit(ranges)


_PACKED = "shard long, range long, packed binary"
_COUNTED = "kind int, range long, lang string, phrase string, a long, packed binary"


def _messages(shard: int, parts: Iterator[tuple[int, Counts]]) -> pa.Table:
    found = [(r, pack(c)) for r, c in parts]
    return pa.table({"shard": pa.array([shard] * len(found), pa.int64()), "range": pa.array([r for r, _ in found], pa.int64()),
                     "packed": pa.array([p for _, p in found], pa.binary())})


def shard_automata(docs: DataFrame, ranges: int, longest: int, shard_bytes: int = SHARD) -> DataFrame:
    """One packed automaton for each shard and range that has words."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = (TaskContext.get().partitionId() << 20)
        for texts, langs in _shards(batches, shard_bytes):
            counts = shard_counts(texts, langs, longest)
            if counts is not None:
                yield from _messages(shard, split(counts, ranges)).to_batches()
                shard += 1

    return docs.mapInArrow(read, _PACKED)


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Texts and languages of about ``shard_bytes`` together; a longer text is a shard."""
    held, size = [], 0
    for batch in batches:
        lengths = np.diff(text_bytes(batch.column(0))[1])
        lo = 0
        while lo < batch.num_rows:
            room = np.searchsorted(np.cumsum(lengths[lo:]), shard_bytes - size, "right")
            hi = min(batch.num_rows, lo + max(int(room), 0 if held else 1))
            held.append(batch.slice(lo, hi - lo))
            size += int(lengths[lo:hi].sum())
            lo = hi
            if lo < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    table = pa.Table.from_batches(held).combine_chunks()
    return tuple(c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns)


def _regrouped(ranges: int):
    """Adds the automata of a group of ranges and cuts them into ranges."""
    def run(key: tuple, messages: pa.Table) -> pa.Table:
        total = union([unpack(x) for x in messages.column("packed").to_pylist()])
        return _messages(key[0].as_py(), split(total, ranges))
    return run


def _counted(shortest: int, least: int):
    """Adds the automata of a range: the words of each language (kind 0), the
    frequent runs as an automaton (kind 1), and the candidates (kind 2)."""
    def run(key: tuple, messages: pa.Table) -> pa.Table:
        total = union([unpack(x) for x in messages.column("packed").to_pylist()])
        lang, _, weight = total.levels[0]
        words = np.zeros(len(total.langs), np.int64)
        np.add.at(words, lang, weight)
        often = frequent(total, least)
        n = len(words)
        kinds, langs, spelled, counts = [np.zeros(n, np.int32)], [np.arange(n)], [pa.nulls(n, pa.large_string())], [words]
        for d, (lang, phrase, weight) in enumerate(phrases(often), 1):
            if d >= shortest:
                there = weight >= least
                kinds.append(np.full(int(there.sum()), 2, np.int32))
                langs.append(lang[there])
                spelled.append(phrase.filter(pa.array(there)))
                counts.append(weight[there])
        rows = pa.table({
            "kind": np.append(np.concatenate(kinds), np.int32(1)), "range": pa.array([key[0].as_py()] * (sum(map(len, kinds)) + 1), pa.int64()),
            "lang": pa.concat_arrays([pa.array(total.langs, pa.string()).take(pa.array(np.concatenate(langs))), pa.nulls(1, pa.string())]),
            "phrase": pa.concat_arrays([*spelled, pa.nulls(1, pa.large_string())]).cast(pa.string()), "a": np.append(np.concatenate(counts), 0)})
        return rows.append_column("packed", pa.array([None] * (rows.num_rows - 1) + [pack(often)], pa.binary()))
    return run


def _answered(key: tuple, asked: pa.Table, automata: pa.Table) -> pa.Table:
    """The counts of the asked parts of a range."""
    if not asked.num_rows:
        return pa.table({"lang": pa.array([], pa.string()), "part": pa.array([], pa.string()), "held": pa.array([], pa.int64()), "outer": pa.array([], pa.int64())})
    coded = pc.dictionary_encode(asked.column("lang").combine_chunks())
    query, length, node = from_phrases(coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), asked.column("part").combine_chunks())
    held, weights = np.zeros(asked.num_rows, np.int64), compose(query, unpack(automata.column("packed")[0].as_py()))
    for d, weight in enumerate(weights, 1):
        held[length == d] = weight[node[length == d]]
    return pa.table({"lang": asked.column("lang"), "part": asked.column("part"), "held": held, "outer": asked.column("outer")})


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", shortest: int = SHORTEST, longest: int = LONGEST, least: int = LEAST,
                 inside: int = INSIDE, top: int = TOP, shard_bytes: int = SHARD, range_bytes: int = RANGE, messages: int = MESSAGES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases."""
    picked = docs.select(docs[text_col].alias("text"), F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"))
    total = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(tasks(docs.sparkSession), -(-total // range_bytes))
    coarse = min(COARSE, ranges)
    if ranges * (total // shard_bytes + 1) > messages:
        # ``x % ranges`` is known from ``x % (coarse * k)``: make the ranges a multiple of the groups
        ranges = -(-ranges // coarse) * coarse
        groups = max(1, total // (shard_bytes * 256))
        first = shard_automata(picked, coarse, longest, shard_bytes).withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(groups)))
        sent = first.groupBy("shard", "range").applyInArrow(_regrouped(ranges), _PACKED)
    else:
        sent = shard_automata(picked, ranges, longest, shard_bytes)
    # a few ranges a task, however many there are
    sent = sent.repartition(max(tasks(docs.sparkSession), ranges // 4), "range")
    counted = reliable(sent.groupBy("range").applyInArrow(_counted(shortest, least), _COUNTED))
    size = counted.where("kind = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    found = counted.where("kind = 2").select("lang", "phrase", "a")

    words = F.split("phrase", " ")
    cuts = found.withColumn("words", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    first = F.slice("words", F.lit(1), F.col("k"))
    rest = F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))
    ends = F.when(F.col("k") == F.size("words") - 1, F.col("a")), F.when(F.col("k") == 1, F.col("a"))
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), p.alias("words"), e.alias("outer")) for s, p, e in ((0, first, ends[0]), (1, rest, ends[1]))]))
    halves = cuts.select("lang", "phrase", "a", "k", sides.alias("h")).select("lang", "phrase", "a", "k", "h.side", "h.words", "h.outer")
    parts = (halves.groupBy("lang", "words").agg(F.max("outer").alias("outer"))
             .select(prefix_range(F.col("lang"), F.col("words"), ranges).alias("range"), "lang", F.array_join("words", " ").alias("part"), "outer"))
    automata = counted.where("kind = 1").select("range", "packed")
    answers = reliable(parts.groupBy("range").cogroup(automata.groupBy("range")).applyInArrow(_answered, "lang string, part string, held long, outer long"))

    exact = F.col("a").cast("decimal(18,0)")
    score = F.call_function("div", exact * exact * F.lit(SCALE).cast("decimal(7,0)"), F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)"))
    joined = halves.withColumn("part", F.array_join("words", " ")).join(answers.select("lang", "part", "held"), ["lang", "part"])
    by_cut = joined.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("held"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("held"))).alias("r"))
    best = by_cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    within = answers.where(100 * F.col("outer") >= inside * F.col("held")).select("lang", F.col("part").alias("phrase"))
    kept = best.join(within, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = f"""
WITH lowered AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '{UNKNOWN}') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM lowered
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), runs AS (
  SELECT lang, w[i:i + m - 1] AS p FROM places, (SELECT unnest(range(1, {LONGEST} + 1)) AS m) WHERE i + m - 1 <= len(w)
), f AS (
  SELECT lang, p, count(*) AS a FROM runs GROUP BY lang, p
), sizes AS (
  SELECT lang, sum(a) AS n FROM f WHERE len(p) = 1 GROUP BY lang
), found AS (
  SELECT lang, p, a FROM f WHERE len(p) >= {SHORTEST} AND a >= {LEAST}
), cuts AS (
  SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM found
), scored AS (
  SELECT cuts.lang, cuts.p, cuts.a, k, x.a AS l, y.a AS r, {SCALE}::HUGEINT * cuts.a * cuts.a // (x.a::HUGEINT * y.a) AS score
  FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.p = cuts.p[1:k] JOIN f AS y ON y.lang = cuts.lang AND y.p = cuts.p[k + 1:]
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), longer AS (
  SELECT lang, p[1:len(p) - 1] AS p, a FROM found UNION ALL SELECT lang, p[2:] AS p, a FROM found
), kept AS (
  SELECT * FROM lowest WHERE NOT EXISTS (SELECT 1 FROM longer WHERE longer.lang = lowest.lang AND longer.p = lowest.p AND 100 * longer.a >= {INSIDE} * lowest.a)
), ranked AS (
  SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}
"""
