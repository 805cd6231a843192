"""Document fingerprints by a randomised edit embedding.

The embedding walks over a text's characters and writes one symbol a step: the
character it stands at; a random bit, shared by all texts and drawn for the step
and the character, says whether it moves on.  Texts of a small edit distance
meet again after an edit, in the same step at the same character, and write the
same symbols from there on, so edit distance becomes Hamming distance.  Several
walks with bits of their own are made, as one of them may miss to meet again;
the likest one counts.

The bits are periodic in the steps (``PERIOD``), characters fall into ``CLASSES``
classes and are left after ``LONGEST`` steps at the latest, so a walk is a finite
automaton whose states are the phases; it reads two characters at a time.  The
steps at every 32nd character, and at those around a sample, follow from the phases.

A fingerprint samples the written symbols: one step in each block of
``2 ** level`` steps, where the level is the least with ``SAMPLES`` blocks or
fewer.  The step of a block is the step of one of its two halves, so fingerprints
of different levels are compared at the coarser one.  Equal texts have equal
fingerprints; likeness is the share of equal samples among those that either
text has, 0 to 1.

``fingerprints`` also compares each text with the next one (by descending id) and
with an edited text made of both.  Rows are sorted by range once, and each task
walks over its rows in order; only the last row of a range waits for the first
text of the next range, which is one row a range.

``near_copies`` uses the fingerprints as an index: bands of sampled symbols are
keys, texts that share a key with the least document of the key are candidates,
and the exact edit distance of the texts decides.

Defined results: null is the empty text, whose fingerprint has no samples; two
empty texts are alike, likeness 1.  Rows without an id come after all others; rows
with one id are ordered by the hash of their texts.  The only row of a table is its own
next one.  Repeated rows are kept.  An empty table gives no rows.  Other columns
are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import operator
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batched import mixed
from .common import reliable, tasks
from .jaccard_join import components

WALKS, PERIOD, SAMPLES, CLASSES = 3, 128, 64, 16
#: a character is left after so many steps at most
LONGEST = 15
#: samples in a band, and bands of a walk and level
BAND, BANDS = 6, 10
#: pairs of characters between two places whose steps are kept; ``2 * _STRIDE * LONGEST`` is below ``PERIOD``
_STRIDE = 4
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_phase = operator.itemgetter(CLASSES * CLASSES)

#: what a text has of a walk: its level and its samples
Fingerprint = list[tuple[int, np.ndarray]]


def _hash(*parts) -> np.ndarray:
    total = np.uint64(0)
    for k, x in zip(_K, parts, strict=False):
        total = mixed(total + (np.asarray(x).astype(np.uint64) + np.uint64(1)) * k)
    return total


@functools.lru_cache(maxsize=None)
def stays(walk: int) -> np.ndarray:
    """``stays[phase, class]``: for how many steps a walk that arrives in a phase
    stays at a character: up to the first step whose bit is set."""
    bits = (_hash(np.arange(PERIOD)[:, None], np.arange(CLASSES)[None, :], np.full((1, CLASSES), walk)) & np.uint64(1)).astype(bool)
    out = np.full((PERIOD, CLASSES), LONGEST, np.int64)
    for n in range(LONGEST - 1, 0, -1):
        out[bits[(np.arange(PERIOD) + n - 1) % PERIOD]] = n
    return out


@functools.lru_cache(maxsize=None)
def _states(walk: int) -> list[list]:
    """The automaton of a walk over pairs of characters: a state's entry for two
    classes is the state after both, and its last entry is its phase."""
    stay = stays(walk)
    middle = (np.arange(PERIOD)[:, None] + stay) % PERIOD
    after = (middle[:, :, None] + stay[middle]) % PERIOD
    states: list[list] = [[] for _ in range(PERIOD)]
    for j, state in enumerate(states):
        state.extend(map(states.__getitem__, after[j].reshape(-1).tolist()))
        state.append(j)
    return states


def points(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def classes(codes: np.ndarray) -> np.ndarray:
    """The class of every character."""
    return (mixed(codes.astype(np.uint64) + np.uint64(1)) % np.uint64(CLASSES)).astype(np.uint8)


def _pairs(kinds: np.ndarray) -> bytes:
    """Pairs of classes; a last single one has company that is not counted."""
    even = np.append(kinds, np.zeros(len(kinds) % 2, np.uint8))
    return (even[0::2] * np.uint8(CLASSES) | even[1::2]).tobytes()


@functools.lru_cache(maxsize=None)
def _picks(level: int) -> np.ndarray:
    """The sampled step of the first ``SAMPLES`` blocks of a level."""
    at = np.arange(SAMPLES)
    for down in range(level, 0, -1):
        at = 2 * at + _half(down, at)
    return at


def _half(level: int, block: np.ndarray) -> np.ndarray:
    """Which half of a block its sample is taken from."""
    return (_hash(block, np.full(len(block), level)) & np.uint64(1)).astype(np.int64)


@functools.lru_cache(maxsize=None)
def _chosen(level: int) -> np.ndarray:
    """The block one level lower that gives the sample of each block."""
    block = np.arange(SAMPLES)
    return 2 * block + _half(level, block)


@functools.lru_cache(maxsize=None)
def _all_stays() -> np.ndarray:
    return np.stack([stays(w) for w in range(WALKS)])


def _marked(walks: list[list[list]], kinds: np.ndarray, codes: np.ndarray) -> Fingerprint:
    """The samples of all walks; ``walks`` are the states before each pair."""
    n = len(kinds)
    if not n:
        return [(0, np.zeros(0, np.uint8))] * WALKS
    stay, pairs, each = _all_stays(), -(-n // 2), np.arange(WALKS)
    kept = np.fromiter(map(_phase, chain.from_iterable(states[:pairs:_STRIDE] for states in walks)), np.int64).reshape(WALKS, -1)
    begin = np.zeros(kept.shape, np.int64)
    np.cumsum((kept[:, 1:] - kept[:, :-1]) % PERIOD, axis=1, out=begin[:, 1:])
    last = np.array([states[pairs - 1][-1] for states in walks])
    more = stay[each, last, kinds[2 * pairs - 2]]
    if n % 2 == 0:
        more = more + stay[each, (last + more) % PERIOD, kinds[n - 1]]
    lengths = begin[:, -1] + (last - kept[:, -1]) % PERIOD + more
    levels = [(max(1, -(-x // SAMPLES)) - 1).bit_length() for x in lengths.tolist()]
    picks = [_picks(level)[:-(-x // (1 << level))] for x, level in zip(lengths.tolist(), levels, strict=True)]
    at, walk = np.concatenate(picks), np.repeat(each, [len(p) for p in picks])
    # the stretch that holds each sampled step, the states there, and the pair among them
    apart = 1 << 48
    stretch = (begin + each[:, None] * apart).reshape(-1).searchsorted(at + walk * apart, "right") - 1
    near = np.minimum((stretch - walk * begin.shape[1])[:, None] * _STRIDE + np.arange(_STRIDE), pairs - 1)
    ends = np.cumsum([len(p) for p in picks]).tolist()
    there = chain.from_iterable(map(states.__getitem__, near[end - len(p):end].reshape(-1).tolist()) for states, p, end in zip(walks, picks, ends, strict=True))
    phases = np.fromiter(map(_phase, there), np.int64, near.size).reshape(near.shape)
    steps = begin.reshape(-1)[stretch][:, None] + (phases - phases[:, :1]) % PERIOD
    here = np.arange(len(at)), (steps <= at[:, None]).sum(axis=1) - 1
    first = 2 * near[here]
    char = np.minimum(first + (at >= steps[here] + stay[walk, phases[here], kinds[first]]), n - 1)
    symbols = 1 + _hash(codes[char], at, walk) % np.uint64(255)
    symbols = np.where(at < lengths[walk], symbols, 0).astype(np.uint8)  # the last block may be short
    return [(level, symbols[end - len(p):end]) for level, p, end in zip(levels, picks, ends, strict=True)]


def fingerprint(text: str) -> Fingerprint:
    return _Text(text).mark


class _Text:
    """A text, the states of its walks, and its fingerprint."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.codes = points(self.text)
        self.kinds = classes(self.codes)
        pairs = _pairs(self.kinds)
        self.walks = [list(accumulate(pairs, operator.getitem, initial=_states(w)[0])) for w in range(WALKS)]
        self.mark = _marked(self.walks, self.kinds, self.codes)

    def edited(self, following: _Text) -> tuple[str, Fingerprint]:
        """The text with its second half replaced by the beginning of the
        following one, and its fingerprint: the walks go on from the middle."""
        n = len(self.text)
        kept = n - n // 2
        codes, kinds = (np.concatenate([a[:kept], b[:n // 2]]) for a, b in ((self.codes, following.codes), (self.kinds, following.kinds)))
        pair = kept // 2
        rest = _pairs(kinds[2 * pair:])
        walks = [states[:pair] + list(accumulate(rest, operator.getitem, initial=states[pair])) for states in self.walks]
        return self.text[:kept] + following.text[:n // 2], _marked(walks, kinds, codes)


def packed(mark: Fingerprint) -> bytes:
    """Level, number of samples and samples of every walk."""
    return b"".join(bytes([level, len(samples)]) + samples.tobytes() for level, samples in mark)


def parsed(raw: bytes) -> Fingerprint:
    out, at = [], 0
    for _ in range(WALKS):
        level, n = raw[at], raw[at + 1]
        out.append((level, np.frombuffer(raw, np.uint8, n, at + 2)))
        at += 2 + n
    return out


def _coarser(level: int, samples: np.ndarray, to: int) -> np.ndarray:
    for up in range(level + 1, to + 1):
        at = _chosen(up)[:-(-len(samples) // 2)]
        samples = np.append(samples, np.uint8(0))[at]  # a missing last one is after the end
    return samples


def likeness(one: Fingerprint, other: Fingerprint) -> float:
    """Share of equal samples, in the likest walk."""
    best = 0.0
    for (la, a), (lb, b) in zip(one, other, strict=True):
        if la == lb and len(a) == len(b) and a.tobytes() == b.tobytes():
            return 1.0
        level = max(la, lb)
        a, b = _coarser(la, a, level), _coarser(lb, b, level)
        n = min(len(a), len(b))
        either = int(np.count_nonzero(a[:n] | b[:n]) + np.count_nonzero(a[n:]) + np.count_nonzero(b[n:]))
        best = max(best, int(np.count_nonzero((a[:n] == b[:n]) & (a[:n] > 0))) / max(1, either))
    return best


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _row(doc_id: int | None, text: _Text, following: _Text) -> tuple:
    body, mark = text.edited(following)
    return (doc_id, len(text.text), hashlib.sha256(body.encode("utf-8", "surrogatepass")).hexdigest(), packed(text.mark), packed(mark),
            likeness(text.mark, mark), likeness(text.mark, following.mark))


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
                     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_EDGED = pa.schema([*_RESULT, ("edge", pa.int32()), ("part", pa.int64()), ("text", pa.string())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all documents but the last of a range, the range's first text
    (edge 1) and its last document (edge 2)."""
    from pyspark import TaskContext

    part, before, rows = TaskContext.get().partitionId(), None, []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), map(pa.StringScalar.as_py, batch.column(1)), strict=True):
            now = (doc_id, _Text(text))
            if before is None:
                rows.append((*[None] * 7, 1, part, now[1].text))
            else:
                rows.append((*_row(*before, now[1]), 0, part, None))
            before = now
            if len(rows) >= 500:
                yield _table(rows, _EDGED)
                rows = []
    if before is not None:
        rows.append((before[0], *[None] * 6, 2, part, before[1].text))
    yield _table(rows, _EDGED)


def _last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text, following in zip(*(batch.column(i) for i in range(3)), strict=True):
            yield _table([_row(doc_id.as_py(), _Text(text.as_py()), _Text(following.as_py()))], _RESULT)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, the digest of the edited text, both fingerprints, and
    the likeness of the text to the edited text and to the next text."""
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    # equal rows may go to several ranges: their order does not show
    spread = picked.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(tasks(docs.sparkSession), *order, "row")
    walked = reliable(spread.sortWithinPartitions(*order, "row").select("doc_id", "text").mapInArrow(
        _in_order, _SCHEMA + ", edge int, part long, text string"))
    # one row a range
    ranges = walked.where("edge = 1").select("part", F.col("text").alias("following"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nexts = ranges.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(whole)).alias("next_part"))
    open_rows = (walked.where("edge = 2").select("doc_id", "text", "part").join(nexts, "part").drop("part")
                 .join(ranges.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "following"))
    rows = walked.where("edge = 0").drop("edge", "part", "text").unionByName(open_rows.mapInArrow(_last_rows, _SCHEMA))
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance; a column of the table is two bit strings."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top, up, down, distance = (1 << len(a)) - 1, 1 << len(a) - 1, (1 << len(a)) - 1, 0, len(a)
    for c in b:
        same = where.get(c, 0)
        flat = (((same & up) + up) ^ up) | same | down
        right, left = down | ~(flat | up) & full, up & flat
        distance += bool(right & top) - bool(left & top)
        right, left = right << 1 & full | 1, left << 1 & full
        up, down = left | ~(flat | right) & full, right & flat
    return distance


def band_keys(mark: Fingerprint, bands: int = BANDS, band: int = BAND) -> list[int]:
    """Keys of bands of sampled symbols among the first half of ``SAMPLES`` at
    the fingerprint's level, which every fingerprint above level 0 has; where it
    has so many that a text a little longer has the next level, also at that one."""
    out = []
    for walk, (level, samples) in enumerate(mark):
        for lv in (level, level + 1) if 4 * len(samples) >= 3 * SAMPLES else (level,):
            held = np.zeros(SAMPLES, np.uint8)
            own = _coarser(level, samples, lv)
            held[:len(own)] = own
            for k in range(bands):
                drawn = _hash(np.arange(band), np.full(band, k), np.full(band, lv)) % np.uint64(SAMPLES // 2)
                key = b"%d:%d:%d:" % (walk, lv, k) + held[drawn.astype(np.int64)].tobytes()
                out.append(int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little", signed=True))
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = [fingerprint(x.as_py() or "") for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(map(packed, marks), pa.binary()),
                                          pa.array(map(band_keys, marks), pa.list_(pa.int64()))], ["doc_id", "body", "mark", "keys"])


def _close(least: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = a.as_py() or "", b.as_py() or ""
                keep.append(edit_distance(a, b) <= (1 - least) * max(len(a), len(b)) + 1e-9)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])
    return check


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, alike: float = 0.25) -> DataFrame:
    """doc_id and class_id (the least id of its class) of every row: classes of
    texts whose edit distance is within ``1 - least`` of the longer one's length.

    Equal texts are one node.  Texts that share a band's key are compared with
    the key's least text, so a key that a third of all texts share makes one
    pair a text; the fingerprints' likeness must be ``alike`` before texts are
    fetched and the exact distance decides.  Links can be missed (bands are
    samples), none is wrong.  Rows without an id have class null."""
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    body = F.sha2("text", 256)
    rows = reliable(picked.select("doc_id", "text", body.alias("body")).mapInArrow(_keyed, "doc_id long, body string, mark binary, keys array<long>"))
    nodes = rows.where("doc_id IS NOT NULL").groupBy("body").agg(F.min("doc_id").alias("node"), F.first("mark").alias("mark"), F.first("keys").alias("keys"))
    nodes = reliable(nodes)
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    pairs = keyed.join(heads, "key").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    marks = nodes.select("node", "mark")
    marked = pairs.join(marks.select(F.col("node").alias("a"), F.col("mark").alias("x")), "a").join(marks.select(F.col("node").alias("b"), F.col("mark").alias("y")), "b")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [likeness(parsed(x), parsed(y)) >= alike for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    found = marked.select("a", "b", "x", "y").mapInArrow(likely, "a long, b long")
    texts = picked.join(nodes.select(F.col("node").alias("doc_id"), "body"), "doc_id").where(body == F.col("body")).select(F.col("doc_id").alias("node"), "text").dropDuplicates(["node"])
    whole = (found.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b"))
    links = whole.select("a", "b", "x", "y").mapInArrow(_close(least), "a long, b long")
    classes_of = components(links)
    named = nodes.join(classes_of, "node", "left").select("body", F.coalesce("component", "node").alias("class_id"))
    return rows.join(named, "body", "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))
