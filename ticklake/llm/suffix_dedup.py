"""Suffix-array dedup: remove bytes that stand in an earlier document too.

A byte goes if a string of ``window`` bytes covers it that also starts in a
document with a smaller id.  Equal strings are found by the sorted order of all
suffixes of a collection, built column-wise (see ``column_bwt``): suffixes with
a common prefix of ``window`` bytes or more stand together.

One symbol of each document a round would take as many rounds as the longest
document has bytes, and the files would hold every suffix of the corpus.  So the
collection is cut, losing no string: every window belongs to its minimizer, the
least hash of the ``gram`` byte strings in it, and equal windows have equal
minimizers.  Consecutive windows with one minimizer form a block of at most
``window - gram + 1`` windows, so no string has more than
``2 * window - gram`` bytes and a collection takes so many rounds at most.  A
collection holds the blocks of some minimizers:

1. each batch of documents sends its distinct minimizers to their buckets, which
   answer which of them stand in two documents; others cannot repeat;
2. the batch sends the distinct blocks of these, each with its least document
   id, to the same buckets.  A bucket cuts blocks that share a minimizer again,
   by minimizers of longer strings, since the more documents there are the more
   blocks meet by a short common phrase and have no window in common.  It builds
   the transform and common prefixes of those that still meet, some minimizers at
   a time, and answers for every block the least document that holds each window;
3. the batch marks the windows that an earlier document holds.

A batch sends a block once, however many of its documents hold it, so a passage
that a third of all documents share is one row a batch.  A minimizer that is in
two documents but has one distinct block needs no comparison.  A minimizer with
more than ``hot`` different blocks (a common phrase in many contexts) would make
one large collection: its windows are sent one by one instead, each by its own
hash, so they spread over all buckets.

Defined results: null and empty texts have no bytes.  Rows without an id lose
nothing and take nothing from others.  Rows with the same id do not count as
earlier than each other.  Repeated rows are kept.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .batched import BYTE_CODE, deal, ids, mixed, ordered, text_bytes
from .column_bwt import least_owner

WINDOW, GRAM = 50, 16
#: strings in a collection, about
COLLECTION = 20_000
#: blocks of a minimizer above which its windows go by their own hashes
HOT = 65_536
_PIECE = 1 << 19
#: blocks that are cut again together, about
_AT_ONCE = 65_536
_STEP = 0x9E3779B97F4A7C55
_NONE = np.iinfo(np.int64).max


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on, by doubling."""
    parts, size, step = BYTE_CODE[data], 1, _STEP
    total, done = None, 0
    left = gram
    while left:
        if left & 1:
            if total is None:
                total, done = parts.copy(), size
            else:
                n = len(data) - done - size + 1
                total = total[:n] * np.uint64(pow(_STEP, size, 1 << 64)) + parts[done:done + n]
                done += size
        left >>= 1
        if left:
            n = len(parts) - size
            parts = parts[:n] * np.uint64(step) + parts[size:size + n]
            step = step * step % (1 << 64)
            size *= 2
    return mixed(total)


def _least_in(values: np.ndarray, n: int) -> np.ndarray:
    """The least of ``n`` values from each place on."""
    size = 1
    while 2 * size <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (n - size)], values[n - size:]) if size < n else values


def blocks(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows, minimizer and a hash of the ends of every block."""
    most = window - gram + 1
    starts, counts, keys, ends_hash = [], [], [], []
    for lo in range(0, max(0, len(data) - window + 1), _PIECE):
        hi = min(lo + _PIECE, len(data) - window + 1)  # windows lo..hi
        grams = _gram_hashes(data[lo:hi + window - 1], gram)
        least = _least_in(grams, most)
        # numbers count from lo here
        at = np.arange(hi - lo, dtype=np.int32)
        one, two = int(np.searchsorted(offsets, lo, "right")) - 1, int(np.searchsorted(offsets, hi - 1, "right"))
        edges = np.minimum(offsets[one + 1:two + 1], hi) - lo  # where the texts of this piece end in it
        whole = at <= np.repeat((offsets[one + 1:two + 1] - lo - window).astype(np.int32), np.diff(edges, prepend=0))
        new = np.ones(hi - lo, bool)
        new[1:] = least[1:] != least[:-1]
        new[edges[edges < hi - lo]] = True
        # a run of one minimizer is cut where it is too long for a block
        run = np.flatnonzero(new)
        many = -(-np.diff(run, append=hi - lo) // most)
        first = np.repeat(run, many) + most * _ragged(np.zeros(len(run), np.int64), many)
        first = first[whole[first]]
        # windows across a text's end close the block before them
        ends = np.append(np.flatnonzero(~whole), hi - lo)
        stop = np.minimum(np.append(first[1:], hi - lo), ends[np.searchsorted(ends, first)])
        starts.append(first + lo)
        counts.append(stop - first)
        keys.append(least[first])
        ends_hash.append(grams[first] + np.uint64(3) * grams[stop + window - gram - 1])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(keys), np.concatenate(ends_hash)


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then the next."""
    total = int(counts.sum())
    return np.arange(total) + np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) if total else np.zeros(0, np.int64)


def _rows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The strings as rows of bytes, filled with zeros."""
    out = np.zeros((len(starts), width), np.uint8)
    for lo in range(0, len(starts), 65_536):
        cut = slice(lo, lo + 65_536)
        at = starts[cut, None] + np.arange(width)[None, :]
        inside = np.arange(width)[None, :] < lengths[cut, None]
        out[cut] = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
    return out


def _row_hashes(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """128-bit hashes of rows, as two columns."""
    words = -(-rows.shape[1] // 8)
    padded = np.zeros((len(rows), words * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    words64 = padded.view(np.uint64)
    a = mixed(lengths.astype(np.uint64) + np.uint64(1))
    b = mixed(lengths.astype(np.uint64) + np.uint64(77))
    for k in range(words):
        a = mixed(a ^ words64[:, k])
        b = mixed(b + words64[:, k] * np.uint64(_STEP))
    return np.stack([a, b], axis=1)


def _coded(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Keys: the bucket, then 32 bits of the hash."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (hashes & np.uint64(0xFFFFFFFF))


class _Batch:
    def __init__(self, docs: pa.Table, window: int, gram: int, buckets: int):
        docs = ordered(docs)
        self.docs, self.window, self.buckets = docs, window, buckets
        self.data, self.offsets = text_bytes(docs.column("text"))
        self.doc_ids, self.known = ids(docs.column("doc_id"), _NONE)
        self.starts, self.counts, minimizers, self.ends_hash = blocks(self.data, self.offsets, window, gram)
        self.doc = np.searchsorted(self.offsets, self.starts, "right") - 1
        self.coded = _coded(minimizers, buckets)
        self.keys, self.key = np.unique(self.coded, return_inverse=True)

    def _split(self, coded: np.ndarray) -> tuple[np.ndarray, list[slice]]:
        bucket = (coded >> np.uint64(32)).astype(np.int64)
        found, at = np.unique(bucket, return_index=True)
        if not len(found):
            return found, []
        return found, [slice(a, b) for a, b in zip(at.tolist(), np.append(at[1:], len(bucket)).tolist(), strict=True)]

    def minimizer_messages(self, batch: int) -> pa.Table:
        owner = self.doc_ids[self.doc]
        least, most = np.full(len(self.keys), _NONE), np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(least, self.key, owner)
        np.maximum.at(most, self.key, owner)
        several = (least < most).astype(np.uint8)
        order = np.lexsort((self.counts, self.ends_hash, self.key))  # about how many different blocks a key has
        k, e, c = self.key[order], self.ends_hash[order], self.counts[order]
        new = np.append(True, (k[1:] != k[:-1]) | (e[1:] != e[:-1]) | (c[1:] != c[:-1]))[: len(k)]
        contexts = np.minimum(np.bincount(k[new], minlength=len(self.keys)), 65535).astype(np.uint16)
        found, parts = self._split(self.keys)
        low = self.keys.astype(np.uint32)
        return pa.table({"batch": pa.array([batch] * len(found), pa.int64()), "bucket": pa.array(found, pa.int64()),
                         "keys": pa.array([low[p].tobytes() for p in parts], pa.binary()),
                         "several": pa.array([np.packbits(several[p]).tobytes() for p in parts], pa.binary()),
                         "contexts": pa.array([contexts[p].tobytes() for p in parts], pa.binary())})

    def repeated(self, answers: pa.Table) -> None:
        """Keep the blocks whose minimizers stand in two documents; the distinct
        ones in order of bucket, minimizer and content."""
        by_bucket = dict(zip(answers.column("bucket").to_pylist(), answers.column("packed").to_pylist(), strict=True))
        found, parts = self._split(self.keys)
        keeps, hots = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        for b, p in zip(found.tolist(), parts, strict=True):
            bits, n = np.frombuffer(by_bucket[b], np.uint8), p.stop - p.start
            keeps[p], hots[p] = np.unpackbits(bits[:len(bits) // 2], count=n), np.unpackbits(bits[len(bits) // 2:], count=n)
        keep, hot = keeps[self.key] & ~hots[self.key], keeps[self.key] & hots[self.key]
        single = _ragged(self.starts[hot], self.counts[hot])  # every window a block of its own, by its hash
        single_doc = np.repeat(self.doc[hot], self.counts[hot])
        own = np.zeros(0, np.uint64)
        if len(single):
            own = np.concatenate([_row_hashes(_rows(self.data, single[i:i + 65_536], np.full(len(single[i:i + 65_536]), self.window), self.window),
                                              np.full(len(single[i:i + 65_536]), self.window))[:, 0] for i in range(0, len(single), 65_536)])
        self.starts, self.doc = np.concatenate([self.starts[keep], single]), np.concatenate([self.doc[keep], single_doc])
        self.counts = np.concatenate([self.counts[keep], np.ones(len(single), np.int64)])
        self.coded = np.concatenate([self.coded[keep], _coded(own, self.buckets)])
        self.lengths = self.counts + self.window - 1
        width = int(self.lengths.max(initial=self.window))
        rows = _rows(self.data, self.starts, self.lengths, width) if len(self.starts) else np.zeros((0, width), np.uint8)
        hashes = _row_hashes(rows, self.lengths)
        order = np.lexsort((hashes[:, 1], hashes[:, 0], self.coded))
        h, c = hashes[order], self.coded[order]
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]).any(axis=1) | (c[1:] != c[:-1])
        first = np.flatnonzero(new)
        #: the distinct block of every block
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        picked = order[first]
        self.block_rows, self.block_lengths, self.block_keys = rows[picked], self.lengths[picked], self.coded[picked]
        owner = self.doc_ids[self.doc][order]
        self.block_owner = np.minimum.reduceat(owner, first) if len(first) else owner

    def block_messages(self, batch: int) -> pa.Table:
        found, parts = self._split(self.block_keys)
        pack = zstandard.ZstdCompressor(level=1)
        messages = []
        for p in parts:
            n = p.stop - p.start
            lengths = self.block_lengths[p]
            inside = np.arange(self.block_rows.shape[1])[None, :] < lengths[:, None]
            messages.append(pack.compress(b"".join([
                np.int64(n).tobytes(), self.block_keys[p].astype(np.uint32).tobytes(), self.block_owner[p].astype(np.int64).tobytes(),
                lengths.astype(np.uint8).tobytes(), self.block_rows[p][inside].tobytes()])))
        return pa.table({"batch": pa.array([batch] * len(found), pa.int64()), "bucket": pa.array(found, pa.int64()), "packed": pa.array(messages, pa.binary())})

    def covered(self, answers: pa.Table) -> np.ndarray:
        """The bytes to remove."""
        unpack = zstandard.ZstdDecompressor()
        runs, froms, owners = [], [], []
        for raw in answers.sort_by("bucket").column("packed").to_pylist():
            raw = unpack.decompress(raw)
            n, m = np.frombuffer(raw, np.int64, 2)
            runs.append(np.frombuffer(raw, np.uint8, n, 16))
            froms.append(np.frombuffer(raw, np.uint8, m, 16 + n))
            owners.append(np.frombuffer(raw, np.int64, m, 16 + n + m))
        change = np.zeros(len(self.data) + 1, np.int32)
        if runs and len(self.starts):
            runs, froms, owners = (np.concatenate(x).astype(np.int64) for x in (runs, froms, owners))
            run_at = np.concatenate([[0], np.cumsum(runs)])
            # a run ends where the next one of the block begins, or with the block
            ends = np.append(froms[1:], 0)
            ends[run_at[1:] - 1] = self.block_lengths - self.window + 1
            per = runs[self.which]
            run = _ragged(run_at[self.which], per)
            doc = np.repeat(self.doc, per)
            earlier = (owners[run] < self.doc_ids[doc]) & self.known[doc]
            run, start = run[earlier], np.repeat(self.starts, per)[earlier]
            np.add.at(change, start + froms[run], 1)
            np.add.at(change, start + ends[run] + self.window - 1, -1)
        return np.cumsum(change[:-1]) > 0


def _repeated_minimizers(messages: pa.Table, hot: int) -> pa.Table:
    """In a bucket, for every batch: which keys stand in two documents, and
    which of them have more than ``hot`` blocks."""
    raw, flags = messages.column("keys").to_pylist(), messages.column("several").to_pylist()
    keys = np.concatenate([np.frombuffer(x, np.uint32) for x in raw])
    several = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=len(x) // 4) for x, f in zip(raw, flags, strict=True)])
    _, where, held = np.unique(keys, return_inverse=True, return_counts=True)
    # a key of two batches is in two documents, as documents are dealt by id; ids that are null count as one here
    yes = ((held > 1) | (np.bincount(where, several) > 0))[where]
    contexts = np.concatenate([np.frombuffer(x, np.uint16) for x in messages.column("contexts").to_pylist()])
    many = (np.bincount(where, contexts) > hot)[where]
    ends = np.cumsum([len(x) // 4 for x in raw])[:-1]
    return pa.table({"batch": messages.column("batch"), "bucket": messages.column("bucket"),
                     "packed": pa.array([np.packbits(x).tobytes() + np.packbits(y).tobytes() for x, y in zip(np.split(yes, ends), np.split(many, ends), strict=True)], pa.binary())})


def _distinct(rows_of, count: int, keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings in order of key and content; where the distinct ones begin in this
    order; and the number of its distinct string for every string.  ``rows_of``
    gives the rows of bytes of a slice."""
    hashes = np.concatenate([_row_hashes(rows_of(cut), lengths[cut]) for cut in (slice(i, i + 65_536) for i in range(0, count, 65_536))])
    order = np.lexsort((hashes[:, 1], hashes[:, 0], keys))
    h, k = hashes[order], keys[order]
    new = np.ones(count, bool)
    new[1:] = (h[1:] != h[:-1]).any(axis=1) | (k[1:] != k[:-1])
    which = np.empty(count, np.int64)
    which[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), which


def _least_in_blocks(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray, window: int, finer: int,
                     collection: int, wide: int) -> np.ndarray:
    """For each window of each block the least document that holds it.  The
    blocks are cut again, by minimizers of ``finer`` bytes: what meets by
    a short common phrase does not meet there, and its windows are its own.  The
    others go to the transform, whole minimizers and about ``collection`` strings
    at a time."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    text = data[_ragged(starts, lengths)]
    at, count, keys, _ = blocks(text, offsets, window, finer)
    block = np.searchsorted(offsets, at, "right") - 1
    size = count + window - 1
    width = int(size.max())
    order, first, which = _distinct(lambda cut: _rows(text, at[cut], size[cut], width), len(at), keys, size)
    picked = order[first]
    owner, length, key = np.minimum.reduceat(owners[block[order]], first), size[picked], keys[picked]
    same = key[1:] == key[:-1]
    todo = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))
    found = np.where(np.arange(width - window + 1)[None, :] < (length - window + 1)[:, None], owner[:, None], _NONE)
    cuts = [0]
    while cuts[-1] < len(todo):
        end = min(cuts[-1] + collection, len(todo))
        cuts.append(end if end == len(todo) else int(np.searchsorted(key[todo], key[todo[end - 1]], "right")))
    for a, b in zip(cuts, cuts[1:], strict=False):
        chosen = todo[a:b]
        rows = _rows(text, at[picked[chosen]], length[chosen], int(length[chosen].max()))
        some = least_owner(rows, length[chosen], owner[chosen], window)
        found[chosen, :some.shape[1]] = some
    least = np.full((len(lengths), wide), _NONE)
    window_at = _ragged(np.zeros(len(at), np.int64), count)
    mine = np.repeat(np.arange(len(at)), count)
    least[block[mine], (at - offsets[block])[mine] + window_at] = found[which[mine], window_at]
    return least


def _least_documents(messages: pa.Table, window: int, finer: int, collection: int) -> pa.Table:
    """In a bucket: for each block of each batch, runs of windows and the least
    document that holds them."""
    unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    keys, owners, lengths, contents, sizes = [], [], [], [], []
    for raw in messages.column("packed").to_pylist():
        raw = unpack.decompress(raw)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        keys.append(np.frombuffer(raw, np.uint32, n, 8))
        owners.append(np.frombuffer(raw, np.int64, n, 8 + 4 * n))
        lengths.append(np.frombuffer(raw, np.uint8, n, 8 + 12 * n))
        contents.append(np.frombuffer(raw, np.uint8, -1, 8 + 13 * n))
        sizes.append(n)
    keys, owners, lengths, data = np.concatenate(keys), np.concatenate(owners), np.concatenate(lengths).astype(np.int64), np.concatenate(contents)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    width = int(lengths.max())
    order, first, which = _distinct(lambda cut: _rows(data, starts[cut], lengths[cut], width), len(keys), keys, lengths)
    picked = order[first]
    owner, length, key = np.minimum.reduceat(owners[order], first), lengths[picked], keys[picked]
    # blocks that share their minimizer with no other have their own least document throughout
    same = key[1:] == key[:-1]
    todo = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))
    wide = width - window + 1
    least = np.where(np.arange(wide)[None, :] < (length - window + 1)[:, None], owner[:, None], _NONE)
    for a in range(0, len(todo), _AT_ONCE):
        # windows of other blocks that are equal have the same minimizer, so whole minimizers stay together
        a, b = (0 if not x else int(np.searchsorted(key[todo], key[todo[x - 1]], "right")) for x in (a, min(a + _AT_ONCE, len(todo))))
        chosen = todo[a:b]
        if len(chosen):
            least[chosen] = _least_in_blocks(data, starts[picked[chosen]], length[chosen], owner[chosen], window, finer, collection, wide)
    valid = least < _NONE
    valid |= np.arange(wide)[None, :] < (length - window + 1)[:, None]
    begins = valid.copy()
    begins[:, 1:] &= least[:, 1:] != least[:, :-1]
    runs = begins.sum(axis=1)
    _, froms = np.nonzero(begins)
    values = least[begins]
    run_at = np.concatenate([[0], np.cumsum(runs)])
    out = []
    for part in np.split(which, np.cumsum(sizes)[:-1]):
        take = _ragged(run_at[part], runs[part])
        out.append(pack.compress(b"".join([np.int64(len(part)).tobytes(), np.int64(len(take)).tobytes(), runs[part].astype(np.uint8).tobytes(),
                                           froms[take].astype(np.uint8).tobytes(), values[take].tobytes()])))
    return pa.table({"batch": messages.column("batch"), "bucket": messages.column("bucket"), "packed": pa.array(out, pa.binary())})


def _document_rows(batch: _Batch, covered: np.ndarray, carried: list[str]) -> pa.Table:
    rows = []
    for i, (lo, hi) in enumerate(zip(batch.offsets[:-1].tolist(), batch.offsets[1:].tolist(), strict=True)):
        gone, raw = covered[lo:hi], batch.data[lo:hi]
        spans = int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1]))
        row = [hi - lo, int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest()]
        if carried:
            row.append(_whole_characters(raw, gone) if spans else batch.docs.column("text")[i].as_py())
        rows.append(row)
    columns = list(zip(*rows, strict=True)) if rows else [()] * (4 + bool(carried))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    out = {"doc_id": batch.docs.column("doc_id")} | {n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=False)}
    return pa.table(out | {c: batch.docs.column(c) for c in carried})


def _whole_characters(raw: np.ndarray, gone: np.ndarray) -> str:
    """What remains as text: a character goes only if all its bytes go."""
    first = np.flatnonzero((raw & 0xC0) != 0x80)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    all_gone = np.logical_and.reduceat(gone, first)
    return raw[~all_gone[char]].tobytes().decode()


def _buckets(batches: int) -> int:
    """A bucket for four batches, as every batch sends every bucket a message
    and a small message costs more than its bytes; few batches get one each, so
    that there is work for many tasks."""
    return max(min(batches, 64), -(-batches // 4))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                   collection: int = COLLECTION, hot: int = HOT, carry: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; with
    ``carry`` (new name: column) also ``kept_text`` and those columns."""
    carried = dict(carry or {})
    dealt, batches = deal(docs, id_col, text_col, carry=carried)
    buckets = _buckets(batches)

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        return _Batch(table, window, gram, buckets).minimizer_messages(key[0].as_py())

    def count(table: pa.Table) -> pa.Table:
        return _repeated_minimizers(table, hot)

    def send(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        batch = _Batch(table, window, gram, buckets)
        batch.repeated(answers)
        return batch.block_messages(key[0].as_py())

    def compare(table: pa.Table) -> pa.Table:
        return _least_documents(table, window, (window + gram) // 2, collection)

    def mark(table: pa.Table, answers: pa.Table) -> pa.Table:
        batch = _Batch(table, window, gram, buckets)
        kinds = answers.column("kind").to_numpy(zero_copy_only=False)
        batch.repeated(answers.filter(pa.array(kinds == 1)))
        return _document_rows(batch, batch.covered(answers.filter(pa.array(kinds == 2))), list(carried))

    packed = "batch long, bucket long, packed binary"
    by_batch = dealt.groupBy("batch")
    asked = by_batch.applyInArrow(ask, "batch long, bucket long, keys binary, several binary, contexts binary")
    repeated = asked.groupBy("bucket").applyInArrow(count, packed)
    sent = by_batch.cogroup(repeated.groupBy("batch")).applyInArrow(send, packed)
    least = sent.groupBy("bucket").applyInArrow(compare, packed)
    answers = repeated.selectExpr("*", "1 AS kind").unionByName(least.selectExpr("*", "2 AS kind"))
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + "".join(
        f", {c} {kind}" for c, kind in (("kept_text", "string"), *((c, docs.schema[old].dataType.simpleString()) for c, old in carried.items())) if carried)
    return by_batch.cogroup(answers.groupBy("batch")).applyInArrow(mark, ddl)


SQL = """
WITH bytes AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
), places AS (
  SELECT r, doc_id, unnest(range(1, octet_length(b) + 1)) AS p FROM bytes
), windows AS (
  SELECT r, doc_id, i, hex(b[i:i + 49]) AS s FROM (SELECT r, doc_id, b, unnest(range(1, octet_length(b) - 48)) AS i FROM bytes WHERE octet_length(b) >= 50)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS least FROM windows) WHERE least < doc_id
), marked AS (
  SELECT places.r, p, max(i) OVER (PARTITION BY places.r ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM places LEFT JOIN repeated ON repeated.r = places.r AND repeated.i = p
), edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY p), false) AS begins FROM marked
), sums AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
         string_agg(hex(b[p:p]), '' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM edges JOIN bytes USING (r) GROUP BY r
)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM bytes LEFT JOIN sums USING (r)
"""
