"""Weighted acyclic automata over words: counts of word sequences.

A ``Counts`` is the tree of all counted sequences, level by level.  A node of
level d is an arc from its parent, with a word and a weight (how often the
sequence that ends there was counted; 0 where it is only the way to longer
ones).  Level 0 holds the languages.  Nodes stand in the order of their parents
and, below one, of their words.

``pack`` writes the smallest automaton: from the deepest level up, states with
equal outgoing arcs (words, weights and states they lead to) are one state.
``union`` adds automata, ``split`` cuts one by ranges of prefixes, and
``compose`` runs the sequences of one automaton through another for their weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

from .batched import mixed, text_bytes

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass
class Counts:
    langs: list[str]
    words: pa.Array
    #: (parent, word, weight) of the nodes of each level, from level 1 on
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = int(counts.sum())
    return np.arange(total) + np.repeat(starts - np.cumsum(counts) + counts, counts)


def _first_of(parent: np.ndarray, n: int) -> np.ndarray:
    """Where the children of each of ``n`` parents begin, and the end."""
    return np.concatenate([[0], np.cumsum(np.bincount(parent, minlength=n))])


def in_order(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and the place of each given one."""
    order = pc.sort_indices(words).to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    return words.take(pa.array(order)), rank


def build(langs: list[str], words: pa.Array, lang: np.ndarray, word: np.ndarray, left: np.ndarray, longest: int) -> Counts:
    """The counts of all runs of up to ``longest`` words.  Every place has a
    language, a word, and the number of words from it to its piece's end."""
    levels, size = [], max(1, len(words))
    node, places = lang.astype(np.int64), np.arange(len(word))
    for d in range(longest):
        here = left[places] > d
        node, places = node[here], places[here]
        codes, node, weight = np.unique(node * size + word[places + d], return_inverse=True, return_counts=True)
        levels.append((codes // size, codes % size, weight.astype(np.int64)))
    return Counts(langs, words, levels)


def from_phrases(langs: list[str], lang: np.ndarray, phrases: pa.Array) -> tuple[Counts, np.ndarray, np.ndarray]:
    """The automaton of given phrases (words joined by spaces), and the level
    and node of each."""
    lists = pc.split_pattern(phrases.cast(pa.large_string()), " ")
    flat = pc.dictionary_encode(pc.list_flatten(lists))
    words, rank = in_order(flat.dictionary)
    word = rank[flat.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int64)
    length = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    start, size = np.cumsum(length) - length, max(1, len(words))
    node, at, levels = lang.astype(np.int64), np.arange(len(length)), []
    last = np.zeros(len(length), np.int64)
    for d in range(int(length.max(initial=0))):
        here = length[at] > d
        node, at = node[here], at[here]
        codes, node = np.unique(node * size + word[start[at] + d], return_inverse=True)
        levels.append((codes // size, codes % size, np.zeros(len(codes), np.int64)))
        last[at] = node
    return Counts(langs, words, levels), length, last


def prefix_hashes(counts: Counts) -> list[np.ndarray]:
    """A hash of language and first word for level 1, and of language and first
    two words for the others; ``collocations.prefix_range`` is the same for columns."""
    data, offsets = text_bytes(counts.words)
    raw, at = data.tobytes(), offsets.tolist()
    word = np.fromiter((xxhash.xxh64_intdigest(raw[a:b], 42) for a, b in zip(at, at[1:], strict=False)), np.uint64, len(counts.words))
    lang = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in counts.langs], np.uint64)
    out: list[np.ndarray] = []
    for d, (parent, w, _) in enumerate(counts.levels):
        if d == 0:
            out.append(word[w] ^ (lang[parent] << np.uint64(2)))
        elif d == 1:
            out.append(out[0][parent] ^ (word[w] << np.uint64(1)))
        else:
            out.append(out[-1][parent])
    return [h >> np.uint64(1) for h in out]


def split(counts: Counts, ranges: int) -> Iterator[tuple[int, Counts]]:
    """The part of every range of prefixes that has any."""
    owner = [(h % np.uint64(ranges)).astype(np.int64) for h in prefix_hashes(counts)]
    owner[0] = np.where(counts.levels[0][2] > 0, owner[0], -1)
    firsts = [_first_of(counts.levels[d + 1][0], len(counts.levels[d][0])) for d in range(len(counts.levels) - 1)]
    by_owner = [np.argsort(o, kind="stable") for o in owner[:2]]
    cuts = [np.searchsorted(o[b], np.arange(ranges + 1)) for o, b in zip(owner, by_owner, strict=False)]
    for r in range(ranges):
        own = by_owner[0][cuts[0][r]:cuts[0][r + 1]]
        picked = by_owner[1][cuts[1][r]:cuts[1][r + 1]] if len(owner) > 1 else np.zeros(0, np.int64)
        if not len(own) and not len(picked):
            continue
        top = np.union1d(own, counts.levels[1][0][picked]) if len(picked) else own
        parent, word, weight = (x[top] for x in counts.levels[0])
        levels, above = [(parent, word, np.where(owner[0][top] == r, weight, 0))], top
        for d in range(1, len(counts.levels)):
            parent, word, weight = counts.levels[d]
            if d > 1:
                begin = firsts[d - 1][above]
                picked = _ragged(begin, firsts[d - 1][above + 1] - begin)
            levels.append((np.searchsorted(above, parent[picked]), word[picked], weight[picked]))
            above = picked
        used = np.unique(np.concatenate([w for _, w, _ in levels]))
        yield r, Counts(counts.langs, counts.words.take(pa.array(used)), [(p, np.searchsorted(used, w), x) for p, w, x in levels])


def union(parts: list[Counts]) -> Counts:
    """The sum of automata."""
    coded = pc.dictionary_encode(pa.concat_arrays([p.words.cast(pa.large_string()) for p in parts]))
    words, rank = in_order(coded.dictionary)
    place = rank[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
    word_of = np.split(place, np.cumsum([len(p.words) for p in parts])[:-1])
    langs = sorted({x for p in parts for x in p.langs})
    number = {x: i for i, x in enumerate(langs)}
    above = [np.array([number[x] for x in p.langs], np.int64) for p in parts]
    levels, size = [], max(1, len(words))
    for d in range(max(len(p.levels) for p in parts)):
        codes = np.concatenate([above[i][p.levels[d][0]] * size + word_of[i][p.levels[d][1]] for i, p in enumerate(parts)])
        weights = np.concatenate([p.levels[d][2] for p in parts])
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        new = np.append(True, codes[1:] != codes[:-1])[:len(codes)]
        first = np.flatnonzero(new)
        node = np.empty(len(codes), np.int64)
        node[order] = np.cumsum(new) - 1
        levels.append((codes[first] // size, codes[first] % size, np.add.reduceat(weights[order], first) if len(first) else weights))
        above = np.split(node, np.cumsum([len(p.levels[d][0]) for p in parts])[:-1])
    return Counts(langs, words, levels)


def frequent(counts: Counts, least: int) -> Counts:
    """The nodes with a weight of ``least``, and the ways to them."""
    keep = [weight >= least for _, _, weight in counts.levels]
    for d in range(len(keep) - 1, 0, -1):
        keep[d - 1][counts.levels[d][0][keep[d]]] = True
    levels, new = [], None
    for k, (parent, word, weight) in zip(keep, counts.levels, strict=True):
        levels.append((parent[k] if new is None else new[parent[k]], word[k], weight[k]))
        new = np.cumsum(k) - 1
    return Counts(counts.langs, counts.words, levels)


def phrases(counts: Counts) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Language, words joined by spaces, and weight of the nodes of each level."""
    lang = spelled = None
    for parent, word, weight in counts.levels:
        last = counts.words.take(pa.array(word)).cast(pa.large_string())
        if spelled is None:
            lang, spelled = parent, last
        else:
            lang, spelled = lang[parent], pc.binary_join_element_wise(spelled.take(pa.array(parent)), last, pa.scalar(" ", pa.large_string()))
        yield lang, spelled, weight


def compose(asked: Counts, counts: Counts) -> list[np.ndarray]:
    """For the nodes of each level of ``asked``, the weight in ``counts``; 0
    where the way ends."""
    number = {x: i for i, x in enumerate(counts.langs)}
    state = np.array([number.get(x, -1) for x in asked.langs], np.int64)
    word = pc.fill_null(pc.index_in(asked.words.cast(pa.large_string()), value_set=counts.words.cast(pa.large_string())), -1)
    word = word.to_numpy(zero_copy_only=False).astype(np.int64)
    size, out = max(1, len(counts.words)), []
    for d, (parent, symbol, _) in enumerate(asked.levels):
        if d >= len(counts.levels) or not len(counts.levels[d][0]):
            state = np.full(len(parent), -1, np.int64)
            out.append(np.zeros(len(parent), np.int64))
            continue
        arcs = counts.levels[d][0] * size + counts.levels[d][1]
        want = state[parent] * size + word[symbol]
        at = np.minimum(np.searchsorted(arcs, want), len(arcs) - 1)
        found = (arcs[at] == want) & (state[parent] >= 0) & (word[symbol] >= 0)
        state = np.where(found, at, -1)
        out.append(np.where(found, counts.levels[d][2][at], 0))
    return out


def _shared(parent: np.ndarray, word: np.ndarray, weight: np.ndarray, target: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The state of each of ``n`` parents, 0 for those without arcs, and for
    each state from 1 on a parent that has it."""
    first = _first_of(parent, n)
    having = np.flatnonzero(np.diff(first))
    if not len(having):
        return np.zeros(n, np.int64), having
    # arcs of a state have different words, so sums of arc hashes name their set
    arc = word.astype(np.uint64) * _ODD[0] + weight.astype(np.uint64) * _ODD[1] + target.astype(np.uint64) * _ODD[2]
    a = np.add.reduceat(mixed(arc), first[having])
    b = np.add.reduceat(mixed(mixed(arc + _ODD[1]) ^ (word.astype(np.uint64) + (target.astype(np.uint64) << np.uint64(32)))), first[having])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    state = np.zeros(n, np.int64)
    state[having[order]] = np.cumsum(new)
    return state, having[order[new]]


def pack(counts: Counts) -> bytes:
    """The automaton with equal states shared, as bytes."""
    target = np.zeros(len(counts.levels[-1][0]), np.int64)
    arrays: list[np.ndarray] = []
    for d in range(len(counts.levels) - 1, 0, -1):
        parent, word, weight = counts.levels[d]
        n = len(counts.levels[d - 1][0])
        state, shown = _shared(parent, word, weight, target, n)
        first = _first_of(parent, n)
        many = first[shown + 1] - first[shown]
        arcs = _ragged(first[shown], many)
        arrays[:0] = [many, word[arcs], weight[arcs], target[arcs]]
        target = state
    parent, word, weight = counts.levels[0]
    data, offsets = text_bytes(counts.words)
    arrays[:0] = [np.frombuffer("\0".join(x.encode().hex() for x in counts.langs).encode(), np.uint8), np.diff(offsets), data, parent, word, weight, target]
    small = [np.ascontiguousarray(a, next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if not len(a) or a.max() <= np.iinfo(t).max)) for a in arrays]
    head = np.array([len(small), *(x for a in small for x in (a.itemsize, len(a)))], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *(a.tobytes() for a in small)]))


def unpack(raw: bytes) -> Counts:
    """All sequences of a packed automaton."""
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    arrays, at = [], 8 + 16 * n
    for size, length in zip(head[0::2].tolist(), head[1::2].tolist(), strict=True):
        arrays.append(np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[size], length, at))
        at += size * length
    names, lengths, data, parent, word, weight, target = arrays[:7]
    offsets = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    words = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    levels = [tuple(x.astype(np.int64) for x in (parent, word, weight))]
    for i in range(7, n, 4):
        many, words_of, weights, targets = (x.astype(np.int64) for x in arrays[i:i + 4])
        first, state = np.concatenate([[0, 0], np.cumsum(many)]), target.astype(np.int64)  # state 0 has no arcs
        count = np.concatenate([[0], many])[state]
        arcs = _ragged(first[state], count)
        levels.append((np.repeat(np.arange(len(state)), count), words_of[arcs], weights[arcs]))
        target = targets[arcs]
    langs = [bytes.fromhex(x).decode() for x in names.tobytes().decode().split("\0")]
    return Counts(langs, words, levels)
