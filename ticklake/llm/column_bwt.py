"""The Burrows-Wheeler transform and common prefixes of a collection, built
column-wise: every round inserts one symbol of each string.

Round j knows the transform of all suffixes shorter than j, in sorted order, as
one symbol (the one before the suffix) a place, and the length of the common
prefix with the suffix before it.  Each string's next symbol, from its end to
its front, is written at the place of its last suffix; the place of the suffix
that starts with it follows from counting (smaller symbols in all, equal ones
before it).  Its common prefix with either neighbour is one more than the least
common prefix between the two places that their symbols stood at.  All suffixes
of a round are then merged in by one sequential pass over both files.

The files are arrays here, as a collection is bounded by its caller.
"""

from __future__ import annotations

import numpy as np

_BYTES = np.dtype([("bwt", np.uint8), ("lcp", np.uint8)])


def column_bwt(columns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transform and common prefixes of N strings.

    ``columns[i, j]`` is the j-th symbol from the end of string i, from 1 on;
    ``lengths`` are at most 255.  The symbol 0 stands where a string begins.
    The first N places are the empty suffixes, in the order of the strings."""
    n = len(lengths)
    # both files as one of two bytes a place, so that a round copies them together
    both = np.zeros(n, np.uint16)
    at, who = np.arange(n), np.arange(n)
    for j in range(int(lengths.max(initial=0))):
        alive = lengths[who] > j
        at, who = at[alive], who[alive]
        symbol = columns[who, j]
        bwt, lcp = both.view(_BYTES)["bwt"], both.view(_BYTES)["lcp"]
        bwt[at] = symbol
        order = np.argsort(np.ascontiguousarray(bwt), kind="stable")  # counting: all places by symbol, then by place
        none = len(both) - int(np.count_nonzero(bwt))
        # ``at`` ascends, so its places come in the order of their symbols
        written = np.zeros(len(both), bool)
        written[at] = True
        r = np.empty(len(at), np.int64)
        r[np.argsort(symbol, kind="stable")] = np.flatnonzero(written[order])
        # the neighbours with the same symbol, and the least common prefix on the way to them
        before = order[r - 1]
        has_before = (r > none) & (bwt[before] == symbol)
        after = order[np.minimum(r + 1, len(order) - 1)]
        has_after = (r + 1 < len(order)) & (bwt[after] == symbol)
        padded = np.append(lcp, np.uint8(0))
        ranges = np.empty(2 * len(at), np.int64)
        ranges[0::2], ranges[1::2] = np.where(has_before, before + 1, at), at + 1
        left = np.minimum.reduceat(padded, ranges)[0::2] if len(at) else np.zeros(0, np.uint8)
        ranges[0::2], ranges[1::2] = np.where(has_after, at + 1, at), np.where(has_after, after, at) + 1
        right = np.minimum.reduceat(padded, ranges)[0::2] if len(at) else np.zeros(0, np.uint8)
        new = r - none + n
        old = np.ones(len(both) + len(at), bool)
        old[new] = False
        merged = np.zeros(len(old), np.uint16)
        merged[old] = both
        prefixes = merged.view(_BYTES)["lcp"]
        prefixes[new] = np.where(has_before, left + 1, 0)
        nxt = new[has_after] + 1
        prefixes[nxt] = right[has_after] + 1
        both = merged
        by_place = np.argsort(new)
        at, who = new[by_place], who[by_place]
    return np.ascontiguousarray(both.view(_BYTES)["bwt"]), np.ascontiguousarray(both.view(_BYTES)["lcp"])


def places(bwt: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``places[i, j]``: where the suffix of length j + 1 of string i stands."""
    n = len(lengths)
    order = np.argsort(bwt, kind="stable")
    none = len(bwt) - int(np.count_nonzero(bwt))
    step = np.empty(len(bwt), np.int64)
    step[order] = np.arange(len(bwt)) - none + n
    out = np.full((n, int(lengths.max(initial=0))), -1, np.int64)
    at, who = np.arange(n), np.arange(n)
    for j in range(out.shape[1]):
        alive = lengths[who] > j
        who, at = who[alive], step[at[alive]]
        out[who, j] = at
    return out


def least_owner(strings: np.ndarray, lengths: np.ndarray, owners: np.ndarray, window: int) -> np.ndarray:
    """For each start in each string (rows of bytes), the least owner of a string
    that holds the same ``window`` bytes anywhere; the largest integer where the
    window does not fit."""
    n, width = strings.shape
    none = np.iinfo(np.int64).max
    out = np.full((n, max(0, width - window + 1)), none, np.int64)
    if not n:
        return out
    back = lengths[:, None] - 1 - np.arange(width)[None, :]
    columns = np.take_along_axis(strings, np.maximum(back, 0), axis=1)
    used = np.zeros(256, bool)
    used[columns[back >= 0]] = True
    columns = (np.cumsum(used).astype(np.int64)[columns]).astype(np.uint8)  # at most 255 different bytes in UTF-8
    bwt, lcp = column_bwt(columns, lengths)
    place = places(bwt, lengths)[:, window - 1:]
    fits = place >= 0
    starts = np.flatnonzero(lcp < window)  # suffixes from one start to the next share the window
    group = np.cumsum(lcp < window) - 1
    owner = np.full(len(bwt), none, np.int64)
    owner[place[fits]] = np.broadcast_to(owners[:, None], place.shape)[fits]
    least = np.minimum.reduceat(owner, starts)
    who, j = np.nonzero(fits)
    out[who, lengths[who] - window - j] = least[group[place[fits]]]
    return out
