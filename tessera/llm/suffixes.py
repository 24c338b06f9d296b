"""Suffix arrays of many short texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_HEAD = 7
#: Positions that one comparison is carried along.
CHAIN = 32


def suffix_array(text: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(order, rank)`` of all suffixes, right for the first ``depth`` bytes at least.

    ``text`` holds bytes, ``ends[i]`` is where the text of position ``i`` ends; no suffix reaches beyond that, and
    an ended suffix sorts first. Larsson and Sadakane's refinement: groups of suffixes equal in their first h bytes
    are sorted by the rank of the suffix h further on, which doubles h; a group of one is never touched again, nor
    are suffixes that have ended. Equal suffixes keep one rank.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(n)
    key = np.zeros(n, np.uint64)
    byte = text.astype(np.uint64) + np.uint64(1)
    for k in range(_HEAD):
        shifted = np.zeros(n, np.uint64)
        shifted[: n - k] = byte[k:]
        shifted[place + k >= ends] = 0
        key = (key << np.uint64(9)) | shifted
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    rank = np.empty(n, np.int64)
    fresh = np.empty(n, bool)
    fresh[0] = True
    fresh[1:] = sorted_key[1:] != sorted_key[:-1]
    first = np.flatnonzero(fresh)
    rank[order] = np.repeat(first, np.diff(np.append(first, n))) + 1
    slots = np.arange(n)
    h = _HEAD
    while True:
        # Slots of groups that hold several suffixes, without those that have ended.
        group = np.cumsum(fresh) - 1
        sizes = np.bincount(group)
        live = (sizes[group] > 1) & (order[slots] + h < ends[order[slots]]) if len(slots) else np.zeros(0, bool)
        # All of a group, the ended ones too, while any is live: they sort before the others.
        keep = np.zeros(len(sizes), bool)
        keep[group[live]] = True
        slots = slots[keep[group]]
        if h >= depth or not len(slots):
            return order, rank
        own = order[slots]
        ahead = np.minimum(own + h, n - 1)
        later = np.where(own + h < ends[own], rank[ahead], 0)
        both = (rank[own] << 32) | later
        turn = np.argsort(both, kind="stable")
        order[slots] = own[turn]
        both = both[turn]
        fresh = np.empty(len(slots), bool)
        fresh[0] = True
        fresh[1:] = both[1:] != both[:-1]
        first = np.flatnonzero(fresh)
        rank[order[slots]] = np.repeat(slots[first], np.diff(np.append(first, len(slots)))) + 1
        h *= 2


def common_prefixes(text: np.ndarray, ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, order: np.ndarray, rank: np.ndarray, depth: int) -> np.ndarray:
    """For each position from ``starts[j]`` to before ``stops[j]``, the length of the prefix, up to ``depth``, that it
    shares with the suffix before it in ``order``; -1 elsewhere.

    Kasai's method: along a text the shared length falls by one at most from one position to the next, so each
    comparison resumes where the last one stopped. Stretches of CHAIN positions step together, whatever text they are
    in, and compare eight bytes at a time; only the first of a stretch starts from nothing. Suffixes of one rank are
    equal as far as they were sorted, in an order that says nothing of those one position on, so the position after
    one of them starts from nothing too.
    """
    n = len(text)
    out = np.full(n, -1, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    wide = np.zeros(n + 8, np.uint8)
    wide[:n] = text
    eight = np.lib.stride_tricks.as_strided(wide, (n + 1, 8), (1, 1))
    eight = np.ascontiguousarray(eight[:n]).view(np.uint64).ravel()
    chains = np.maximum(-(-(stops - starts) // CHAIN), 0)
    starts = np.repeat(starts, chains) + CHAIN * (np.arange(chains.sum()) - np.repeat(np.cumsum(chains) - chains, chains))
    stops = np.minimum(starts + CHAIN, np.repeat(stops, chains))
    shared = np.zeros(len(starts), np.int64)
    at = starts.copy()
    rows = np.flatnonzero(at < stops)
    while len(rows):
        here = at[rows]
        other = before[here]
        tied = (other >= 0) & (rank[here] == rank[other])
        room = np.minimum(np.minimum(ends[here] - here, np.where(other >= 0, ends[other] - other, 0)), depth)
        got = np.where(tied, room, np.minimum(np.maximum(shared[rows] - 1, 0), room))
        run = np.flatnonzero(got + 8 <= room)
        while len(run):
            same = eight[here[run] + got[run]] == eight[other[run] + got[run]]
            run = run[same]
            got[run] += 8
            run = run[got[run] + 8 <= room[run]]
        run = np.flatnonzero(got < room)
        while len(run):
            same = wide[here[run] + got[run]] == wide[other[run] + got[run]]
            run = run[same]
            got[run] += 1
            run = run[got[run] < room[run]]
        out[here] = got
        shared[rows] = np.where(tied, 0, got)
        at[rows] += 1
        rows = rows[at[rows] < stops[rows]]
    return out
