"""Suffix arrays by induced sorting, bucket by bucket, and common prefixes in text order, for one shard in memory.

Suffixes are classified as rising (S) or falling (L); the leftmost rising ones (LMS) are sorted by naming their
substrings and sorting the shortened string of names (in the same way, or by doubling if there are many names), and all
others are induced from them: falling ones in a pass over the buckets from the left, rising ones in a pass from the
right. Within a bucket the steps are array operations; a run of equal symbols is laid out at once, however long it is.
"""

from __future__ import annotations

import numpy as np

# Strings over larger alphabets have too many buckets to visit one at a time; they are sorted by doubling.
ALPHABET = 1024


def _classes(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position whether its suffix rises, and where its run of equal symbols begins."""
    n = len(s)
    rises = np.zeros(n, bool)
    rises[:-1] = s[:-1] < s[1:]
    begins = np.append(True, s[1:] != s[:-1])
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, n))
    return np.repeat(rises[starts + lengths - 1], lengths), np.repeat(starts.astype(np.int32), lengths)


def _laid_out(seeds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The seeds, then their left neighbours inside the runs of equal symbols, then the neighbours of those."""
    inside = seeds - first[seeds]
    if not inside.any():
        return seeds
    turn = np.arange(int(inside.sum()) + len(seeds)) - np.repeat(np.cumsum(inside + 1) - inside - 1, inside + 1)
    return (np.repeat(seeds, inside + 1) - turn.astype(np.int32))[np.argsort(turn, kind="stable")]


def _induced(s: np.ndarray, size: int, rises: np.ndarray, first: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from this order of the LMS suffixes."""
    n = len(s)
    falling, rising = np.bincount(s[~rises], minlength=size), np.bincount(s[rises], minlength=size)
    ends = np.cumsum(falling + rising)
    middles = ends - rising
    out = np.empty(n, np.int32)
    before = np.empty(n + 1, np.int32)  # the symbol left of a position; none left of the first
    before[0], before[1:] = -1, s
    given = np.bincount(s[lms], minlength=size)
    lms = lms[np.argsort(s[lms], kind="stable")]
    given = np.append(0, np.cumsum(given))

    head = middles - falling
    if not rises[n - 1]:
        out[head[s[n - 1]]] = n - 1
        head[s[n - 1]] += 1
    for c in np.flatnonzero(falling + np.diff(given)):
        low, high = middles[c] - falling[c], middles[c]
        if high > low:
            out[low:high] = _laid_out(out[low : head[c]], first)
        sources = np.concatenate((out[low:high], lms[given[c] : given[c + 1]]))
        symbols = before[sources]
        up = symbols > c
        _put(out, head, symbols[up], sources[up] - 1)

    tail = ends.copy()  # rising suffixes fill each bucket from its right end
    for c in np.flatnonzero(falling + rising)[::-1]:
        if rising[c]:
            found = out[tail[c] : ends[c]][::-1]
            out[middles[c] : ends[c]] = _laid_out(found, first)[::-1]
        sources = out[middles[c] - falling[c] : ends[c]][::-1]
        symbols = before[sources]
        down = (symbols < c) & (symbols >= 0)
        _put(out, tail, symbols[down], sources[down] - 1, -1)
    return out


def _put(out: np.ndarray, edge: np.ndarray, symbols: np.ndarray, positions: np.ndarray, step: int = 1) -> None:
    """Add positions to their symbols' buckets in the given order, from the left or (``step`` -1) from the right end."""
    if len(symbols):
        symbols, positions, starts, counts = _grouped(symbols, positions)
        turn = np.arange(len(symbols)) - np.repeat(starts, counts)
        out[edge[symbols] + (turn if step > 0 else -1 - turn)] = positions
        edge[symbols[starts]] += step * counts


def _grouped(symbols: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, ...]:
    """Both sorted by symbol and otherwise in order, with the start and the length of each symbol's group."""
    order = np.argsort(symbols.astype(np.uint16) if symbols.max() < 1 << 16 else symbols, kind="stable")
    symbols = symbols[order]
    starts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    return symbols, positions[order], starts, np.diff(np.append(starts, len(symbols)))


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal names for equal LMS substrings, rising with ``ordered``; by position in ``lms``. And their number."""
    n = len(s)
    ends = np.append(lms[1:], n - 1)
    length = np.zeros(n, np.int32)
    length[lms] = ends - lms + 1
    length[lms[-1]] = 0  # it ends with the text, like no other
    left, right = ordered[:-1], ordered[1:]
    differs = length[left] != length[right]
    open_ = np.flatnonzero(~differs)
    step = 0
    while len(open_):
        a, b = left[open_] + step, right[open_] + step
        apart = s[a] != s[b]
        differs[open_[apart]] = True
        step += 1
        open_ = open_[~apart & (length[left[open_]] > step)]
    ranks = np.append(0, np.cumsum(differs))
    names = np.empty(n, np.int64)
    names[ordered] = ranks
    return names[lms], int(ranks[-1]) + 1


def suffix_array(s: np.ndarray, size: int) -> np.ndarray:
    """Positions of the suffixes of ``s`` in order; symbols are 0 to ``size`` - 1, and the end is below all of them."""
    n = len(s)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    if size > ALPHABET:
        return _doubled(s, size)
    rises, first = _classes(s)
    lms = np.flatnonzero(rises[1:] & ~rises[:-1]).astype(np.int32) + 1
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = _induced(s, size, rises, first, lms)
        ordered = order[is_lms[order]]
        names, distinct = _names(s, lms, ordered)
        if distinct == len(lms):
            lms = ordered
        else:
            lms = _sorted_by_names(lms, ordered, names, distinct)
    return _induced(s, size, rises, first, lms)


def _sorted_by_names(lms: np.ndarray, ordered: np.ndarray, names: np.ndarray, distinct: int) -> np.ndarray:
    """The LMS positions in the order of their suffixes, given the names of their substrings.

    No comparison goes beyond a name that occurs once, so a name that follows it and occurs once itself is left out of the
    shortened string; such a suffix already stands where it belongs.
    """
    once = np.bincount(names, minlength=distinct) == 1
    alone = once[names]
    kept = np.append(True, ~(alone[1:] & alone[:-1]))
    places, short = np.flatnonzero(kept), names[kept]
    used = np.zeros(distinct, bool)
    used[short] = True
    order = places[suffix_array((np.cumsum(used) - 1)[short], int(used.sum()))]
    out = ordered.copy()
    is_alone = np.zeros(int(lms[-1]) + 1, bool)
    is_alone[lms[alone]] = True
    out[~is_alone[ordered]] = lms[order[~alone[order]]]
    return out


def _doubled(s: np.ndarray, size: int) -> np.ndarray:
    """Suffix array by ranks of ever longer beginnings; only suffixes whose rank is shared are looked at again."""
    n = len(s)
    counts = np.bincount(s, minlength=size)
    rank = (np.cumsum(counts) - counts)[s]
    open_ = np.flatnonzero(counts[s] > 1)
    known = 1
    while len(open_):
        following = np.where(open_ + known < n, rank[np.minimum(open_ + known, n - 1)] + 1, 0)
        key = (rank[open_] << 32) | following
        order = np.argsort(key)
        open_, key = open_[order], key[order]
        at = np.arange(len(open_))
        new = np.append(True, key[1:] != key[:-1])
        old = np.append(True, key[1:] >> 32 != key[:-1] >> 32)
        starts = np.maximum.accumulate(np.where(new, at, 0))
        rank[open_] += starts - np.maximum.accumulate(np.where(old, at, 0))
        open_ = open_[~(new & np.append(new[1:], True))]
        known *= 2
    out = np.empty(n, np.int32)
    out[rank] = np.arange(n)
    return out


def common_prefixes(data: bytes, places: np.ndarray, before: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, up to ``most``, are alike from each place on and from the place of the suffix before it on.

    Places come in the order of the text (permuted), so that neighbours are compared with neighbours; eight bytes at a time.
    All places leave ``most`` bytes of data, at least eight.
    """
    words = np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))
    shared = np.full(len(places), most, np.int64)
    at = np.arange(len(places))
    for step in [*range(0, most - 8, 8), most - 8]:
        apart = words[places[at] + step] ^ words[before[at] + step]
        ends = apart != 0
        lowest = apart[ends] & (~apart[ends] + np.uint64(1))
        shared[at[ends]] = step + np.bitwise_count(lowest - np.uint64(1)) // 8
        at = at[~ends]
    return shared
