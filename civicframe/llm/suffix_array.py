"""Suffix arrays by induced sorting, on NumPy arrays.

Suffixes are classified as S (smaller than the next) or L; the leftmost S suffixes (LMS) are put in order by their
substrings, which a first induction sorts and names; equal names are resolved on the reduced string, where suffixes that
still have equals are sorted again, over doubled lengths; a second induction from the ordered LMS suffixes places all
others. Both inductions go through the buckets once, in waves: all suffixes of a bucket that are known so far deal their
predecessors at once, so the work is linear and each step is a few array operations (as many waves in a bucket as its
longest run of one byte).
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes; the end of the text is smaller than any byte."""
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = np.append(text[change] < text[change + 1], False)
    return np.repeat(rises, np.diff(np.concatenate(([-1], change, [len(text) - 1]))))


def _deal(text: np.ndarray, p: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Appends positions to the buckets of their bytes, in order."""
    if not len(p):
        return
    c = text[p]
    p = p[np.argsort(c, kind="stable")]
    n = np.bincount(c, minlength=256)
    at = 0
    for b in np.flatnonzero(n):
        buckets[b].append(p[at : at + n[b]])
        at += n[b]


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _pass(text: np.ndarray, wanted: np.ndarray, c: int, buckets: list[list[np.ndarray]]) -> np.ndarray:
    """Empties bucket c of one type in waves; predecessors of that type go to their buckets."""
    got, wave = [], _joined(buckets[c])
    while len(wave):
        got.append(wave)
        p = wave[wave > 0] - 1
        p = p[wanted[p]]
        same = text[p] == c
        _deal(text, p[~same], buckets)
        wave = p[same]
    return _joined(got)


def _induce(text: np.ndarray, s_type: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array that follows from LMS suffixes in the given order (of each byte)."""
    first = text[lms]
    order = np.argsort(first, kind="stable")
    lms, cut = lms[order], np.searchsorted(first[order], np.arange(257))
    l_type = ~s_type
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    _deal(text, np.array([len(text) - 1]), buckets)
    left = []
    for c in range(256):
        left.append(_pass(text, l_type, c, buckets))
        _deal(text, lms[cut[c] : cut[c + 1]] - 1, buckets)
    buckets = [[] for _ in range(256)]
    right: list[np.ndarray] = [np.zeros(0, np.int64)] * 256
    for c in range(255, -1, -1):
        right[c] = _pass(text, s_type, c, buckets)[::-1]
        p = left[c][::-1]
        p = p[p > 0] - 1
        _deal(text, p[s_type[p]], buckets)
    return np.concatenate([x for c in range(256) for x in (left[c], right[c])])


def _eights(text: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from each position, little-endian; zeros follow the text."""
    whole = np.concatenate((text, np.zeros(pad + 8, np.uint8)))
    return np.lib.stride_tricks.sliding_window_view(whole, 8)[: len(text) + pad + 1].copy().view("<u8").ravel()


def _firsts(new: np.ndarray) -> np.ndarray:
    """For each place, the last one up to it where something new begins."""
    at = np.flatnonzero(new)
    return np.repeat(at, np.diff(np.append(at, len(new))))


def _names(text: np.ndarray, lms: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings by place in the reduced string: how many come before the first of their equals."""
    end = np.append(lms[1:], len(text))
    length = np.zeros(len(text), np.int64)
    length[lms] = end - lms + 1
    n = length[in_order]
    same = (n[1:] == n[:-1]) & (in_order[1:] != lms[-1]) & (in_order[:-1] != lms[-1])
    eight = _eights(text, 8)
    todo = np.flatnonzero(same)
    at = 0
    while len(todo):
        a, b, k = in_order[todo] + at, in_order[todo + 1] + at, n[todo] - at
        x = eight[a] ^ eight[b]
        short = k < 8
        x[short] &= (np.uint64(1) << (8 * k[short]).astype(np.uint64)) - np.uint64(1)
        same[todo[x != 0]] = False
        todo = todo[(x == 0) & (k > 8)]
        at += 8
    name = length  # not needed any more
    name[in_order] = _firsts(np.append(True, ~same))
    return name[lms]


def _order(rank: np.ndarray, order: np.ndarray, lms: np.ndarray, depth: int | None) -> np.ndarray:
    """``order`` of the suffixes of the reduced string, refined from ranks of first names to all names, or to ``depth`` bytes.

    Suffixes with equals are sorted by the ranks of what follows, over doubled lengths; the others stay where they are. No
    suffix with equals reaches the last name, which has none.
    """
    places, k = np.arange(len(rank)), 1
    tied = rank[order] != places
    tied[:-1] |= tied[1:]
    places = places[tied]
    while len(places):
        p = order[places]
        if depth is not None:
            short = lms[p + k] - lms[p] < depth
            places, p = places[short], p[short]
        key = rank[p] * len(rank) + rank[p + k]
        by = np.argsort(key, kind="stable")
        key, p = key[by], p[by]
        new = np.ones(len(p), bool)
        new[1:] = key[1:] != key[:-1]
        order[places] = p
        rank[p] = places[_firsts(new)]
        tied = ~new
        tied[:-1] |= ~new[1:]
        places, k = places[tied], 2 * k
    return order


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Positions of all suffixes of ``text`` (uint8) in order; with ``depth``, suffixes that share so many bytes may stand in any order."""
    if len(text) < 2:
        return np.arange(len(text))
    s_type = _types(text)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if len(lms) > 1:
        sa = _induce(text, s_type, lms)
        is_lms = np.zeros(len(text), bool)
        is_lms[lms] = True
        in_order = sa[is_lms[sa]]
        place = np.zeros(len(text), np.int64)
        place[lms] = np.arange(len(lms))
        lms = lms[_order(_names(text, lms, in_order), place[in_order], lms, depth)]
    return _induce(text, s_type, lms)


def _common(eight: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes from the positions a and b on, by eight bytes at a time, until they reach ``cap``."""
    out = np.zeros(len(a), np.int64)
    todo, at = np.arange(len(a)), 0
    while len(todo) and at < cap:
        x = eight[a + at] ^ eight[b + at]
        ends = x != 0
        x = x[ends]
        low = (x & (~x + np.uint64(1))).astype(np.float64)  # lowest differing bit, whose exponent says the byte
        out[todo[ends]] = at + (((low.view(np.int64) >> 52) - 1023) >> 3)
        todo, a, b = (y[~ends] for y in (todo, a, b))
        at += 8
    out[todo] = at
    return out


def permuted_lcp(text: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """For each position, the common prefix with the suffix before it in ``sa``, at most ``cap`` bytes; 0 for the first.

    Along consecutive positions with the same distance to their suffix before, a prefix reaches to the next differing
    byte; so only what follows the last of them is compared.
    """
    n = len(text)
    if n < 2:
        return np.zeros(n, np.int64)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = sa[0]
    differs = text != text[before]
    differs[sa[0]] = True
    stops = differs.copy()
    stops[:-1] |= np.diff(before) != 1
    stops[-1] = True
    at = np.flatnonzero(stops)
    end = at.copy()
    going = np.flatnonzero(~differs[at])
    p = at[going] + 1
    end[going] = p + _common(_eights(text, cap + 8), p, before[p - 1] + 1, cap)
    places = np.arange(n)
    out = np.repeat(end, np.diff(at, prepend=-1)) - places
    return np.minimum(np.minimum(out, cap), n - np.maximum(places, before))
