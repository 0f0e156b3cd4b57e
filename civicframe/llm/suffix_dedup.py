"""Suffix-array dedup: bytes covered by a long string that also starts earlier are removed.

Documents that may repeat something are compared in shards (see ``repeats``): the neighbourhoods that share a key are
joined into one text, its suffix array is built by induced sorting, and the permuted common prefixes show which windows
are equal: neighbours in the array with a common prefix of at least the window. Of each such run all but the first
occurrence are repeated.

Defined cases: a null text is empty; rows that repeat a doc_id with its text are one document with a row each; a doc_id
with several texts stands for as many documents (in the order of their hashes); texts shorter than the window lose
nothing; a very long text is read in segments and is never cut; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm import repeats
from civicframe.llm.common import BYTES
from civicframe.llm.suffix_array import permuted_lcp, suffix_array

#: Bytes of a string that counts as repeated; of an anchor; windows of a hot anchor's range; bytes of a shard's text.
WINDOW, GRAM, STEP, SHARD = 100, 36, 8, 1 << 20


def _bytes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTES[raw], offsets


def _places(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.arange(len(raw) + 1)
    return at[:-1], at[1:], offsets


def shard_repeats(pieces: list[repeats.Piece], window: int) -> Iterator[repeats.Found]:
    """The windows among the pieces that also start earlier in a piece."""
    text = np.frombuffer(b"".join(p.raw for p in pieces), np.uint8)
    sizes = np.array([len(p.raw) for p in pieces])
    begin = np.cumsum(sizes) - sizes
    n = np.array([p.n for p in pieces])
    ids, vers, lo = (np.array(x, np.int64) for x in zip(*((p.doc, p.ver, p.lo) for p in pieces), strict=True))
    order = np.lexsort((vers, ids))
    doc = np.zeros(len(pieces), np.int64)
    doc[order[1:]] = np.cumsum((np.diff(ids[order]) != 0) | (np.diff(vers[order]) != 0))
    # when each window starts: its document, and its start there (below 2**40); -1 where no window of a piece starts
    when = np.full(len(text), -1)
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    when[at] = np.repeat((doc << 40) + lo - begin, n) + at
    sa = suffix_array(text, depth=window)
    fresh = permuted_lcp(text, sa, window)[sa] < window  # in order of suffixes, equal windows stand together
    start = when[sa]
    here = start >= 0
    run, sa, start = np.cumsum(fresh)[here], sa[here], start[here]
    new = np.flatnonzero(np.diff(run, prepend=-1))
    earliest = np.minimum.reduceat(start, new) if len(new) else run
    again = np.zeros(len(text) + 1, bool)
    again[sa] = start != np.repeat(earliest, np.diff(np.append(new, len(sa))))
    edge = np.zeros(len(text) + 1, bool)  # where a piece begins
    edge[begin] = True
    first = again.copy()
    first[1:] &= ~again[:-1] | edge[1:]
    last = again.copy()
    last[:-1] &= ~again[1:] | edge[1:]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    of = np.searchsorted(begin, first, side="right") - 1
    shift = lo[of] - begin[of]
    for k, a, b in zip(of.tolist(), (first + shift).tolist(), (last + shift).tolist(), strict=True):
        yield pieces[k], a, b


def _resolver(window: int, most: int = SHARD) -> repeats.Resolver:
    def resolve(keys: Iterator[list[repeats.Piece]]) -> Iterator[repeats.Found]:
        shard, size = [], 0
        for group in keys:
            shard += group
            size += sum(len(p.raw) for p in group)
            if size > most:
                yield from shard_repeats(shard, window)
                shard, size = [], 0
        if shard:
            yield from shard_repeats(shard, window)

    return resolve


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, step: int = STEP, **bounds: int) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256."""

    def cut(raw: bytes, lows: np.ndarray | None, highs: np.ndarray | None) -> tuple:
        gone = repeats.covered(len(raw), lows, highs, window)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if lows is not None else raw
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
        return len(raw), len(raw) - len(kept), spans, kept, hashlib.sha256(kept).hexdigest()

    kind = repeats.Kind(_bytes, _places, window, gram, step, **bounds)
    return repeats.remove(docs, kind, _resolver(window), cut, "n_bytes long,n_removed long,n_spans long,kept binary,kept_sha256 string")


def digest(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept_sha256"))
