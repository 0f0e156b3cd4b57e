"""Substring dedup on words with suffix automata: words covered by a window that also starts earlier are removed.

The reference is what the corpus may repeat, in shards by key (see ``repeats``): a suffix automaton over the words of a
key's earlier contents, through which the next content is streamed. Its matching statistics (the longest suffix of what
was read that occurs in the reference) show the windows that occur there; then the content is added. Reference shards are
dealt by key instead of being broadcast, since here the reference is the corpus itself, which has no size bound; each
shard meets just the words that can match it.

Defined cases: a null text has no words; rows that repeat a doc_id with its text are one document with a row each; a
doc_id with several texts stands for as many documents (in the order of their hashes); a very long text is read in
segments and is never cut; an empty table gives an empty result; other columns are ignored. Words keep their case; the
kept words are joined by one space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from civicframe.llm import repeats
from civicframe.llm.common import BYTES, Spans, words_of

#: Words of a window and of an anchor; windows of a hot anchor's range.
WINDOW, GRAM, STEP = 20, 8, 2


def word_symbols(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words_of(raw, offsets)
    return Spans(BYTES[raw])(starts, ends), first


class SuffixAutomaton:
    """Of several sequences: states with their longest length, suffix link and transitions."""

    def __init__(self) -> None:
        self.length, self.link, self.next = [0], [-1], [{}]

    def _state(self, length: int, link: int, following: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, p: int, c, q: int) -> int:
        """A copy of q for the shorter strings that end there from p on."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, sequence: list) -> None:
        length, link, nxt = self.length, self.link, self.next
        last = 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:  # there from an earlier sequence
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            cur, p = self._state(length[last] + 1, 0, {}), last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = cur

    def statistics(self, sequence: list) -> list[int]:
        """For each place, the length of the longest suffix of what was read that occurs in the sequences."""
        length, link, nxt = self.length, self.link, self.next
        state, n, out = 0, 0, []
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            to = nxt[state].get(c)
            if to is None:
                n = 0
            else:
                state, n = to, n + 1
            out.append(n)
        return out


def _resolver(window: int) -> repeats.Resolver:
    def resolve(keys: Iterator[list[repeats.Piece]]) -> Iterator[repeats.Found]:
        for group in keys:
            reference = SuffixAutomaton()
            for k, piece in enumerate(group):
                words = piece.raw.split()
                if k:
                    found = np.array(reference.statistics(words)[window - 1 :]) >= window
                    if found.any():
                        yield from repeats.flagged(piece, found)
                if k + 1 < len(group):
                    reference.add(words)

    return resolve


def dedup_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, step: int = STEP, **bounds: int) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (text), kept_sha256."""

    def cut(raw: bytes, lows: np.ndarray | None, highs: np.ndarray | None) -> tuple:
        words = raw.split()
        gone = repeats.covered(len(words), lows, highs, window)
        kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
        return len(words), int(gone.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()

    kind = repeats.Kind(word_symbols, words_of, window, gram, step, **bounds)
    return repeats.remove(docs, kind, _resolver(window), cut, "n_words long,n_removed long,kept string,kept_sha256 string")


def digest(docs: DataFrame) -> DataFrame:
    return dedup_words(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
