"""Lexical retrieval packing: windows are filled with a seed document and its lexical neighbours.

Whole windows of a long document are sequences of their own; what is left of each document is packed. Documents are dealt
into shards of bounded size, ordered by a min-hash of their token pairs (so that related documents tend to meet; ranges
of ids split equal ones). Each shard has an inverted index with BM25 weights. The first unused document is the seed and
all its terms are the query; the index returns its best unused neighbours, which fill the window greedily; the last one is cut where the window ends, and
what is left of it stays unused. So all windows of a shard are full but for its last few tokens, which become sequences
whose lengths are powers of two and need no padding.

Defined cases: a null text is empty and has just the closing id; rows that repeat a doc_id are packed each, with the same
positions; an empty table gives an empty result. ``sequence_id`` is unique in a result, not the same in another run.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import bound_arrow_batches, with_id, written
from civicframe.llm.tokens import default_path, tokenizer

#: Tokens of a window, the id that closes a document, tokens of a shard.
WINDOW, CLOSE, SHARD = 2048, 1, 1_000_000
K1, B = 1.2, 0.75
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [x.split()[0] for x in PIECE.split(", ")]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _numbers(kind: int) -> Iterator[int]:
    """Sequence numbers of a task: of partition, count and kind (whole windows of a document, or a shard's)."""
    return ((TaskContext.get().partitionId() << 34) + (n << 1) + kind for n in count())


#: Odd multipliers of the sketch.
_SKETCH = np.array([0x9E3779B1, 0x85EBCA77], np.uint32)


def _sketch(ids: np.ndarray) -> int:
    """Smallest hash of two consecutive ids."""
    x = ids.astype(np.uint32) * _SKETCH[0]
    return int(((x[:-1] ^ (x[:-1] >> np.uint32(15))) * _SKETCH[1] + x[1:]).min() if len(x) > 1 else x[0])


def _tokenise(path: str, window: int):
    names = [*NAMES, "sketch", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        close = np.array([CLOSE], tok.dtype).tobytes()
        numbers = _numbers(0)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                rows = []
                for doc, raw in zip(docs[at : at + 500], tok.encode([x or "" for x in texts[at : at + 500]]), strict=True):
                    ids = np.frombuffer(raw + close, tok.dtype)
                    whole = len(ids) // window * window
                    rows += [(doc, s, window, _crc(ids[s : s + window]), len(ids), next(numbers), 0, None, None) for s in range(0, whole, window)]
                    if whole < len(ids):
                        rest = ids[whole:]
                        rows.append((doc, whole, len(rest), None, len(ids), None, None, _sketch(rest), rest.tobytes()))
                kinds = [pa.int64()] * 8 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return run


class Index:
    """BM25 postings of a shard: for each term the documents and weights, terms by id."""

    def __init__(self, texts: list[np.ndarray]):
        size = np.array([len(t) for t in texts])
        doc = np.repeat(np.arange(len(texts)), size)
        ids = np.concatenate(texts)
        small = (int(ids.max()) + 1) * len(texts) < 1 << 32
        key = np.sort(ids.astype(np.uint32 if small else np.uint64) * len(texts) + doc.astype(np.uint32 if small else np.uint64))
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key, tf = key[at].astype(np.int64), np.diff(np.append(at, len(key)))
        self.doc = key % len(texts)
        terms, first, df = np.unique(key // len(texts), return_index=True, return_counts=True)
        self.first, self.last = first, first + df
        idf = np.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.doc] / size.mean()))
        # each document's own terms, but for those that no other document has
        shared = np.flatnonzero(np.repeat(df > 1, df))
        order = shared[np.argsort(self.doc[shared], kind="stable")]
        of = np.repeat(np.arange(len(terms)), df)[order]
        cut = np.searchsorted(self.doc[order], np.arange(len(texts) + 1))
        self.query = [of[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        self.n = self.kept = len(texts)

    def drop(self, gone: np.ndarray) -> None:
        """Postings of documents that are used up leave the index, once they are a fifth of it; the weights stay."""
        left = self.n - int(np.count_nonzero(gone))
        if left > 0.8 * self.kept:
            return
        keep = ~gone[self.doc]
        at = np.concatenate(([0], np.cumsum(keep)))
        self.first, self.last, self.kept = at[self.first], at[self.last], left
        self.doc, self.weight = self.doc[keep], self.weight[keep]

    def neighbours(self, seed: int) -> np.ndarray:
        """All documents in the index that share a term with the seed, best first; ties by place."""
        terms = self.query[seed]
        spans = [slice(a, b) for a, b in zip(self.first[terms].tolist(), self.last[terms].tolist(), strict=True) if a < b]
        if not spans:
            return np.zeros(0, np.int64)
        score = np.bincount(np.concatenate([self.doc[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n)
        hit = np.flatnonzero(score)
        return hit[np.argsort(-score[hit], kind="stable")]


def pack_shard(docs: list[tuple[int, int, int, np.ndarray]], window: int, numbers: Iterator[int]) -> Iterator[tuple]:
    """Pieces (as PIECE) of a shard's documents (doc_id, start, tokens of the document, ids)."""
    index = Index([d[3] for d in docs])
    used = np.zeros(len(docs), np.int64)
    size = np.array([len(d[3]) for d in docs])
    line: list[tuple[int, int, int]] = []  # pieces of the window: (document, from, to)

    def closed(line: list[tuple[int, int, int]]) -> Iterator[tuple]:
        name, at = next(numbers), 0
        for k, a, b in line:
            doc, start, tokens, ids = docs[k]
            yield doc, start + a, b - a, _crc(ids[a:b]), tokens, name, at
            at += b - a

    def fill(k: int) -> int:
        take = min(room, size[k] - used[k])
        line.append((k, int(used[k]), int(used[k] + take)))
        used[k] += take
        return int(take)

    room, seed = window, 0
    while True:
        while seed < len(docs) and used[seed] == size[seed]:
            seed += 1
        if seed == len(docs):
            break
        start = seed
        room -= fill(start)
        if room:
            index.drop(used == size)
            for k in index.neighbours(start):
                if used[k] < size[k]:
                    room -= fill(k)
                    if not room:
                        break
        if not room:
            yield from closed(line)
            line, room = [], window
    # what is left: sequences of powers of two
    rest = sum(b - a for _, a, b in line)
    while rest:
        n = part = 1 << (rest.bit_length() - 1)
        one: list[tuple[int, int, int]] = []
        while part:
            k, a, b = line[0]
            take = min(part, b - a)
            one.append((k, a, a + take))
            line[0] = (k, a + take, b)
            if a + take == b:
                line.pop(0)
            part -= take
        yield from closed(one)
        rest -= n


def _shards(path: str, window: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, numbers = tokenizer(path).dtype, _numbers(1)

        def out(docs: list) -> pa.RecordBatch:
            rows = list(pack_shard(docs, window, numbers))
            return pa.RecordBatch.from_arrays([pa.array([int(r[i]) for r in rows], pa.int64()) for i in range(len(NAMES))], NAMES)

        docs, n = [], 0
        for batch in batches:
            for doc, start, tokens, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids = np.frombuffer(raw, dtype)
                if n + len(ids) > shard_tokens and docs:
                    yield out(docs)
                    docs, n = [], 0
                docs.append((doc, start, tokens, ids))
                n += len(ids)
        if docs:
            yield out(docs)

    return run


def pack(docs: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    bound_arrow_batches(docs.sparkSession, lean=False)  # its workers hold little
    path = path or default_path()
    rows = written(with_id(docs, "text").mapInArrow(_tokenise(path, window), f"{PIECE}, sketch long, ids binary"), "tokens")
    whole = rows.where("ids is null").select(*NAMES)
    rest = rows.where("ids is not null")
    n = rest.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-n // (4 * shard_tokens)))  # about four shards a partition
    dealt = rest.repartitionByRange(shards, "sketch", "doc_id").sortWithinPartitions("sketch", "doc_id", "start").select("doc_id", "start", "doc_tokens", "ids")
    return whole.unionByName(dealt.mapInArrow(_shards(path, window, shard_tokens), PIECE))
