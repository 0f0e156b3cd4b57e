"""Routing of repeated windows: which windows of symbols may occur twice, and what has to be compared to tell.

A window is ``window`` consecutive symbols (bytes or words) of one document. Its anchor is the ``gram``-symbol string
inside it with the smallest hash, the leftmost of equals; so equal windows have equal anchors at the same place in them.
Consecutive windows of a document that share an anchor occurrence form a neighbourhood, about two per window length.
Hashes only route: (key of the anchor, hash of the neighbourhood, document, range of window starts) is dealt out by key.

* Documents with equal texts are one class: the first takes part, the others follow it.
* A key with one neighbourhood: none of its windows repeats.
* Neighbourhoods of a key with equal hashes are a class. Where a key has several classes, their first members are asked
  for their symbols, and a resolver (suffix array, suffix automaton) compares their windows.
* The first and the second member of a class are compared too, under a key of the two documents and their distance, so
  that adjoining neighbourhoods of two documents are one piece. The other members follow the second one: they are
  repeated if the resolver found all windows of the second to be.

Hot anchors (a line in a third of all documents) aren't one group: occurrences of anchors are counted over all documents
in a table of fixed size. An anchor beyond SOME splits its neighbourhoods into ranges of ``step`` windows, whose key is
the part that all windows of the range share; beyond MANY into single windows, whose key is the window itself. If a key
turns out to have more than CONTENTS classes, its first members are dealt anew by single windows. So a key never asks
for more than that many contents, and no window that starts earlier elsewhere is missed at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import Spans, bound_arrow_batches, broadcast_if_small, counter_rows, mix, powers, summed_counters, text_parts, with_id, written

#: Symbols that are treated together (a longer text by itself, in segments), and neighbourhoods that a task gathers before it compares them.
SEGMENT, HELD = 1 << 19, 1 << 20
#: Counters of anchors; occurrences beyond which an anchor is split into ranges, into single windows; most classes that a key asks for.
WIDTH, SOME, MANY, CONTENTS = 1 << 20, 2048, 1 << 20, 4096
#: Rows of asks that are broadcast.
ASKS = 400_000
#: Last window of a document that is a copy as a whole.
WHOLE = 1 << 62


@dataclass(frozen=True)
class Kind:
    """What a window is made of.

    ``symbols``: (bytes, offsets of the texts) -> (symbols as 64-bit numbers, offsets of the texts in them).
    ``places``: the same -> (first byte of each symbol, byte after it, offsets of the texts in symbols).
    """

    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    places: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
    window: int
    gram: int
    step: int
    some: int = SOME
    many: int = MANY
    contents: int = CONTENTS


@dataclass(frozen=True)
class Piece:
    """What asks got: windows ``lo`` to ``lo + n - 1`` of a document, as bytes of their symbols. ``classes``: (class, first window, windows), 64 bits each, of the classes whose second member stands there."""

    doc: int
    ver: int
    lo: int
    n: int
    raw: bytes
    classes: bytes = b""


#: The windows ``lo`` to ``hi`` of a piece also start earlier.
Found = tuple[Piece, int, int]
Resolver = Callable[[Iterator[list[Piece]]], Iterator[Found]]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(n)


def _anchored(symbols: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Iterator[tuple]:
    """(segment's start, its spans, text, first window start, last one, anchor's place, anchor's hash) of all neighbourhoods, by segments; places count from the segment's start."""
    width = window - gram + 1
    known = _powers(SEGMENT + window)
    # by turns, where a text's windows begin and where no window begins any more
    edges = np.append(np.stack([offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - window + 1)], 1).ravel(), offsets[-1])
    for at in range(0, max(0, len(symbols) - window + 1), SEGMENT):
        part = symbols[at : at + SEGMENT + window - 1]
        spans = Spans(part, known)
        n = len(part) - window + 1
        h = spans.all(gram)
        low = np.uint64((1 << 20) - 1)
        best = _sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), width)
        inside = np.diff(np.clip(edges - at, 0, n))
        fine = np.repeat(np.arange(len(inside)) % 2 == 0, inside)
        fresh = np.empty(n, bool)
        fresh[0] = True
        fresh[1:] = (best[1:] != best[:-1]) | ~fine[:-1]
        begins = offsets[(offsets > at) & (offsets < at + n)] - at
        fresh[begins] = True
        first = np.flatnonzero(fresh & fine)
        if not len(first):
            continue
        broken = np.flatnonzero(fresh | ~fine)
        last = np.append(broken, n)[np.searchsorted(broken, first, side="right")] - 1
        text = np.searchsorted(offsets, first + at, side="right") - 1
        place = (best[first] & low).astype(np.int64)
        yield at, spans, text, first, last, place, h[place]


def neighbourhoods(symbols: np.ndarray, offsets: np.ndarray, window: int, gram: int, step: int = 1, levels: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window start, last one, key, content) of all neighbourhoods; starts count from the beginning of their text.

    ``levels``, by the last bits of an anchor's hash: 0, or 1 (split into ranges of ``step`` windows), or 2 (into single windows).
    """
    for at, spans, text, first, last, best, h in _anchored(symbols, offsets, window, gram):
        key = h
        if levels is not None and (level := levels[(h & np.uint64(len(levels) - 1)).astype(np.int64)]).any():
            size = np.where(level == 0, window, np.where(level == 1, step, 1))  # a whole neighbourhood has fewer than ``window``
            most = (best - first) // size  # ranges are counted from the anchor, backwards
            parts = most - (best - last) // size + 1
            own = np.repeat(np.arange(len(first)), parts)
            q = most[own] - (np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts))
            size, level, best, whole = size[own], level[own], best[own], (level == 0)[own]
            latest, earliest = best - q * size, best - (q + 1) * size + 1
            core = mix(spans(np.where(whole, 0, latest), np.where(whole, 0, earliest + window)) + q.astype(np.uint64) * np.uint64(4) + level.astype(np.uint64))
            key = np.where(whole, h[own], core)
            first, last, text = np.maximum(first[own], earliest), np.minimum(last[own], latest), text[own]
        content = mix(spans(first, last + window) + (best - first).astype(np.uint64))
        base = offsets[text] - at
        yield text, first - base, last - base, key, content


def _counts(kind: Kind):
    """A task's table of anchor counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size = np.zeros(WIDTH, np.int64), [], 0
        for batch in batches:
            for _, _, raw, offsets in text_parts(batch.column(0), SEGMENT):
                for *_, h in _anchored(*kind.symbols(raw, offsets), kind.window, kind.gram):
                    held.append((h & np.uint64(WIDTH - 1)).astype(np.int64))
                    size += len(h)
                if size > HELD:
                    counts += np.bincount(np.concatenate(held), minlength=WIDTH)
                    held, size = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=WIDTH)
        chunks, parts = counter_rows(counts)
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(parts, pa.binary())], ["chunk", "counts"])

    return run


def _levels(counts: np.ndarray, some: int, many: int) -> np.ndarray:
    """How each counter's anchors are split; the median is what rare anchors together add to a counter."""
    usual = float(np.median(counts))
    over = counts - usual
    slack = 4 * usual**0.5
    return (over > some + slack).astype(np.uint8) + (over > many + slack).astype(np.uint8)


ROUTED = "route long, member boolean, key long, content long, doc long, ver long, lo long, hi long"
#: What the rows are for that ``_decide`` returns: follow their class; be compared under ``key``; be dealt anew by windows.
FOLLOW, ASK, SPLIT = 0, 1, 2
DECIDED = "what byte, key long, cls long, second boolean, doc long, ver long, lo long, hi long"


def _class(key: np.ndarray, content: np.ndarray) -> np.ndarray:
    return mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + content)


def _ranks(rows: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Of rows (key, content, doc, ver, lo, hi) in order: without repeated ones, and the place of each in its class."""
    if not len(rows[0]):
        return rows, np.zeros(0, np.int64)
    key, content, doc, ver, lo, _ = rows
    differs = np.ones(len(key), bool)
    differs[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
    new = differs.copy()
    new[1:] |= (doc[1:] != doc[:-1]) | (ver[1:] != ver[:-1]) | (lo[1:] != lo[:-1])
    rows, differs = [x[new] for x in rows], differs[new]
    at = np.arange(len(differs))
    return rows, at - np.flatnonzero(differs)[np.cumsum(differs) - 1]


def _batch(names: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "byte": pa.int8()}
    heads = [x.split() for x in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, kinds[k]) for c, (_, k) in zip(columns, heads, strict=True)], [n for n, _ in heads])


def _flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """A task's neighbourhoods (doc, ver, lo, hi, key, content): of each class the first two go to their key, the others only follow."""
    if not held:
        return
    doc, ver, lo, hi, key, content = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((lo, ver, doc, _class(key, content)))
    rows, rank = _ranks([x[order] for x in (key, content, doc, ver, lo, hi)])
    member = rank > 1
    cls = _class(rows[0], rows[1])
    route = np.where(member, mix(cls + rows[2].view(np.uint64)), rows[0])
    yield _batch(ROUTED, [route, member, rows[0], np.where(member, cls, rows[1]), *rows[2:]])


def _keys(kind: Kind, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids, vers = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for i, j, raw, offsets in text_parts(batch.column(2), SEGMENT):
                for text, *rest in neighbourhoods(*kind.symbols(raw, offsets), kind.window, kind.gram, kind.step, levels.value):
                    held.append((ids[i:j][text], vers[i:j][text], *rest))
                    n += len(text)
                if n > HELD:
                    yield from _flush(held)
                    held, n = [], 0
        yield from _flush(held)

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """(row of each, elements) of a column of arrays of structs."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), column.flatten()


def _asked_places(batch: pa.RecordBatch, kind: Kind, column: int) -> Iterator[tuple]:
    """(raw bytes, symbols' first bytes, bytes after them, symbol where each ask's text begins, row of each ask, the asks) by parts of a batch."""
    rows, asks = _lists(batch.column(column))
    for i, j, raw, offsets in text_parts(batch.column(2), SEGMENT):
        a, b = np.searchsorted(rows, [i, j])
        begin, end, first = kind.places(raw, offsets)
        yield raw, offsets, begin, end, first, rows[a:b] - i, rows[a:b], asks.slice(a, b - a)


def _windows(kind: Kind):
    """Each asked-for window by itself; its key is the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            ids, vers = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for raw, offsets, _, _, first, text, row, asks in _asked_places(batch, kind, 3):
                symbols, _ = kind.symbols(raw, offsets)
                lo, hi = (asks.field(n).to_numpy(zero_copy_only=False) for n in ("lo", "hi"))
                own = np.repeat(np.arange(len(lo)), hi - lo + 1)
                start = lo[own] + np.arange(len(own)) - np.repeat(np.cumsum(hi - lo + 1) - (hi - lo + 1), hi - lo + 1)
                at = first[text[own]] + start
                h = mix(Spans(symbols)(at, at + kind.window) + np.uint64(3))
                held.append((ids[row[own]], vers[row[own]], start, start, h, h))
            yield from _flush(held)

    return run


def _pair_keys(rows: list[np.ndarray], rank: np.ndarray) -> np.ndarray:
    """Under which key the first two members of each class are compared."""
    key, content, doc, ver, lo, _ = rows
    j = np.flatnonzero(rank == 1)
    i = j - 1
    one, two = (mix(doc[x].view(np.uint64) + mix(ver[x].view(np.uint64))) for x in (i, j))
    pair = mix(one * np.uint64(3) + mix(two + (lo[j] - lo[i]).view(np.uint64)))
    out = np.zeros(len(rank), np.uint64)
    out[j] = out[i] = np.where(one == two, _class(key[j], content[j]), pair)  # within a document pieces may overlap: each class by itself
    return out


def _decide(most: int):
    """Of rows sorted by (key, content, document, start): who is compared, who follows. Holds two rows of each of ``most`` classes at most."""

    def out(what: int, rows: list[np.ndarray], pick: np.ndarray, key: np.ndarray | None = None, second: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        if pick.any():
            own, content, *place = (x[pick] for x in rows)
            n = len(own)
            none = np.zeros(n, np.int64)
            cls = _class(own, content) if what == FOLLOW or key is not None else none
            yield _batch(DECIDED, [np.full(n, what, np.int8), none if what == FOLLOW else own if key is None else key[pick], cls, np.zeros(n, bool) if second is None else second[pick], *place])

    def classes(rows: list[np.ndarray], rank: np.ndarray, fresh: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What comes of each class whatever its key: the first two are compared (once the second is there), the others follow."""
        paired = np.append(rank[1:] == 1, False)
        second = rank == 1
        now = (fresh & second) | (paired & np.append((fresh & second)[1:], False))
        yield from out(ASK, rows, now, _pair_keys(rows, rank), second)
        yield from out(FOLLOW, rows, fresh & (rank > 1))

    def whole(rows: list[np.ndarray], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Keys with all their rows."""
        if not len(rank):
            return
        new = np.ones(len(rank), bool)
        new[1:] = rows[0][1:] != rows[0][:-1]
        at = np.flatnonzero(new)
        contents = np.repeat(np.add.reduceat((rank == 0).astype(np.int64), at), np.diff(np.append(at, len(rank))))
        yield from out(ASK, rows, (rank == 0) & (contents > 1) & (contents <= most))
        yield from out(SPLIT, rows, (rank == 0) & (contents > most))
        yield from classes(rows, rank, np.ones(len(rank), bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        streaming, sent = False, 0  # whether the open key is dealt anew already; rows of ``rest`` (its last class) that were sent
        for batch in batches:
            member = batch.column(1).to_numpy(zero_copy_only=False)
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 8)]
            rows[:2] = [x.view(np.uint64) for x in rows[:2]]
            if member.any():
                cls, *place = (x[member] for x in rows[1:])
                n = len(cls)
                yield _batch(DECIDED, [np.full(n, FOLLOW, np.int8), np.zeros(n, np.int64), cls, np.zeros(n, bool), *place])
                rows = [x[~member] for x in rows]
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            if not len(rows[0]):
                continue
            rows, rank = _ranks(rows)
            if streaming:  # the open key's rows come first
                n = int(np.count_nonzero(rows[0] == rows[0][0]))
                own, r, new = [x[:n] for x in rows], rank[:n], np.arange(n) >= sent
                yield from out(SPLIT, own, new & (r == 0))
                yield from classes(own, r, new)
                if n == len(rows[0]):
                    begin = n - 1 - int(r[-1])
                    rest = [x[begin : begin + 2] for x in own]
                    sent = len(rest[0])
                    continue
                rows, rank = [x[n:] for x in rows], rank[n:]
                streaming = False
            cut = int(np.count_nonzero(rows[0] != rows[0][-1]))  # the last key may go on
            yield from whole([x[:cut] for x in rows], rank[:cut])
            rest, rank = [x[cut:] for x in rows], rank[cut:]
            yield from out(FOLLOW, rest, rank > 1)
            rest, rank = [x[rank <= 1] for x in rest], rank[rank <= 1]
            if int(np.count_nonzero(rank == 0)) > most:
                yield from out(SPLIT, rest, rank == 0)
                yield from classes(rest, rank, np.ones(len(rank), bool))
                begin = len(rank) - 1 - int(rank[-1])
                rest, streaming = [x[begin:] for x in rest], True
                sent = len(rest[0])
        if rest is not None and not streaming:
            yield from whole(*_ranks(rest))

    return run


#: Windows of a piece that is joined of several.
JOINED = 1 << 16


def _cut(kind: Kind):
    """The symbols of asks, as bytes; what adjoins in one document, of the classes that it shares with another, is one piece."""
    names = ["key", "doc", "ver", "lo", "n", "piece", "classes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vers = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for raw, _, begin, end, first, text, row, asks in _asked_places(batch, kind, 3):
                if not len(row):
                    continue
                lo, hi, key, cls, second = (asks.field(n).to_numpy(zero_copy_only=False) for n in ("lo", "hi", "key", "cls", "second"))
                order = np.lexsort((lo, second, key, row))
                lo, hi, key, cls, second, row, text = (x[order] for x in (lo, hi, key, cls, second, row, text))
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (second[1:] != second[:-1]) | (lo[1:] != hi[:-1] + 1) | (lo[1:] // JOINED != lo[:-1] // JOINED) | (cls[1:] == 0)
                at = np.flatnonzero(new)
                last = np.append(at[1:], len(row)) - 1
                a, b = begin[first[text[at]] + lo[at]].tolist(), end[first[text[at]] + hi[last] + kind.window - 1].tolist()
                parts = np.stack([cls, lo, hi - lo + 1], 1).astype(np.int64)
                data, marked = raw.tobytes(), second[at].tolist()
                columns = [key[at], ids[row[at]], vers[row[at]], lo[at], hi[last] - lo[at] + 1]
                for i in range(0, len(at), 20_000):
                    j = min(i + 20_000, len(at))
                    pieces = [data[x:y] for x, y in zip(a[i:j], b[i:j], strict=True)]
                    known = [parts[x : y + 1].tobytes() if m else b"" for x, y, m in zip(at[i:j].tolist(), last[i:j].tolist(), marked[i:j], strict=True)]
                    yield pa.RecordBatch.from_arrays([*(pa.array(x[i:j]) for x in columns), pa.array(pieces, pa.binary()), pa.array(known, pa.binary())], names)

    return run


#: Ranges that are repeated; and, with ``cls``, how many of the windows of a class's second member are.
ANSWER = "doc long, ver long, lo long, hi long, cls long, found long, windows long"


def _answers(resolve: Resolver):
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Piece]]:
        group, of, last = [], None, None
        for batch in batches:
            for key, *place, raw, classes in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if key != of and group:
                    yield group
                    group = []
                now = (key, *place, classes)
                if now != last:  # a row that repeats a doc_id with its text brings its pieces again
                    group.append(Piece(*place, raw, classes))
                of, last = key, now
        if group:
            yield group

    def rows(out: list[Found]) -> pa.RecordBatch:
        ranges = [(p.doc, p.ver, a, b, None, None, None) for p, a, b in out]
        for p, a, b in out:
            if p.classes:
                of = np.frombuffer(p.classes, np.int64).reshape(-1, 3)
                both = np.minimum(of[:, 1] + of[:, 2], b + 1) - np.maximum(of[:, 1], a)
                ranges += [(None, None, None, None, c, f, n) for c, f, n in zip(of[:, 0].tolist(), both.tolist(), of[:, 2].tolist(), strict=True) if f > 0]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*ranges, strict=True) if ranges else [[]] * 7)], [x.split()[0] for x in ANSWER.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[Found] = []
        for one in resolve(groups(batches)):
            out.append(one)
            if len(out) >= 20_000:
                yield rows(out)
                out = []
        yield rows(out)

    return run


def identified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents as doc_id, ver, text; (doc_id, ver) of copies of whole documents with a smaller doc_id).

    ``ver`` is 0, but for a doc_id that comes with several texts a hash of the text: these are documents of their own.
    """
    docs = with_id(docs, F.coalesce("text", F.lit("")).alias("text"))
    hashes = [F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2")]
    ident = written(docs.select("doc_id", *hashes), "repeats-texts")
    several = written(ident.groupBy("doc_id").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select(F.col("doc_id").alias("several")), "repeats-several")
    ver = F.lit(0).cast("long")
    if not several.isEmpty():
        several, ver = broadcast_if_small(several), F.when(F.col("several").isNotNull(), F.col("h1")).otherwise(0)
        docs = docs.withColumn("h1", hashes[0]).join(several, F.col("doc_id") == F.col("several"), "left")
        ident = ident.join(several, F.col("doc_id") == F.col("several"), "left")
    classes = written(ident.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("h1", "h2", "first"), "repeats-classes")
    copies = ident.withColumn("ver", ver).join(broadcast_if_small(classes), ["h1", "h2"]).where("doc_id > first")
    return docs.select("doc_id", ver.alias("ver"), "text"), written(copies.select("doc_id", "ver").distinct(), "repeats-copies")


def repeated_ranges(docs: DataFrame, copies: DataFrame, kind: Kind, resolve: Resolver) -> DataFrame:
    """(doc_id, ver, lo, hi): ranges of window starts whose windows also start earlier; a copy as a whole has lo 0, hi WHOLE.

    ``resolve`` gets the pieces that a key asked for, each key as a list by document and start, and returns what is repeated.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    once = docs.join(broadcast_if_small(copies), ["doc_id", "ver"], "left_anti").select("doc_id", "ver", "text")
    counts = summed_counters(once.select("text").mapInArrow(_counts(kind), "chunk int, counts binary"), WIDTH)
    levels = spark.sparkContext.broadcast(_levels(counts, kind.some, kind.many))

    def decided(rows: DataFrame) -> DataFrame:
        rows = rows.repartition("route").sortWithinPartitions("key", "content", "doc", "ver", "lo")
        return written(rows.mapInArrow(_decide(kind.contents), DECIDED), "repeats")

    def with_asks(asks: DataFrame) -> DataFrame:
        few = asks.limit(ASKS + 1).count() <= ASKS
        asks = asks.groupBy(F.col("doc").alias("doc_id"), "ver").agg(F.collect_list(F.struct("lo", "hi", "key", "cls", "second")).alias("asks"))
        return docs.join(F.broadcast(asks) if few else asks, ["doc_id", "ver"]).select("doc_id", "ver", "text", "asks")

    found = decided(once.mapInArrow(_keys(kind, levels), ROUTED))
    again = found.where(F.col("what") == SPLIT)
    if not again.isEmpty():
        found = found.unionByName(decided(with_asks(again).mapInArrow(_windows(kind), ROUTED)))
    pieces = with_asks(found.where(F.col("what") == ASK)).mapInArrow(_cut(kind), "key long, doc long, ver long, lo long, n long, piece binary, classes binary")
    answers = pieces.repartition("key").sortWithinPartitions("key", "doc", "ver", "lo", "classes").mapInArrow(_answers(resolve), ANSWER)
    answers = written(answers, "repeats-answers")
    sure = answers.where("cls is not null").groupBy("cls").agg(F.sum("found").alias("found"), F.max("windows").alias("windows"))
    sure = written(sure.where("found >= windows").select("cls"), "repeats-classes")
    followers = found.where(F.col("what") == FOLLOW).join(broadcast_if_small(sure), "cls", "left_semi")
    place = [F.col("doc").alias("doc_id"), "ver", "lo", "hi"]
    whole = copies.select("doc_id", "ver", F.lit(0).cast("long").alias("lo"), F.lit(WHOLE).cast("long").alias("hi"))
    return answers.where("doc is not null").select(*place).unionByName(followers.select(*place)).unionByName(whole)


def flagged(piece: Piece, flags: np.ndarray) -> Iterator[Found]:
    """Ranges of set flags of a piece's windows."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        yield piece, piece.lo + int(a), piece.lo + int(b) - 1


def remove(docs: DataFrame, kind: Kind, resolve: Resolver, cut: Callable, schema: str) -> DataFrame:
    """Finds repeated windows and joins them to the documents; ``cut(raw bytes, lows, highs)`` gives the columns of ``schema`` after doc_id."""
    docs, copies = identified(docs)
    ranges = repeated_ranges(docs, copies, kind, resolve)
    ranges = ranges.groupBy("doc_id", "ver").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    names = [x.split()[0] for x in schema.split(",")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[x.split()[1]] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, lows, highs = (batch.column(i) for i in range(4))
            out = []
            for r in range(batch.num_rows):
                lo, hi = (x[r].values.to_numpy() if x[r].is_valid else None for x in (lows, highs))
                out.append(cut((texts[r].as_py() or "").encode(), lo, hi))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))], ["doc_id", *names])

    return docs.join(ranges, ["doc_id", "ver"], "left").select("doc_id", "text", "lo", "hi").mapInArrow(run, f"doc_id long, {schema}")


def covered(n: int, lows: np.ndarray | None, highs: np.ndarray | None, window: int) -> np.ndarray:
    """Which of n symbols lie in a window that starts in one of the ranges."""
    if lows is None or not len(lows) or n < window:
        return np.zeros(n, bool)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.minimum(lows, n), 1)
    np.add.at(step, np.minimum(highs + window, n), -1)
    return np.cumsum(step[:-1]) > 0
