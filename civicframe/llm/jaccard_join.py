"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct shingles (hashes of consecutive words). Documents with equal sets are one class, and
only classes are joined. Tokens are ordered by an estimate of their document frequency, rare ones first. If two sets
share t tokens, then the first |set| - t + l tokens of each share at least l (the l-prefix). Every class takes the l for
which the estimated cost is least: reading the posting lists of its prefix, and verifying the candidates, of which a
longer prefix with l required matches leaves fewer.

Posting lists are dealt by token. A short list gives its pairs, by slices of all pairs, and pairs that share enough such tokens are verified: at
least l, and more for sets of similar size, since beyond a prefix of p tokens a set can share |set| - p at most. A pair
that shares a token with a long list is found among the members of long lists: each deals its set into more parts than
two linked sets have differences, so that linked sets have a part in common as a whole. Members of equal parts are listed
anew. Strangers that only share frequent tokens part there, so the lists of parts grow with copies, not with the corpus.

Before their sets are read, pairs are held against their parities, a bit for each of about |set| classes of tokens: sets
whose parities differ in more bits than linked sets have differences aren't linked.

Members of long lists of parts that share members form a group; its members are dealt into blocks of bounded size. First
each block, with the member of most lists beside it, is compared in one task, which counts all common tokens of its sets by products of 0/1 matrices and returns one link for each member at
most; in a group of near copies that makes one component of nearly all. Then the members outside the group's largest
component meet all its blocks: two members of one component need no comparison. So a group of near copies costs a few rows
for each member, never a row for each pair, no task holds more than two blocks, and no pair is left out.

Document frequencies: each task counts its tokens in a table of fixed size (WIDTH counters); the sums are exact for the
counters, over all documents, and serve only for order and costs. Of the prefixes that this order gives, tokens with
long lists are counted exactly, marked in a bitmap of fixed size (MARKS bits), and moved to the end of the order, before
the lists are made; a token that shares its mark with one goes there too, which is as good an order as any.

Defined cases: without words the set is empty and linked with nothing; fewer words than a shingle are one shingle; rows
that repeat a doc_id with its text are one document with a row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import BYTES, LOWER, Spans, bound_arrow_batches, broadcast_if_small, counter_rows, discard, mix, summed_counters, tables, text_parts, with_id, words_of, written
from civicframe.llm.components import components

#: Counters for document frequencies; longest posting list that gives pairs; most required matches.
WIDTH, SHORT, MOST = 1 << 21, 8, 4
#: Pairs of short lists that are on disk at once, at least (more if there are many classes: 8 for each).
PAIRS = 1 << 22
#: Bits of the marks of tokens with long lists, and of a row of them.
MARKS, MARKS_ROW = 1 << 26, 1 << 17
#: Tokens and members of a block, about, and columns of a matrix.
BLOCK, MEMBERS, COLUMNS = 1 << 18, 500, 4096
#: Most empty parts, as expected for the smallest sets of a level, that are told apart by a second dealing.
CROSSED = 16
#: Bits of a set's parities, at least and at most.
LEAST_BITS, MOST_BITS = 1 << 6, 1 << 15
#: Cost of verifying a candidate, in postings read.
VERIFY = 20.0


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 64-bit shingle hashes) of each text; A-Z count as lower case."""
    for i, j, raw, offsets in text_parts(column):
        raw = LOWER[raw]
        starts, ends, first = words_of(raw, offsets)
        h = Spans(BYTES[raw])(starts, ends)
        spans = Spans(h)
        for r in range(i, j):
            a, b = first[r - i], first[r - i + 1]
            n = b - a
            if n <= 0:
                yield r, np.zeros(0, np.uint64)
            elif n < words:
                yield r, mix(spans(np.array([a]), np.array([b])) + np.uint64(n))
            else:
                at = np.arange(a, b - words + 1)
                yield r, np.unique(spans(at, at + words))


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    at = np.arange(1, len(tokens) + 1, dtype=np.uint64)
    out = [int((mix(tokens * c + at)).sum(dtype=np.uint64).view(np.int64)) for c in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))]
    return out[0], out[1]


@cache
def _levels(percent: int, bits: int) -> np.ndarray:
    """Smallest sizes of the levels, over all sizes of so many bits. A set links only within its level and with the next ones."""
    starts = [1]
    while starts[-1] < 1 << bits:
        starts.append(100 * starts[-1] // percent + 1)
    return np.array([*starts, 100 * starts[-1] // percent + 1])


def _differences(sizes: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Most tokens that two linked sets of these sizes together don't share."""
    return (100 - percent) * sizes // (100 + percent)


def _dealt(hashes: np.ndarray, parts: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each part of a set, and which parts are empty."""
    h = mix(hashes + np.uint64(salt))
    part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(part)
    at = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    sums = np.append(np.uint64(0), np.cumsum(mix(h[order]), dtype=np.uint64))
    return mix(sums[at[1:]] - sums[at[:-1]] + mix(np.arange(1, parts + 1, dtype=np.uint64) + np.uint64(salt))), at[1:] == at[:-1]


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """64-bit keys of a set's parts: linked sets (that aren't equal) have one in common.

    A pair meets in the larger one's level, so each set is dealt for its own level and for the next one, into one part more
    than two sets of that level can have differences. An empty part says little, so it has a key with each part of a second
    dealing, but for levels of so many parts that these keys would be more than CROSSED times the parts.
    """
    n, out = len(tokens), []
    starts = _levels(percent, n.bit_length() + 1)
    own = int(np.searchsorted(starts, n, side="right")) - 1
    for level in (own, own + 1):
        parts = int(_differences(2 * (100 * int(starts[level]) // percent), percent)) + 1
        if parts == 1:  # only equal sets link
            continue
        keys, empty = _dealt(tokens, parts, 2 * level + 1)
        if parts * np.exp(-float(starts[level - 1]) / parts) > CROSSED:  # of the level alone, so that both sets do the same
            out.append(keys)
            continue
        out.append(keys[~empty])
        if empty.any():
            again, _ = _dealt(tokens, parts, 2 * level + 2)
            out.append(mix(keys[empty][:, None] * np.uint64(3) + again[None, :]).ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parities(tokens: np.ndarray) -> bytes:
    """Whether each of a power of two of classes holds an odd number of a set's tokens."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (len(tokens) - 1).bit_length()))
    place = (mix(tokens + np.uint64(1)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").tobytes()


def _least(n: int, percent: int) -> int:
    """Tokens that a set of n shares with any set it links with."""
    return -(-percent * n // 100)


def _summary(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(WIDTH, np.uint32)
        names = ["doc", "n", "c1", "c2", "parities", "chunk", "counts"]
        for batch in batches:
            rows, bits, held, size = [], [], [], 0
            for _, tokens in shingle_sets(batch.column(1), words):
                rows.append((len(tokens), *fingerprint(tokens)))
                bits.append(parities(tokens) if len(tokens) else None)
                held.append(tokens)
                size += len(tokens)
                if size > 1 << 20:
                    counts += np.bincount((np.concatenate(held) & np.uint64(WIDTH - 1)).astype(np.int64), minlength=WIDTH).astype(np.uint32)
                    held, size = [], 0
            if held:
                counts += np.bincount((np.concatenate(held) & np.uint64(WIDTH - 1)).astype(np.int64), minlength=WIDTH).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in rows], pa.int64()) for i in range(3)), pa.array(bits, pa.binary()), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], names)
        chunks, parts = counter_rows(counts)
        none = pa.nulls(len(chunks), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(chunks), pa.binary()), pa.array(chunks, pa.int32()), pa.array(parts, pa.binary())], names)

    return run


def prefix(tokens: np.ndarray, often: np.ndarray, percent: int, last: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """(tokens of the adaptive prefix, required matches). ``last``: which tokens come after all others."""
    n = len(tokens)
    order = np.lexsort((tokens, often) if last is None else (tokens, often, last))
    least = _least(n, percent)
    best, most = None, min(MOST, least)
    cost = np.cumsum(often[order].astype(float))
    for need in range(1, most + 1):
        read = cost[n - least + need - 1]
        c = read + VERIFY * read / need
        if best is None or c < best[0]:
            best = (c, need)
    need = best[1]
    return tokens[order[: n - least + need]], need


def _postings(words: int, percent: int, counts, common=None):
    """common: a broadcast of the marks of tokens that are known to have long lists; they come last in the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        base = int(np.median(table))  # what other tokens add to a counter
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for _, tokens in shingle_sets(batch.column(1), words):
                c = fingerprint(tokens)
                if not len(tokens) or c in seen:
                    continue
                seen.add(c)
                often = np.maximum(table[(tokens & np.uint64(WIDTH - 1)).astype(np.int64)] - base, 1)
                last = None
                if common is not None:
                    last = is_marked(common.value, tokens)
                first, _ = prefix(tokens, often, percent, last)
                for x, y in zip(out, (first.view(np.int64), c[0], c[1], len(tokens), len(tokens) - len(first)), strict=True):
                    x.append(y if isinstance(y, np.ndarray) else np.full(len(first), y, np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["token", "c1", "c2", "n", "beyond"])

    return run


def _signed(words: int, percent: int):
    """Postings of the parts of sets. What a pair shares beyond a part isn't known, so it needs no more of them than one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for _, tokens in shingle_sets(batch.column(1), words):
                c = fingerprint(tokens)
                if not len(tokens) or c in seen:
                    continue
                seen.add(c)
                keys = signatures(tokens, percent)
                for x, y in zip(out, (keys.view(np.int64), c[0], c[1], len(tokens), len(tokens)), strict=True):
                    x.append(y if isinstance(y, np.ndarray) else np.full(len(keys), y, np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["token", "c1", "c2", "n", "beyond"])

    return run


def _near(percent: int):
    """Pairs whose parities don't differ in more bits than linked sets have differences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(4), batch.column(5)
            long = [np.array(c.to_numpy(zero_copy_only=False), object) for c in (x, y)]
            wide = [pc.binary_length(c).to_numpy() for c in (x, y)]
            most = _differences(batch.column(2).to_numpy() + batch.column(3).to_numpy(), percent)
            keep = np.zeros(batch.num_rows, bool)
            for a, b in {*zip(*(w.tolist() for w in wide), strict=True)}:
                rows = np.flatnonzero((wide[0] == a) & (wide[1] == b))
                least = min(a, b)
                folded = [np.bitwise_xor.reduce(np.frombuffer(b"".join(c[rows]), np.uint8).reshape(len(rows), -1, least), axis=1) for c in long]
                keep[rows] = np.bitwise_count(folded[0] ^ folded[1]).sum(1, dtype=np.int64) <= most[rows]
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _fitting(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can link."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _pairs(percent: int, slices: int, this: int):
    """Short lists -> their pairs that a hash of the two classes puts into a slice."""
    names = ["a1", "a2", "an", "b1", "b2", "bn", "beyond"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(size)), size)
            c1, c2, n, beyond = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in range(4))
            for gap in range(1, int(size.max(initial=1))):
                i = np.flatnonzero(of[gap:] == of[:-gap])
                i = i[_fitting(n[i], n[i + gap], percent)]
                j = i + gap
                mine = mix(c1[i].view(np.uint64) * np.uint64(3) + c1[j].view(np.uint64)) % np.uint64(slices) == this
                i, j = i[mine], j[mine]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (c1[i], c2[i], n[i], c1[j], c2[j], n[j], np.maximum(beyond[i], beyond[j]))], names)

    return run


def _lists(percent: int, short: int):
    """Sorted postings -> short lists that have pairs of fitting sizes (a row each: their number, members), members of long lists (token, one member a row)."""
    names = ["token", "pairs", "c1", "c2", "n", "beyond"]

    def emit(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, c1, c2, n, beyond = rows
        if not len(token):
            return
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
        token, c1, c2, n, beyond = (x[fresh] for x in rows)  # a class once
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        at = np.flatnonzero(new)
        size = np.repeat(np.diff(np.append(at, len(token))), np.diff(np.append(at, len(token))))
        pairs, paired = np.zeros(len(token), np.int64), np.zeros(len(token), bool)
        for gap in range(1, short):
            i = np.flatnonzero((token[gap:] == token[:-gap]) & (size[gap:] <= short))
            i = i[_fitting(n[i], n[i + gap], percent)]
            pairs[i] += 1
            paired[i] = paired[i + gap] = True
        for some, long in ((np.flatnonzero(paired), False), (np.flatnonzero(size > short), True)):
            if len(some):
                begin = np.arange(len(some)) if long else np.flatnonzero(np.append(True, token[some[1:]] != token[some[:-1]]))
                offsets = pa.array(np.append(begin, len(some)), pa.int32())
                number = pa.nulls(len(begin), pa.int64()) if long else pa.array(np.add.reduceat(pairs[some], begin))
                yield pa.RecordBatch.from_arrays([pa.array(token[some]) if long else pa.nulls(len(begin), pa.int64()), number, *(pa.ListArray.from_arrays(offsets, pa.array(x[some])) for x in (c1, c2, n, beyond))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            cut = int(np.count_nonzero(rows[0] != rows[0][-1])) if len(rows[0]) else 0
            yield from emit([x[:cut] for x in rows])
            rest = [x[cut:] for x in rows]
        if rest is not None:
            yield from emit(rest)

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            left, right = batch.column(2), batch.column(3)
            keep = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                x, y = left[r].values.to_numpy(), right[r].values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[r] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], ["a", "b"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            held, size = [], 0
            for r, tokens in shingle_sets(batch.column(1), words):
                held.append((ids[r], tokens.view(np.int64)))
                size += len(tokens)
                if size > 1 << 19 or r + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in held], pa.int64()), pa.array([x for _, x in held], pa.list_(pa.int64()))], ["id", "tokens"])
                    held, size = [], 0

    return run


def spanning_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest place in its component) for the linked ones among some sets, all pairs counted."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = counts > 1
    place = np.cumsum(often) - 1
    keep = often[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), np.float32)
    for at in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        both += part @ part.T
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    label = np.arange(n)
    while True:
        least = np.where(linked, label[None, :], n).min(1)
        least = np.minimum(least, label)
        least = least[least]
        if (least == label).all():
            return ids, ids[label]
        label = least


def _cell(percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids, lists = table.column("id").to_numpy(), table.column("tokens").combine_chunks()
        values, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        a, b = spanning_links(ids, [values[i:j] for i, j in zip(at, at[1:], strict=False)], percent)
        return pa.table({"a": pa.array(a[a != b], pa.int64()), "b": pa.array(b[a != b], pa.int64())})

    return run


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: dict[int, np.ndarray] = {}
    for batch in batches:
        row, bit = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        order = np.argsort(row, kind="stable")
        row, bit = row[order], bit[order]
        at = np.flatnonzero(np.diff(row, prepend=-1))
        for i, j in zip(at, [*at[1:], len(row)], strict=True):
            rows.setdefault(int(row[i]), np.zeros(MARKS_ROW, bool))[bit[i:j]] = True
    yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in rows.values()], pa.binary())], ["row", "bits"])


def marks(tokens: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the last bits of tokens."""
    at = F.col("token").bitwiseAND(MARKS - 1)
    rows = tokens.select(F.shiftright(at, MARKS_ROW.bit_length() - 1).cast("int").alias("row"), at.bitwiseAND(MARKS_ROW - 1).cast("int").alias("bit"))
    out = np.zeros(MARKS // 8, np.uint8)
    for r in rows.repartition("row").mapInArrow(_marked, "row int, bits binary").collect():  # MARKS / MARKS_ROW rows
        out[r["row"] * MARKS_ROW // 8 : (r["row"] + 1) * MARKS_ROW // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def is_marked(bitmap: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = (tokens & np.uint64(MARKS - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7) & 1).astype(bool)


def block_links(members: DataFrame, sets: DataFrame, percent: int, block_tokens: int, block_members: int = MEMBERS) -> DataFrame:
    """Links (a, b), enough for the components, among members (token, id, n) of lists whose pairs aren't listed."""
    first = members.groupBy("token").agg(F.min("id").alias("b"))
    groups = components(members.join(first, "token").select(F.col("id").alias("a"), "b"))
    about = members.groupBy(F.col("id").alias("node")).agg(F.max("n").alias("n"), F.count("*").alias("lists"))
    groups = written(groups.join(about, "node").select(F.col("node").alias("id"), "label", "n", "lists"), "jaccard-groups")
    blocks = F.ceil(F.greatest(F.sum("n") / block_tokens, F.count("*") / block_members)).cast("int").alias("blocks")
    place = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")

    def linked(dealt: DataFrame, name: str) -> DataFrame:
        """``dealt``: id, label, cells (the cells of its group that it is in)"""
        cells = sets.join(dealt, "id").select("label", F.explode("cells").alias("cell"), "id", "tokens")
        return written(cells.groupBy("label", "cell").applyInArrow(_cell(percent), "a long, b long"), name)

    size = groups.groupBy("label").agg(blocks, F.max_by("id", F.struct("lists", -F.col("id"))).alias("central"))
    dealt = written(groups.join(size, "label").withColumn("mine", place("blocks")), "jaccard-blocks")
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    within = linked(dealt.select("id", "label", F.when(F.col("id") == F.col("central"), everywhere).otherwise(F.array("mine")).alias("cells")), "jaccard-links")
    large = dealt.where("blocks > 1")
    if large.isEmpty():
        return within
    parts = components(within).select(F.col("node").alias("id"), F.col("label").alias("part"))
    large = large.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
    large = written(large, "jaccard-parts")
    main = large.groupBy("label", "part").agg(F.count("*").alias("its")).groupBy("label").agg(F.max_by("part", F.struct("its", "part")).alias("main"))
    rest = written(large.join(main, "label").where("part <> main").select("id", "label", "n", "blocks"), "jaccard-rest")
    if rest.isEmpty():
        return within
    own = rest.groupBy("label").agg(blocks.alias("others"))
    # a cell is a block of the rest beside a block of all; who is of the rest is in both
    asked = large.join(own, "label").join(rest.select("id", F.lit(True).alias("resting")), "id", "left")
    as_one_of_all = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda j: j * F.col("blocks") + F.col("mine"))
    as_rest = F.when(F.col("resting"), F.transform(everywhere, lambda i: place("others") * F.col("blocks") + i)).otherwise(F.array().cast("array<int>"))
    return within.unionByName(linked(asked.select("id", "label", F.array_union(as_one_of_all, as_rest).alias("cells")), "jaccard-links"))


def similarity_classes(docs: DataFrame, words: int = 3, percent: int = 90, longest: int = SHORT, block_tokens: int = BLOCK, block_members: int = MEMBERS, slice_pairs: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id it reaches over links with Jaccard >= percent / 100).

    ``longest``: members of a posting list that gives its pairs; ``block_tokens``: tokens of a block of longer ones, about;
    ``slice_pairs``: pairs of short lists that are on disk at once, about.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    docs = with_id(docs, "text")
    mark = tables()
    summary = written(docs.mapInArrow(_summary(words), "doc long, n long, c1 long, c2 long, parities binary, chunk int, counts binary"), "jaccard-summary")
    rows = summary.where("doc is not null").select("doc", "n", "c1", "c2")
    about = F.struct(F.col("doc").alias("id"), "n", "parities")  # of equal sets the smallest document counts
    classes = written(summary.where("doc is not null and n > 0").groupBy("c1", "c2").agg(F.min(about).alias("of")).select("c1", "c2", "of.*"), "jaccard-classes")
    counts = spark.sparkContext.broadcast(summed_counters(summary.where("chunk is not null").select("chunk", "counts"), WIDTH))
    # tokens whose lists turn out long, though their counters don't tell, go to the end of the order; only costs depend on it
    posting = "token long, c1 long, c2 long, n long, beyond long"
    posted = docs.mapInArrow(_postings(words, percent, counts), posting)
    common = spark.sparkContext.broadcast(marks(posted.groupBy("token").agg(F.count("*").alias("size")).where(F.col("size") > longest).select("token")))
    named = lambda p: classes.select(F.col("c1").alias(f"{p}1"), F.col("c2").alias(f"{p}2"), F.col("id").alias(p), F.col("parities").alias(f"{p}_parities"))

    def listed(postings: DataFrame) -> DataFrame:
        sorted_ = postings.repartition("token").sortWithinPartitions("token", "c1", "c2")
        return written(sorted_.mapInArrow(_lists(percent, longest), "token long, pairs long, c1 array<long>, c2 array<long>, n array<long>, beyond array<long>"), "jaccard-lists")

    def members(lists: DataFrame) -> DataFrame:
        return lists.where("token is not null").select("token", F.col("c1")[0].alias("a1"), F.col("c2")[0].alias("a2"), F.col("n")[0].alias("n"))

    lists = listed(docs.mapInArrow(_postings(words, percent, counts, common), posting))
    often = written(members(lists).select("a1", "a2").distinct().join(named("a"), ["a1", "a2"]).select(F.col("a").alias("doc_id")), "jaccard-often")
    parts = listed(docs.join(broadcast_if_small(often), "doc_id", "left_semi").mapInArrow(_signed(words, percent), posting))
    # pairs are made, counted and dropped a slice at a time, so the disk holds a number of them in proportion to the classes
    some, found = lists.unionByName(parts).where("token is null").select("pairs", "c1", "c2", "n", "beyond"), []
    slices = max(1, -(-(some.agg(F.sum("pairs")).first()[0] or 0) // (slice_pairs or max(PAIRS, 8 * classes.count()))))
    for this in range(slices):
        short = some.drop("pairs").mapInArrow(_pairs(percent, slices, this), "a1 long, a2 long, an long, b1 long, b2 long, bn long, beyond long")
        short = short.groupBy("a1", "a2", "b1", "b2").agg(F.count("*").alias("shared"), F.max("beyond").alias("beyond"), F.max("an").alias("an"), F.max("bn").alias("bn"))
        # a pair shares at most ``beyond`` tokens after its prefixes, so the rest of what it needs must be in them
        short = short.where(F.col("shared") >= F.ceil(percent * (F.col("an") + F.col("bn")) / (100.0 + percent) - 1e-9) - F.col("beyond"))
        short = short.join(named("a"), ["a1", "a2"]).join(named("b"), ["b1", "b2"]).select("a", "b", "an", "bn", "a_parities", "b_parities")
        found.append(written(short.mapInArrow(_near(percent), "a long, b long"), "jaccard-candidates"))
    short = reduce(DataFrame.unionByName, found)
    long = written(members(parts).join(named("a"), ["a1", "a2"]).select("token", F.col("a").alias("id"), "n"), "jaccard-long")
    discard(spark, mark, summary, classes, long, *found)
    wanted = short.select(F.col("a").alias("doc_id")).union(short.select("b")).union(long.select("id")).distinct()
    sets = written(docs.join(broadcast_if_small(written(wanted, "jaccard-wanted")), "doc_id", "left_semi").mapInArrow(_sets(words), "id long, tokens array<long>"), "jaccard-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        left = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
        return written(left.join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long"), "jaccard-links")

    labels = components(verified(short).unionByName(block_links(long, sets, percent, block_tokens, block_members)))
    owner = classes.join(labels.withColumnRenamed("node", "id"), "id", "left").select("c1", "c2", F.coalesce("label", "id").alias("label"))
    return rows.join(owner, ["c1", "c2"], "left").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("label", "doc").alias("component_id"))
