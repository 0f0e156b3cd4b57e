"""Exact top-k inner products over a bit-sliced index.

Every component of a vector is quantised to floor(scale * x). A block of the index holds, for each component and each
bit, one bitmap over its rows. A query adds the slices of |q_d| * v_d with bitmap arithmetic (carry-save adders over
bitmaps of equal weight), which leaves the scores of all rows of the block as bit slices, and selects its best rows from
the most significant slice downward: rows that are certainly above the boundary, and rows still equal to it. The rows
left at the boundary are resolved exactly: equal scores, smallest id first. Queries are a stated set against all rows, so
they are dealt in groups, and each block meets each group once.

Slices have no largest width: vectors are dealt to blocks by the bits of their components and by their length (powers of
two), so a huge component or a long vector widens its own blocks only, and a block holds a bounded number of components.
Scores are whole numbers of any size throughout; ``score`` shows one beyond a long as the nearest long, ranks use it whole.

Defined cases: a vector that is null, or holds null or non-finite components, takes no part; shorter vectors count as
padded with zeros; repeated ids are rows of their own, as queries too (each has its ranks), but a query never meets a row
with its own id; fewer rows than k give them all; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import bound_arrow_batches, written

#: Rows of a block of the index (of vectors of 64 components; fewer of longer ones) and queries of a group, about.
BLOCK_ROWS, GROUP_ROWS = 50_000, 256
#: Bits of sums that are still added up in 64-bit numbers, and the longs.
PLAIN, LOW, HIGH = 62, -(1 << 63), (1 << 63) - 1


def whole_numbers(x, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, as 64-bit numbers, or as Python's if one is too large for that."""
    x = np.asarray(x, np.float64)
    if not len(x) or np.abs(x).max() * scale < 2.0**PLAIN:
        return np.floor(x * scale).astype(np.int64)
    return np.array([math.floor(Fraction(c) * scale) for c in x.tolist()], object)


def _width(v: np.ndarray) -> int:
    """Bits that the numbers need in two's complement."""
    return int(max(v.max(initial=0), -1 - v.min(initial=0))).bit_length() + 1


def _block(scale: int, pdf: pd.DataFrame) -> pd.DataFrame:
    """One block: rows by id; its slices as bitmaps [component, bit, word]."""
    pdf = pdf.sort_values("id", kind="stable")
    ids = pdf["id"].to_numpy(np.int64)
    rows = [whole_numbers(x, scale) for x in pdf["v"]]
    size, words = max(map(len, rows)), -(-len(ids) // 64)
    v = np.zeros((size, words * 64), object if any(x.dtype == object for x in rows) else np.int64)
    for i, x in enumerate(rows):
        v[: len(x), i] = x
    width = _width(v)
    v[:, : len(ids)] += 1 << (width - 1)  # not negative
    slices = np.empty((size, width, words * 8), np.uint8)
    for j in range(width):
        slices[:, j] = np.packbits((v >> j & 1).astype(np.uint8), axis=-1, bitorder="little")
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "ids": [ids.tobytes()], "size": [size], "width": [width], "slices": [slices.tobytes()]})


def sort_key(score: int) -> bytes:
    """Bytes in the order of the scores: sign and number of bytes, then the bytes (of a negative one, how far it is above the least)."""
    n = (abs(score).bit_length() + 7) // 8
    return ((1 << 15) + n).to_bytes(2) + score.to_bytes(n) if score >= 0 else ((1 << 15) - n).to_bytes(2) + ((1 << 8 * n) - 1 + score).to_bytes(n)


def _sum_slices(levels: list[list[np.ndarray]]) -> list[np.ndarray | None]:
    """Carry-save addition: levels[w] are bitmaps of weight 2**w; one bitmap (or None) for each bit of the sums."""
    out: list[np.ndarray | None] = []
    w = 0
    while w < len(levels):
        todo = levels[w]
        if len(todo) > 1 and w + 1 == len(levels):
            levels.append([])
        while len(todo) >= 3:
            a, b, c = todo.pop(), todo.pop(), todo.pop()
            x = a ^ b
            levels[w + 1].append((a & b) | (x & c))
            x ^= c
            todo.insert(0, x)
        if len(todo) == 2:
            a, b = todo
            levels[w + 1].append(a & b)
            todo[:] = [a ^ b]
        out.append(todo[0] if todo else None)
        w += 1
    return out


def _search(ids: np.ndarray, slices: np.ndarray, width: int, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the k best rows of a block for one query; its own id is left out."""
    size, _, words = slices.shape
    top, shift, levels = (1 << width) - 1, 0, []
    for d in range(min(size, len(query))):
        q = int(query[d])
        shift -= q << (width - 1)
        if q < 0:
            shift -= -q * top  # -|q| * v is |q| * (top - v) - |q| * top
        for j in range(abs(q).bit_length()):
            if abs(q) >> j & 1:
                while len(levels) < j + width:
                    levels.append([])
                for i in range(width):
                    levels[i + j].append(slices[d, i] if q > 0 else ~slices[d, i])
    sums = _sum_slices(levels)
    equal = np.zeros(words * 64, np.uint8)
    equal[: len(ids)] = 1
    lo, hi = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
    equal[lo:hi] = 0
    equal = np.packbits(equal, bitorder="little").view(np.uint64)
    above, n = np.zeros(words, np.uint64), 0
    for s in reversed(sums):
        if s is None:
            continue
        x = equal & s
        m = int(np.bitwise_count(x).sum())
        if n + m > k:
            equal = x
        else:
            above |= x
            n += m
            equal = equal & ~s
            if n == k:
                break
    bit = lambda b: np.flatnonzero(np.unpackbits(b.view(np.uint8), bitorder="little"))
    rows = np.concatenate((bit(above), bit(equal)[: k - n]))
    scores = np.full(len(rows), shift, np.int64 if len(sums) <= PLAIN and abs(shift) < 1 << PLAIN else object)
    for w, s in enumerate(sums):
        if s is not None:
            bits = (s[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            scores += (bits if scores.dtype == np.int64 else bits.astype(object)) << w
    return rows, scores


def _cells(k: int, scale: int):
    names = ["query", "query_id", "vec_id", "score", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                cell = {n: batch.column(i)[r].as_py() for i, n in enumerate(batch.schema.names)}
                ids = np.frombuffer(cell["ids"], np.int64)
                slices = np.frombuffer(cell["slices"], np.uint64).reshape(cell["size"], cell["width"], -1)
                out = ([], [], [], [], [])
                for number, q in enumerate(cell["queries"]):
                    rows, scores = _search(ids, slices, cell["width"], whole_numbers(q["v"], scale), q["id"], k)
                    scores = [int(x) for x in scores]
                    found = ([cell["part"] << 32 | number] * len(rows), [q["id"]] * len(rows), ids[rows], [min(max(x, LOW), HIGH) for x in scores], map(sort_key, scores))
                    for x, got in zip(out, found, strict=True):
                        x.extend(got)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:4]), pa.array(out[4], pa.binary())], names)

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every``, the k highest integer inner products."""
    bound_arrow_batches(vectors.sparkSession)
    x = F.col("embedding")
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    whole = vectors.where("vec_id is not null").where(fine).select(F.col("vec_id").cast("long").alias("id"), F.transform(x, lambda c: c.cast("double")).alias("v"))
    largest = F.coalesce(F.array_max(F.transform("v", lambda c: F.abs(c))), F.lit(0.0))
    bits, long = F.ceil(F.log2(largest + 1) / 16), F.ceil(F.log2(F.greatest(F.size("v"), F.lit(64)).cast("double")))
    whole = whole.withColumn("class", (bits * 64 + long).cast("int"))
    is_query = F.col("id") % every == 0
    kinds = sorted(tuple(r) for r in whole.groupBy("class").agg(F.count("*"), F.count_if(is_query)).collect())  # a row for each power of two, some hundreds at most
    blocks_of, blocks, m = {}, 0, sum(r[2] for r in kinds)
    for kind, n, _ in kinds:
        own = -(-n // max(1, block_rows * 64 // ((1 << kind % 64) * max(1, kind // 64))))
        blocks_of[kind] = (blocks, own)
        blocks += own
    groups = max(1, -(-m // group_rows))
    if not blocks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    at = F.create_map(*[F.lit(x) for kind, (first, own) in blocks_of.items() for x in (kind, f"{first} {own}")])
    place = F.split(F.element_at(at, F.col("class")), " ")
    index = whole.withColumn("block", (place[0].cast("int") + F.pmod(F.xxhash64("id"), place[1].cast("int"))).cast("int"))
    index = written(index.groupBy("block").applyInPandas(lambda pdf: _block(scale, pdf), "block int, ids binary, size int, width int, slices binary"), "bit-slices")
    queries = whole.where(is_query).withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("long"))
    queries = written(queries.groupBy("part").agg(F.collect_list(F.struct("id", "v")).alias("queries")), "top-k-queries")  # a query is known by its place there
    cells = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))).repartition(min(blocks * groups, 100_000), "block", "part")
    asked = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(min(blocks * groups, 100_000), "block", "part")
    found = cells.join(asked.hint("merge"), ["block", "part"]).select("part", "ids", "size", "width", "slices", "queries")
    found = found.mapInArrow(_cells(k, scale), "query long, query_id long, vec_id long, score long, place binary")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("place"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
           where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id, cast(list_inner_product(list_transform(a.e, lambda x: cast(x as double)), list_transform(b.e, lambda x: cast(x as double))) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
"""
