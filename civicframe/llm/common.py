"""Shared plumbing of the corpus operators: tables in the shared folder, size-checked broadcasts, byte-level text arrays.

Conventions that hold for every operator of this subpackage:

* A document is identified by ``doc_id``; rows without one take no part. Other columns than those an operator
  names are ignored, whatever they are called.
* Words are maximal runs of characters other than ``\\x20`` and ``\\x09-\\x0D``, which is how ``bytes.split()`` cuts.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.session import ship

#: Most rows that a size-checked broadcast sends: ids of 8 bytes and a few numbers, some tens of MB at the very most.
BROADCAST_ROWS = 500_000

#: Setting: shuffle files are removed at the end of each query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Environment of workers: arrays of 8 MB or more go back to the system as soon as they are freed.
MALLOC = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": str(8 << 20), "MALLOC_MMAP_THRESHOLD_": str(8 << 20)}
#: Counters of a row of a table of counters.
CHUNK = 1 << 14

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Odd base of the polynomial hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session without one gets a fresh folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="civicframe-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


#: Paths of the tables that were written and not discarded, in order.
_TABLES: list[str] = []


def tables() -> int:
    """A mark: how many tables stand so far."""
    return len(_TABLES)


def discard(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Deletes the tables written after the mark ``since``, but for those that ``keep`` reads. Nothing else may need them any more."""
    kept = {p for df in keep for p in _TABLES[since:] if any(f"/{p.rsplit('/', 1)[1]}/" in x for x in df.inputFiles())}
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in [p for p in _TABLES[since:] if p not in kept]:
        where = fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        _TABLES.remove(path)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: cuts the lineage, survives lost executors.

    Shuffle files of the write are of no use afterwards, so executors drop them when it is done.
    """
    spark = df.sparkSession
    if spark.conf.get(CLEANUP, None) != "true":
        spark.conf.set(CLEANUP, "true")
    if path is None:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _TABLES.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the (written) table has at most ``rows`` rows; else the table as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def counter_rows(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    """A task's table of counters as (chunk, counters of 32 bits), without chunks of zeros."""
    chunks = [k for k in range(len(counts) // CHUNK) if counts[k * CHUNK : (k + 1) * CHUNK].any()]
    return chunks, [counts[k * CHUNK : (k + 1) * CHUNK].astype(np.uint32).tobytes() for k in chunks]


def _add_counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(raw.as_py(), np.uint32).astype(np.int64)
            total[k] = total[k] + x if k in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["chunk", "counts"])


def summed_counters(parts: DataFrame, width: int) -> np.ndarray:
    """The ``width`` counters over all tasks, of (chunk, counts); a table of fixed size, whatever the corpus."""
    out = np.zeros(width, np.int64)
    for r in parts.repartition("chunk").mapInArrow(_add_counters, "chunk int, counts binary").collect():  # width / CHUNK rows
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def with_id(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` as long and the named columns, without rows that have no id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns).where("doc_id is not null")


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    inverse = np.uint64(pow(int(BASE), -1, 2**64))
    out = []
    for b in (BASE, inverse):
        p = np.full(max(n, 1), b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Spans:
    """Hashes of any spans of a sequence of 64-bit symbols, from one running sum (equal spans, equal hashes)."""

    def __init__(self, symbols: np.ndarray, known: tuple[np.ndarray, np.ndarray] | None = None):
        """``known``: powers of at least as many places as there are symbols, and one."""
        power, self.inverse = known or powers(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * power[: len(symbols)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all(self, length: int) -> np.ndarray:
        """Of all spans of a length, by their starts."""
        x = self.sums[length:] - self.sums[:-length]
        x *= self.inverse[: len(x)]
        return mix(x)


#: A random 64-bit value for each byte.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_parts(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, offsets) of consecutive rows with about ``limit`` bytes together.

    A null is an empty text. The arrays are views of the Arrow buffers; a longer text is a part of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and after the last) of the words of the texts at ``offsets`` of ``raw``."""
    ink = ~IS_SPACE[raw]
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = ink[:-1]
    cut = offsets[:-1][np.diff(offsets) > 0]
    before[cut] = False  # a text begins
    starts = np.flatnonzero(ink & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = ink[1:]
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)



def tie_break(column: str, seed: int):
    """A reproducible pseudo-random long of a column: the same in every run, on any partitioning."""
    return F.xxhash64(F.col(column), F.lit(seed))


def bound_arrow_batches(spark: SparkSession, megabytes: int = 8, lean: bool = True) -> None:
    """Before Python runs on executors: Arrow batches are cut by bytes, so that a few long texts in a batch can't exhaust
    a worker, and workers get this package. ``lean``: workers give freed memory back, for some more CPU time; it holds
    for the rest of the session."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) != str(megabytes << 20):
        spark.conf.set(key, str(megabytes << 20))
    for name, value in MALLOC.items() if lean else ():
        spark.sparkContext.environment.setdefault(name, value)
    ship(spark)
