"""Secret scans over an incremental blob ledger.

Every historical version of a text is content-addressed (SHA-256). The ledger is a stored table with one row for each
(blob, rules) pair that was ever scanned, findings or not: a folder of segments, one for each scan, and a manifest of the
finished ones. A scan reads only texts whose blob the ledger lacks under the present version of the rules, once for each
blob, adds a segment, and joins the findings back to all documents (paths) that hold the blob. A scan that fails leaves
the manifest as it was and can be repeated.

Rules: the three base kinds of RULES, and as further kinds private key blocks and signed web tokens. Spans count code
points, end exclusive. Matches of a kind are leftmost and don't overlap.

Defined cases: a null text is the empty blob; repeated rows get a row each; texts are searched whole, however long; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.llm.common import bound_arrow_batches, broadcast_if_small, shared_dir, with_id, written

#: Version of the rules: a change of a rule needs a new one, so that blobs are scanned again.
VERSION = 1
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEY = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
KINDS = ("assign", "access", "hex", "key", "jwt")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end), sorted."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    for kind, rule in enumerate((ACCESS, HEX, KEY, JWT), 1):
        out += [(m.start(), kind, m.end()) for m in rule.finditer(text)]
    return sorted(out)


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find(x) for x in batch.column(1).to_pylist()]
        counts = [pa.array([sum(k == kind for _, k, _ in x) for x in found], pa.int64()) for kind in range(3)]
        base = pa.array([joined([y for y in x if y[1] < 3]) for x in found], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), *counts, base, pa.array([joined(x) for x in found], pa.string())], ["blob", "n_assign", "n_access", "n_hex", "base", "spans"])


FOUND = "blob binary, n_assign long, n_access long, n_hex long, base string, spans string"


def scan(docs: DataFrame, ledger: DataFrame | None = None, version: int = VERSION) -> tuple[DataFrame, DataFrame]:
    """(findings of every document, the new ledger): columns doc_id, n_assign, n_access, n_hex, base, spans, blob; the ledger has the findings of blobs, and version.

    ``ledger`` is what earlier scans returned. Only blobs that it lacks under ``version`` are read by the rules.
    """
    rows, found = _scanned(docs, ledger, version)
    return rows, found if ledger is None else found.unionByName(ledger)


def _scanned(docs: DataFrame, ledger: DataFrame | None, version: int, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings of every document, what this scan found); the latter is written to ``path`` if given."""
    bound_arrow_batches(docs.sparkSession)
    texts = with_id(docs, F.coalesce("text", F.lit("")).alias("text"))
    paths = written(texts.select("doc_id", F.unhex(F.sha2("text", 256)).alias("blob")), "blobs")
    unseen = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    if ledger is not None:
        unseen = unseen.join(ledger.where(F.col("version") == version), "blob", "left_anti")
    # what is not read: later copies and seen blobs, usually few; the ids of either side are dealt by size
    skip = written(paths.join(unseen.select("blob", "doc_id").withColumn("read", F.lit(True)), ["blob", "doc_id"], "left").where("read is null").select("doc_id", "blob"), "blobs-skipped")
    once = texts.withColumn("blob", F.unhex(F.sha2("text", 256)))
    fresh = once.join(broadcast_if_small(skip), ["doc_id", "blob"], "left_anti").select("blob", "text")
    found = written(fresh.mapInArrow(_scan, FOUND).withColumn("version", F.lit(version)), "ledger", path).dropDuplicates(["blob"])
    current = found if ledger is None else found.unionByName(ledger.where(F.col("version") == version))
    hit = current.where("spans <> ''").drop("version")
    rows = paths.join(broadcast_if_small(hit), "blob", "left")
    zero = F.lit(0).cast("long")
    rows = rows.select("doc_id", *[F.coalesce(c, zero).alias(c) for c in ("n_assign", "n_access", "n_hex")], *[F.coalesce(c, F.lit("")).alias(c) for c in ("base", "spans")], "blob")
    return rows, found


class Ledger:
    """A ledger in a shared folder, which later scans and other jobs go on with."""

    SCHEMA, ENTRY = f"{FOUND}, version int", "segment string, version int, at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self) -> list[str]:
        """Names of the segments of finished scans, one for each scan."""
        try:
            return sorted(r["segment"] for r in self.spark.read.schema(self.ENTRY).parquet(f"{self.path}/manifest").select("segment").collect())
        except AnalysisException as error:  # the first scan
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []

    def rows(self) -> DataFrame | None:
        """Findings of all blobs that were ever scanned; None before the first scan."""
        segments = self.batches()
        return self.spark.read.schema(self.SCHEMA).parquet(*[f"{self.path}/segments/{s}" for s in segments]).dropDuplicates(["blob", "version"]) if segments else None

    def scan(self, docs: DataFrame, version: int = VERSION) -> DataFrame:
        """Findings of every document; what is new is added to the ledger."""
        segment = uuid.uuid4().hex
        rows, _ = _scanned(docs, self.rows(), version, f"{self.path}/segments/{segment}")
        entry = self.spark.range(1).select(F.lit(segment).alias("segment"), F.lit(version).alias("version"), F.current_timestamp().alias("at"))
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return rows


def digest(docs: DataFrame, batches: int = 2) -> DataFrame:
    """Scans the documents in ``batches`` batches (by a hash of their ids), each with the stored ledger of those before it."""
    ledger = Ledger(docs.sparkSession, f"{shared_dir(docs.sparkSession)}/ledger-{uuid.uuid4().hex}")
    parts = [ledger.scan(docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(batches)) == b)) for b in range(batches)]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")
