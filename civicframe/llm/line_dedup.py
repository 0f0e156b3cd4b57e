"""Line dedup over levelled sorted runs of line hashes.

A run is a written table (key, docs) sorted by key: how many documents of its batches hold each line. Each new batch
merge-anti-joins the keys that are already known to be frequent, and adds a run of its own to level 0. As soon as a
level holds ``fanout`` runs, they are compacted into one run of the next level; keys whose count reached the threshold
leave the open runs there and go to the closed ones. A key never sits in more than ``fanout`` runs a level, and all
steps are hash aggregations with map-side combine and sort-merge joins, so a line of every document is one partial row
a task.

Defined cases: a null or empty text is one empty line, which always stays (unless ``min_chars`` is 0); equal keys within one document count
once; rows that repeat a doc_id each get a result row, but count as one document; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import broadcast_if_small, with_id, written

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case.

    ``lower`` does the same, and much faster, where all other characters are lower-case letters.
    """
    line = F.trim(line, F.lit(SPACE))
    plain = (F.octet_length(line) == F.length(line)) | ~line.rlike(r"[\P{ASCII}&&\P{Ll}]")
    return F.when(plain, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def key_hash(key: Column) -> Column:
    """128 bits: two lines with the same hash are taken as equal."""
    return F.unhex(F.md5(key))


@dataclass
class LineRuns:
    """The runs so far. ``min_docs``: documents that make a key frequent; ``fanout``: runs of a level until they merge."""

    min_docs: int
    fanout: int = 2
    levels: dict[int, list[DataFrame]] = field(default_factory=dict)
    closed: list[DataFrame] = field(default_factory=list)

    def add(self, keys: DataFrame) -> None:
        """Adds a batch: one row (key, doc_id) for each line; the document ids of different batches differ."""
        counts = keys.distinct().groupBy("key").agg(F.count("*").alias("docs"))
        for run in self.closed:
            counts = counts.join(run.hint("merge"), "key", "left_anti")
        self._push(0, counts)

    def _push(self, level: int, run: DataFrame) -> None:
        runs = self.levels.setdefault(level, [])
        runs.append(written(run.sortWithinPartitions("key"), f"lines-level{level}"))
        if len(runs) >= self.fanout:
            merged = written(self._sum(runs), "lines-compacted")
            self.levels[level] = []
            self.closed.append(merged.where(F.col("docs") >= self.min_docs).select("key"))
            self._push(level + 1, merged.where(F.col("docs") < self.min_docs))

    @staticmethod
    def _sum(runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out.groupBy("key").agg(F.sum("docs").alias("docs"))

    def frequent(self) -> DataFrame:
        """The keys that are in at least ``min_docs`` documents of all batches (column key)."""
        runs = [r for level in self.levels.values() for r in level]
        out = self._sum(runs).where(F.col("docs") >= self.min_docs).select("key")
        for run in self.closed:
            out = out.unionByName(run)
        return out


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 3, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept (the text that stays); with ``carry`` also carried, a struct of the input's other columns.

    Lines whose key has at least ``min_chars`` code points and is in at least ``min_docs`` documents go everywhere. The
    documents are added in ``batches`` disjoint batches, by a hash of their id.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("carried")
    docs = with_id(docs, "text", *[others] * carry)
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line")).withColumn("line", line_key(F.col("line")))
    lines = written(lines.where(F.length("line") >= min_chars).select("doc_id", "version", "pos", key_hash(F.col("line")).alias("key")), "lines")
    runs = LineRuns(min_docs)
    for b in range(batches):
        runs.add(lines.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == b).select("key", "doc_id"))
    frequent = broadcast_if_small(written(runs.frequent(), "lines-frequent"))
    drops = lines.join(frequent, "key", "left_semi").groupBy("doc_id", "version").agg(F.collect_set("pos").alias("drops"))
    every = lines_of(F.col("text"))
    whole = docs.withColumn("version", F.xxhash64("text")).join(drops, ["doc_id", "version"], "left")
    n = F.size(every)
    keep = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drops"))
    picked = F.get(F.transform(F.array(every), lambda x: F.transform(keep, lambda i: F.get(x, i))), F.lit(0))  # splits once
    kept = F.when(F.col("drops").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(picked, "\n"))
    return whole.select("doc_id", n.cast("long").alias("n_lines"), F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"), kept.alias("kept"), *["carried"] * carry)


def digest(docs: DataFrame, **how) -> DataFrame:
    return dedup_lines(docs, **how).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents where doc_id is not null),
k as (
  select *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key from k where length(key) >= 1 group by key having count(distinct doc_id) >= 10),
m as (select k.*, f.key is not null as gone from k left join f on k.key = f.key)
select doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""
