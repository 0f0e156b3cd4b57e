"""Mixing of sources to target weights by Pareto order sampling.

Targets come from water-filling: sources share the budget by weight, none takes more than ``most`` times its words.
Within a source every document has the same expected number of copies r = target / words of the source (or one in
proportion to a given propensity). floor(r) copies are certain; the extra copy is drawn by Pareto sampling: documents
are ranked by u/(1-u) divided by p/(1-p), u a reproducible uniform number and p the inclusion probability, and the
lowest ranks fill the rest of the target. The size of the sample is fixed in words: the document at the boundary is
taken in part, so that a source's words meet its target to the word.

No sort of a whole source: ranks fall into buckets whose words are summed (map-side combine); the one bucket that a
source's boundary falls into is refined until it holds few rows, and only these are ordered.

Defined cases: a null text has size 0 and nothing is taken; a null source is a source of its own, last; repeated rows
count as often as they stand there; without any words all targets are 0; ties of the rank go by doc_id; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import broadcast_if_small, written

WEIGHTS = (5, 2, 1)
#: Buckets of ranks, in each of which there are as many again; most levels; rows of an edge that are ordered.
BUCKETS, FINEST, FEW = 256, 6, 20_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """In (0, 1), from the first 52 bits of an MD5: the same in every run and engine."""
    bits = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: source, source_size, target. Works on one row per source (already aggregated)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    per = per.withColumn("ratio", F.col("cap").cast("double") / F.col("weight").cast("double"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything).cast("double") * share - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("double")) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double")
    per = per.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))
    per = per.withColumn("fits", fits).withColumn("water", F.min(F.when(F.col("fits").isNotNull(), F.struct("ratio", "level"))).over(everything)["level"])
    return per.select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("water") * F.col("weight").cast("double"), F.lit(0.0))).alias("target"))


def _plan(sizes: DataFrame, share: float, most: int, weights: tuple[int, ...]) -> DataFrame:
    """One row per source: its, source_size, target, whole (certain copies), part (odds of one more), room (words for the extra copies), mean (propensity)."""
    targets = written(source_targets(sizes, share, most, weights), "mix-targets")
    targets = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    targets = targets.withColumn("whole", F.floor("rate")).withColumn("part", F.col("rate") - F.floor("rate"))
    targets = targets.withColumn("room", F.floor(F.col("target") + 0.5) - F.col("whole") * F.col("source_size"))
    means = sizes.groupBy("source").agg(F.avg("propensity").alias("mean"))
    targets = targets.alias("t").join(means.alias("m"), F.col("t.source").eqNullSafe(F.col("m.source")), "left").select("t.*", "mean")
    return written(targets, "mix-plan").withColumnRenamed("source", "its")


def _ranked(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Rows (mix_id, mix_source, size, propensity) with their source's plan and their rank; ``place`` has the ranks' order in 0 to 1."""
    odds = F.least(F.greatest(F.col("part") * F.when(F.col("mean") > 0, F.col("propensity") / F.col("mean")).otherwise(1.0), F.lit(1e-12)), F.lit(1 - 1e-12))
    u = uniform(F.col("mix_id"), seed)
    rank = (u / (1 - u)) * ((1 - odds) / odds)
    rows = rows.join(broadcast_if_small(plan), F.col("mix_source").eqNullSafe(F.col("its"))).withColumn("rank", rank)
    return rows.withColumn("place", F.col("rank") / (1 + F.col("rank")))


def _bounded(sizes: DataFrame, plan: DataFrame, seed: int) -> tuple[DataFrame, float]:
    """(plan with ``edge`` and ``earlier``, buckets): a source takes the buckets before its edge as a whole, ``earlier`` words, and none after it.

    Buckets are refined within the edge until it holds few rows, so what is left to be ordered doesn't grow with a source.
    """
    rows, fine = _ranked(sizes, plan, seed).withColumn("base", F.lit(0).cast("long")), 1.0
    while True:
        fine *= BUCKETS
        rows = rows.withColumn("bucket", F.floor(fine * F.col("place")))
        sums = rows.groupBy("its", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("rows"), F.first("room").alias("room"), F.first("base").alias("base"))
        before = Window.partitionBy("its").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("earlier", F.col("base") + F.coalesce(F.sum("words").over(before), F.lit(0)))
        over = sums.where(F.col("earlier") + F.col("words") > F.col("room"))
        edges = written(over.groupBy(F.col("its").alias("of")).agg(F.min(F.struct("bucket", "earlier", "rows")).alias("e")).select("of", F.col("e.bucket").alias("edge"), F.col("e.earlier").alias("earlier"), F.col("e.rows").alias("rows")), "mix-edges")
        if fine >= BUCKETS**FINEST or (edges.agg(F.max("rows")).first()[0] or 0) <= FEW:
            bounded = plan.join(edges.drop("rows"), F.col("its").eqNullSafe(F.col("of")), "left").drop("of")
            return written(bounded, "mix-bounds"), fine
        within = broadcast_if_small(edges.select("of", "edge", F.col("earlier").alias("from")))
        rows = rows.join(within, F.col("its").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("edge"))).withColumn("base", F.col("from")).drop("of", "edge", "from")


def _taken(rows: DataFrame, fine: float) -> tuple[Column, Column]:
    """(whether a row of ``_ranked`` with bounds is in its source's edge; words that it takes if it isn't)"""
    bucket = F.floor(fine * F.col("place"))
    extra = F.when(F.col("edge").isNull() | (bucket < F.col("edge")), F.col("size")).otherwise(0)
    return F.coalesce(bucket == F.col("edge"), F.lit(False)), (F.col("whole") * F.col("size") + extra).cast("long")


def _drawn(rows: DataFrame) -> DataFrame:
    """Rows of the edges with ``taken``: in order of rank what still fits, the last of them in part."""
    within = Window.partitionBy("its").orderBy("rank", "mix_id").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("room") - F.col("earlier") - F.coalesce(F.sum("size").over(within), F.lit(0))
    return rows.withColumn("taken", (F.col("whole") * F.col("size") + F.least(F.col("size"), F.greatest(left, F.lit(0)))).cast("long"))


def _sized(docs: DataFrame, propensity: Column | None) -> DataFrame:
    odds = F.lit(1.0) if propensity is None else propensity.cast("double")
    return written(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("mix_id"), F.col("source").alias("mix_source"), n_words(F.col("text")).alias("size"), odds.alias("propensity")), "mix-sizes")


def mix_sources(docs: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 0, propensity: Column | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words). ``propensity``: relative odds of an extra copy within a source (all alike if None)."""
    sizes = _sized(docs, propensity)
    plan, fine = _bounded(sizes, _plan(sizes.withColumnRenamed("mix_source", "source"), share, most, weights), seed)
    rows = _ranked(sizes, plan, seed)
    edge, taken = _taken(rows, fine)
    out = [F.col("mix_id").alias("doc_id"), "size", "source_size", "target"]
    return rows.where(~edge).select(*out, taken.alias("taken")).unionByName(_drawn(rows.where(edge)).select(*out, "taken"))


def take_copies(docs: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 0) -> DataFrame:
    """The documents as the mix takes them: whole copies, and of a document at a boundary its first words; same columns as ``docs``.

    Each row knows from its source's bounds what it takes, so no text is shuffled; only rows in an edge are looked up.
    Rows that repeat a doc_id are taken each; at an edge they share evenly what they take together.
    """
    sizes = _sized(docs, None)
    plan, fine = _bounded(sizes, _plan(sizes.withColumnRenamed("mix_source", "source"), share, most, weights), seed)
    ranked = _ranked(sizes, plan, seed)
    drawn = _drawn(ranked.where(_taken(ranked, fine)[0])).groupBy(F.col("mix_id").alias("drawn_id"), F.col("its").alias("drawn_source")).agg(F.floor(F.sum("taken") / F.count("*")).alias("drawn"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.where("doc_id is not null").select(row, F.col("doc_id").cast("long").alias("mix_id"), F.col("source").alias("mix_source"), n_words(F.col("text")).alias("size"), F.lit(1.0).alias("propensity"))
    rows = _ranked(rows, plan, seed)
    rows = rows.join(broadcast_if_small(written(drawn, "mix-drawn")), (F.col("mix_id") == F.col("drawn_id")) & F.col("its").eqNullSafe(F.col("drawn_source")), "left")
    edge, taken = _taken(rows, fine)
    rows = rows.select("row", "size", F.when(edge, F.coalesce("drawn", F.lit(0))).otherwise(taken).alias("taken")).where("taken > 0")
    n, taken = F.col("size"), F.col("taken")
    copies = F.transform(F.sequence(F.lit(1).cast("long"), F.ceil(taken / n)), lambda i: F.least(n, taken - (i - 1) * n))
    both = rows.select("row", "size", F.explode(copies).alias("part"))
    first = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("part").cast("int")), " ")
    text = F.when(F.col("part") < n, first).otherwise(F.col("row.text")).alias("text")
    return both.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


ORACLE = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         (cast(cast(concat('0x', substr(md5(concat(cast(doc_id as varchar), ':0')), 1, 13)) as bigint) as double) + cast(0.5 as double)) / cast(4503599627370496 as double) as u
  from documents where doc_id is not null),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (
  select *, source_size * 2 as cap,
         case (row_number() over (order by source collate "binary" asc nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight from s),
r as (select *, cast(cap as double) / cast(weight as double) as ratio from w),
v as (
  select *, (cast(sum(source_size) over () as double) * cast(1.5 as double)
             - cast(coalesce(sum(cap) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0) as double))
            / cast(sum(weight) over () - coalesce(sum(weight) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0) as double) as level from r),
water as (select arg_min(level, ratio) as water from v where level <= ratio),
t as (select source, source_size, least(cast(cap as double), coalesce(water * cast(weight as double), 0)) as target from v, water),
p as (
  select *, case when source_size > 0 then target / cast(source_size as double) else 0 end as rate from t),
q as (
  select *, cast(floor(rate) as bigint) as whole,
         least(greatest(rate - floor(rate), cast(1e-12 as double)), cast(1 as double) - cast(1e-12 as double)) as odds,
         cast(floor(target + cast(0.5 as double)) as bigint) - cast(floor(rate) as bigint) * source_size as room from p),
x as (
  select d.doc_id, d.size, q.source_size, q.target, q.whole, q.room,
         coalesce(sum(d.size) over (partition by d.source order by (u / (1 - u)) * ((1 - odds) / odds), d.doc_id rows between unbounded preceding and 1 preceding), 0) as earlier
  from d join q on d.source is not distinct from q.source)
select doc_id, size, source_size, target, cast(whole * size + least(size, greatest(room - earlier, 0)) as bigint) as taken from x
"""
