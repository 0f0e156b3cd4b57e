"""What was processed: an append-only log and views of it. Latest rows win; nothing is updated in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(log: DataFrame, key: str = "resource_id", *order: str) -> DataFrame:
    """The last row of each key. An aggregate, not a window: map-side combined, so a key with many rows is no problem."""
    order = order or ("processed_at", "seq")
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("l")).select(key, "l.*")


def processed_ids(log: DataFrame, kind: str | None = None) -> DataFrame:
    """Ids whose last status is completed; failed ones are tried again."""
    now = latest(log).where("status = 'completed'")
    return (now if kind is None else now.where(F.col("resource_type") == kind)).select("resource_id")


def failed(log: DataFrame) -> DataFrame:
    return latest(log).where("status = 'failed'").orderBy(F.desc("processed_at"), "resource_id")


def statistics(log: DataFrame) -> DataFrame:
    return latest(log).groupBy("resource_type", "status").agg(F.count("*").alias("n"))


def rollup(log: DataFrame) -> DataFrame:
    """Counts by type and status, by type, and in all; 'all' stands for every value."""
    r = latest(log).rollup("resource_type", "status").agg(F.count("*").alias("n"))
    return r.select(F.coalesce("resource_type", F.lit("all")).alias("resource_type"), F.coalesce("status", F.lit("all")).alias("status"), "n")


def checkpoint_totals(log: DataFrame) -> DataFrame:
    return latest(log).groupBy("resource_type").agg(F.count_if(F.col("status") == "completed").alias("total_processed"))


def checkpoints(log: DataFrame, size: int) -> DataFrame:
    """A checkpoint for every ``size`` rows of the log: type, batch, time, rows, running total."""
    batch = F.floor(F.col("seq") / size)
    c = log.groupBy("resource_type", batch.alias("batch")).agg(F.max("processed_at").alias("checkpoint_time"), F.count("*").alias("batch_size"))
    return c.withColumn("total_processed", F.sum("batch_size").over(Window.partitionBy("resource_type").orderBy("batch")))


def last_checkpoint(points: DataFrame) -> DataFrame:
    rest = [c for c in points.columns if c != "resource_type"]
    return points.groupBy("resource_type").agg(F.max_by(F.struct(*rest), "batch").alias("c")).select("resource_type", "c.*")


def newest(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def clear_failed(log: DataFrame) -> DataFrame:
    """The log without the ids whose last status is failed."""
    return log.join(latest(log).where("status = 'failed'").select("resource_id"), "resource_id", "left_anti")


def to_metadata(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns))


def from_metadata(text: Column, schema: str) -> Column:
    return F.from_json(text, schema)
