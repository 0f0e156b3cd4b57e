"""Incremental ingest: papers that land as JSON (or come from any stream) become prepared Parquet, a state log, and stay resumable.

Each micro-batch is upserted by id and then logged; a batch that runs again after a failure changes nothing, since both
steps are by key (the paper's id, the batch's number).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from civicframe import schemas
from civicframe.operators import state, storage


@dataclass(frozen=True)
class Paths:
    """Folders of a run, on shared storage."""

    papers: str
    log: str
    checkpoint: str


def landed(spark: SparkSession, folder: str, files_per_batch: int = 50) -> DataFrame:
    """A stream of papers from JSON lines that land in a folder."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return parsed(raw, "value")


def parsed(raw: DataFrame, column: str) -> DataFrame:
    return raw.select(F.from_json(F.col(column), schemas.PAPER).alias("p")).select("p.*").where("id is not null and not coalesce(deleted, false)")


def log_batch(papers: DataFrame, batch: int, path: str, status: str = "completed") -> None:
    """Appends the batch to the state log, in a folder of its own number, so that a repeated batch replaces itself."""
    rows = papers.select(F.col("id").alias("resource_id"), F.lit("paper").alias("resource_type"), F.lit(status).alias("status"), F.current_timestamp().alias("processed_at"), F.lit(batch).cast("long").alias("seq"))
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def start(papers: DataFrame, paths: Paths, city: str, once: bool = True) -> StreamingQuery:
    """Runs the ingest; ``once``: over what is there, then ends."""

    def step(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        one = batch.groupBy("id").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "id"]), F.struct("modified", "name")).alias("p")).select("id", "p.*")
        ready = storage.prepare(one, city)
        storage.upsert(ready, paths.papers)
        log_batch(one, number, paths.log)

    writer = papers.writeStream.foreachBatch(step).option("checkpointLocation", paths.checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def processed(spark: SparkSession, paths: Paths) -> DataFrame:
    return state.processed_ids(spark.read.parquet(paths.log))


def distinct_within(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Each id once within the watermark's delay. ``modified`` must be a timestamp with zone."""
    return stream.withWatermark("modified", delay).dropDuplicatesWithinWatermark(["id"])


def daily_counts(meetings: DataFrame, delay: str = "1 day") -> DataFrame:
    """Meetings a day, of a stream with ``start`` (our own addition: nothing else here is windowed)."""
    at = F.col("start").cast("timestamp")
    counts = meetings.withColumn("at", at).withWatermark("at", delay).groupBy(F.window("at", "1 day")).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("day"), "n")
