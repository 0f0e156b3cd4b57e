"""Papers at rest: partitioned Parquet, idempotent upserts, the locations table, GeoJSON."""

from __future__ import annotations

import json
import tempfile
import uuid
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicframe.functions import text as T
from civicframe.functions import time as D


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared one (spark.checkpoint.dir). A local session without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="civicframe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def prepare(papers: DataFrame, city: str, now: datetime | None = None) -> DataFrame:
    """Adds city (lower case), year and month of ``date``; without a date column the present ones. Unreadable dates give nulls."""
    p = papers.withColumn("city", F.lit(city.lower()))
    if "date" not in papers.columns:
        now = now or datetime.now()
        return p.withColumns({"year": F.lit(now.year), "month": F.lit(now.month)})
    at = D.coerced(F.col("date").cast("string"))
    return p.withColumns({"year": F.year(at), "month": F.month(at)})


def write_batch(papers: DataFrame, path: str, append: bool = True, partitions: tuple[str, ...] = ("city", "year"), compression: str = "snappy") -> None:
    """Partitioned Parquet. Not appending replaces just the partitions that the batch holds."""
    writer = papers.repartition(*partitions).write.partitionBy(*partitions).option("compression", compression)
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def upsert(papers: DataFrame, path: str, key: str = "id", newest: str = "modified", partitions: tuple[str, ...] = ("city", "year")) -> None:
    """Adds a batch by key: of rows with one key the newest stays, so that a batch can be written again.

    Only the partitions that the batch or its keys' old rows are in are read and replaced.
    """
    spark = papers.sparkSession
    try:
        old = spark.read.parquet(path).select(*papers.columns)
    except Exception as error:  # nothing there yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        write_batch(papers, path, partitions=partitions)
        return
    touched = papers.select(*partitions).union(old.join(papers.select(key), key, "left_semi").select(*partitions)).distinct()
    same = [old[c].eqNullSafe(F.col(f"t_{c}")) for c in partitions]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    kept = old.join(F.broadcast(touched.select(*[F.col(c).alias(f"t_{c}") for c in partitions])), cond, "left_semi")
    both = kept.withColumn("rank_", F.lit(0)).unionByName(papers.withColumn("rank_", F.lit(1)))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc_nulls_last(newest), F.desc("rank_")))
    merged = both.withColumn("place_", place).where("place_ = 1").drop("place_", "rank_")
    aside = scratch(spark)  # Spark can't overwrite what it reads
    merged.write.parquet(aside)
    write_batch(spark.read.schema(merged.schema).parquet(aside), path, append=False, partitions=partitions)


def read_all(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_partition(spark: SparkSession, path: str, city: str, year: int | None = None) -> DataFrame:
    """Only the partition's files are read."""
    p = spark.read.parquet(path).where(F.col("city") == city.lower())
    return p if year is None else p.where(F.col("year") == year)


def locations_table(mentions: DataFrame, papers: DataFrame | None, key: str, city: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 14 columns of the flat table, from mentions (with ``key``) and their papers; without ``papers`` mentions have their
    id, name, date and pdf_url beside them. ``keep``: further columns of mentions."""
    about = (F.col("id").alias("paper_id"), F.col("name").alias("paper_name"), F.col("date").cast("string").alias("paper_date"), F.coalesce("pdf_url", F.lit("")).alias("pdf_url"))
    have = set(mentions.columns) - (set() if papers is not None else {"id", "name", "date", "pdf_url"})
    text = lambda c: (F.col(c) if c in have else F.lit(None)).cast("string")
    m = mentions.select(*sorted(have), *about) if papers is None else mentions.join(papers.select(key, *about), key)
    return m.select(
        T.location_id(F.col("paper_id"), F.col("type"), F.col("value")).alias("location_id"), "paper_id", "paper_name", "paper_date", "pdf_url", F.col("type").alias("location_type"), F.col("value").alias("location_value"),
        "latitude", "longitude", text("display_name").alias("display_name"), text("query").alias("query"), text("method").alias("method"), text("context").alias("context"), F.lit(city).alias("city"), *keep,
    )


def geojson_features(table: DataFrame, city: str | None = None, compat: bool = False) -> DataFrame:
    """One row (paper_id, location_name, feature: JSON text) per location with coordinates; ``compat`` also takes 0 as missing."""
    t = table.where("latitude is not null and longitude is not null")
    if compat:
        t = t.where("latitude <> 0 and longitude <> 0")
    if city is not None:
        t = t.where(F.col("city") == city)
    name = F.col("location_value")
    point = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    about = F.struct(name.alias("location_name"), "paper_id", F.col("paper_name").alias("paper_title"), F.coalesce("paper_date", F.lit("")).alias("paper_date"), "pdf_url", F.coalesce("method", F.lit("")).alias("source"), F.lit(1).alias("count"))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), about.alias("properties")))
    return t.select("paper_id", name.alias("location_name"), "latitude", "longitude", feature.alias("feature"))


def geojson_metadata(features: DataFrame) -> DataFrame:
    return features.agg(F.count("*").alias("count"), F.count_distinct("location_name").alias("unique_locations"))


def write_geojson(features: DataFrame, path: str, city: str | None = None, at: datetime | None = None) -> int:
    """One document, streamed through the driver row by row; returns the number of features."""
    meta = geojson_metadata(features).first()
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"type": "FeatureCollection", "features": [')
        for i, row in enumerate(features.select("feature").toLocalIterator()):
            f.write(("," if i else "") + "\n" + row["feature"])
        about = {"count": meta["count"], "unique_locations": meta["unique_locations"], "city": city, "generated_at": (at or datetime.now()).isoformat()}
        f.write(f'\n], "metadata": {json.dumps(about, ensure_ascii=False)}}}')
    return meta["count"]


def write_geojson_lines(features: DataFrame, path: str) -> None:
    """One feature a line, by all tasks: for tables that are too large for one document."""
    features.select(F.col("feature").alias("value")).write.mode("overwrite").text(path)


def export_csv(table: DataFrame, path: str) -> None:
    """CSV with a header; nested columns as JSON."""
    flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("struct", "array", "map") else F.col(f"`{f.name}`") for f in table.schema]
    table.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def current(rows: DataFrame, log: DataFrame, key: str = "paper_id") -> DataFrame:
    """Of append-only rows (with ``run``) those of the run that last processed their paper; a paper that lost all its rows has none.

    ``log``: the state log, whose seq is the run. Changed papers so need no rewriting of a table.
    """
    last = log.groupBy(F.col("resource_id").alias("last_id")).agg(F.max("seq").alias("last_run"))
    return rows.join(last, (rows[key] == F.col("last_id")) & (rows["run"] == F.col("last_run")), "left_semi")


def split_by_success(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(with text, failed)"""
    good = F.coalesce(F.col("success") & (F.length("text") > 0), F.lit(False))
    return results.where(good), results.where(~good)


def skip_existing(papers: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return papers.join(done.select(key).distinct(), key, "left_anti")


def size_route(bytes_: Column, limit: int = 10 * 1024 * 1024) -> Column:
    """Where a download goes: to memory, or above the limit to a temporary file."""
    return F.when(bytes_ > limit, "file").otherwise("memory")
