"""The whole run: papers in, text, places, geocodes, files out; a small command line."""

from __future__ import annotations

import argparse
import json
import sys
import uuid
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civicframe import schemas
from civicframe.functions import text as T
from civicframe.operators import graph, locations, quality, state, storage
from civicframe.session import session
from civicframe.sources import files
from civicframe.streaming.ingest import parsed


@dataclass(frozen=True)
class Config:
    """city; folders of the input (papers as JSON lines, texts as Parquet with id and full_text, gazetteer as GeoJSON) and output."""

    city: str = "musterstadt"
    papers: str = "data/papers"
    texts: str | None = None
    gazetteer: str | None = None
    output: str = "data/processed"
    start_date: str | None = None
    end_date: str | None = None
    limit: int | None = None
    batch_size: int = 50
    skip_existing: bool = True
    reprocess_failed: bool = False


def load_config(path: str | None, **given) -> Config:
    """The values of a JSON file (or YAML, where a reader is installed), then what is given; ``${name}`` in a text is another value."""
    text = Path(path).read_text(encoding="utf-8") if path else "{}"
    if path and path.endswith((".yaml", ".yml")):
        import yaml

        known = yaml.safe_load(text) or {}
    else:
        known = json.loads(text)
    known |= {k: v for k, v in given.items() if v is not None}
    for k, v in known.items():
        if isinstance(v, str):
            for name, value in known.items():
                v = v.replace("${" + name + "}", str(value))
            known[k] = v
    return Config(**known)


def wanted(papers: DataFrame, config: Config, log: DataFrame | None) -> DataFrame:
    """Papers in the date bounds that weren't completed yet (or only failed ones), the newest ``limit`` of them."""
    if config.start_date:
        papers = papers.where(F.col("modified") >= F.lit(config.start_date).cast("timestamp"))
    if config.end_date:
        papers = papers.where(F.col("modified") < F.lit(config.end_date).cast("timestamp"))
    if log is not None and config.reprocess_failed:
        papers = papers.join(state.failed(log).select(F.col("resource_id").alias("id")), "id", "left_semi")
    elif log is not None and config.skip_existing:
        papers = papers.join(state.processed_ids(log).select(F.col("resource_id").alias("id")), "id", "left_anti")
    return papers if config.limit is None else papers.orderBy(F.desc_nulls_last("modified"), "id").limit(config.limit)


def _stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:  # the first run
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def process(papers: DataFrame, config: Config, gazetteer: DataFrame | None, run: int) -> dict:
    """One batch: papers are upserted by id; places and triples are appended under the number of this run; then the state log says so.

    A batch that is repeated after a failure gets a new number, and what it wrote before isn't current any more.
    """
    spark, out = papers.sparkSession, config.output.rstrip("/")
    seen = Observation("batch")
    good = F.coalesce(F.length("full_text") > 0, F.lit(False)) if config.texts else F.lit(True)
    papers = papers.observe(seen, F.count("*").alias("papers"), F.count_if(good).alias("completed"))
    aside = storage.scratch(spark)
    papers.write.parquet(aside)
    papers = spark.read.schema(papers.schema).parquet(aside)
    mentions = locations.extract(papers, "id")
    if gazetteer is None:
        gazetteer = spark.createDataFrame([], "name string, lat double, lon double")
    else:
        mentions = locations.firewall(mentions, gazetteer)
    mentions = locations.with_coordinates(locations.cap(mentions, "id"), gazetteer).withColumn("key", F.col("id")).drop("id")
    table = storage.locations_table(mentions.withColumn("method", F.lit("regex")), papers.withColumn("key", F.col("id")), "key", config.city)
    number = F.lit(run).cast("long").alias("run")
    storage.upsert(storage.prepare(papers, config.city), f"{out}/papers")
    table = table.dropDuplicates(["location_id"])
    table.select("*", number).write.mode("append").parquet(f"{out}/{config.city}_locations.parquet")
    about = papers.withColumn("paper_id", F.col("id"))
    triples = graph.paper_triples(about, keep=("paper_id",)).unionByName(graph.location_triples(table, keep=("paper_id",)))
    triples.select("*", number).write.mode("append").parquet(f"{out}/graph")
    status = F.when(good, "completed").otherwise("failed")
    log = papers.select(F.col("id").alias("resource_id"), F.lit("paper").alias("resource_type"), status.alias("status"), F.current_timestamp().alias("processed_at"), F.lit(run).cast("long").alias("seq"))
    log.write.mode("append").parquet(f"{out}/state")
    return seen.get


def run(spark: SparkSession, config: Config) -> dict:
    """Reads new papers, processes them batch by batch, and writes places, graph, GeoJSON and report of all; returns the run's statistics.

    Batches hold about ``batch_size`` papers, dealt by a hash of their id; each leaves a checkpoint row. A run that breaks
    off goes on with the papers that the state log lacks.
    """
    began, name = datetime.now(timezone.utc), uuid.uuid4().hex
    out = config.output.rstrip("/")
    raw = parsed(spark.read.text(config.papers), "value")
    papers = wanted(raw, config, _stored(spark, f"{out}/state")).withColumn("pdf_url", T.pdf_url(F.col("mainFile"), F.col("file"))).withColumnRenamed("paperType", "paper_type")
    if config.texts:  # by id, whatever order the texts were extracted in
        papers = papers.join(spark.read.parquet(config.texts).select("id", "full_text"), "id", "left")
    else:
        papers = papers.withColumn("full_text", F.lit(None).cast("string"))
    aside = storage.scratch(spark)
    papers.write.parquet(aside)
    papers = spark.read.schema(papers.schema).parquet(aside)
    gazetteer = None
    if config.gazetteer:
        gazetteer = files.coordinates(files.geojson(spark, config.gazetteer)).select(F.col("name_key").alias("name"), "lat", "lon")
    batches = -(-papers.count() // max(1, config.batch_size))
    number, total = int(began.timestamp() * 1_000_000), 0
    for batch in range(batches):
        one = papers.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == batch)
        got = process(one, config, gazetteer, number + batch)
        total += got["completed"]
        point = ("paper", batch, datetime.now(timezone.utc), got["papers"], total, name)
        spark.createDataFrame([point], schemas.CHECKPOINT).coalesce(1).write.mode("append").parquet(f"{out}/checkpoints")
    stats: dict = {"papers": papers.count(), "batches": batches}
    log = _stored(spark, f"{out}/state")
    if log is not None:
        table = storage.current(spark.read.parquet(f"{out}/{config.city}_locations.parquet"), log)
        graph.write_ntriples(storage.current(spark.read.parquet(f"{out}/graph"), log), f"{out}/graph.nt")
        places = storage.write_geojson(storage.geojson_features(table, config.city), f"{out}/{config.city}_locations.geojson", config.city)
        stats |= {"locations": table.count(), "features": places}
    issues = quality.validate_papers(papers.select("id", "name", "date", F.col("mainFile").alias("main_file"), F.lit(0).alias("n")), "n")
    stats |= quality.write_report(issues, f"{out}/report")
    row = (name, began, datetime.now(timezone.utc), "completed", config.city, json.dumps(asdict(config)), json.dumps(stats))
    spark.createDataFrame([row], schemas.RUN).write.mode("append").parquet(f"{out}/runs")
    return stats


def main(argv: list[str] | None = None) -> int:
    """0 if the run ended, 1 if it failed, 130 if it was interrupted."""
    p = argparse.ArgumentParser(description="Council records: papers, places, graph.")
    p.add_argument("--config")
    p.add_argument("--city")
    p.add_argument("--papers")
    p.add_argument("--texts")
    p.add_argument("--gazetteer")
    p.add_argument("--output")
    p.add_argument("--start-date")
    p.add_argument("--end-date")
    p.add_argument("--limit", type=int)
    p.add_argument("--batch-size", type=int)
    p.add_argument("--no-skip-existing", dest="skip_existing", action="store_false", default=None)
    p.add_argument("--reprocess-failed", action="store_true", default=None)
    p.add_argument("--test", action="store_true", help="ten papers, batches of five")
    given = vars(p.parse_args(argv))
    path, test = given.pop("config"), given.pop("test")
    config = load_config(path, **given)
    if test:
        config = replace(config, limit=10, batch_size=5)
    try:
        print(json.dumps(run(session(), config)))
    except KeyboardInterrupt:
        return 130
    except Exception as error:
        print(f"failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
