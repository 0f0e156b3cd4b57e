"""Readers: GeoJSON gazetteers, map elements, CSV name lists, N-Triples, PDF bytes."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.session import ship

FEATURES = "struct<type:string,features:array<struct<type:string,geometry:struct<type:string,coordinates:array<double>>,properties:struct<id:string,name:string,highway:string,source:string>>>>"


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """pos and the properties and geometry of each feature."""
    docs = spark.read.text(path, wholetext=True)
    return geojson_features(docs, "value")


def geojson_features(docs: DataFrame, column: str) -> DataFrame:
    found = docs.select(F.posexplode(F.from_json(F.col(column), FEATURES)["features"]).alias("pos", "f"))
    return found.select("pos", F.col("f.properties.id").alias("id"), F.col("f.properties.name").alias("name"), F.col("f.properties.highway").alias("highway"), F.col("f.properties.source").alias("source"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def names(features: DataFrame) -> DataFrame:
    """Distinct names, sorted, with the lower-cased key."""
    return features.where("name is not null and name <> ''").select("name", F.lower("name").alias("name_key")).distinct().orderBy("name")


def coordinates(features: DataFrame) -> DataFrame:
    """name_key, lat, lon of points with two numbers; of equal names the last one counts."""
    points = features.where("kind = 'Point' and size(coordinates) = 2 and name is not null")
    last = points.groupBy(F.lower("name").alias("name_key")).agg(F.max_by("coordinates", "pos").alias("c"))
    return last.select("name_key", F.get("c", F.lit(1)).alias("lat"), F.get("c", F.lit(0)).alias("lon"))


def osm_features(elements: DataFrame) -> DataFrame:
    """Features of map elements (type, id, lat, lon, center, tags: map): tagged nodes with a name, named ways of a kind."""
    tags = F.col("tags")
    kinds = F.coalesce(tags["highway"], tags["boundary"], tags["natural"])
    node = (F.col("type") == "node") & (F.size(tags) > 0) & tags["name"].isNotNull()
    way = (F.col("type") == "way") & tags["name"].isNotNull() & kinds.isNotNull()
    return elements.where(node | way).select("pos", "type", "id", tags["name"].alias("name"), kinds.alias("kind"), F.coalesce("lat", "center.lat").alias("lat"), F.coalesce("lon", "center.lon").alias("lon"))


def build_gazetteer(features: DataFrame) -> DataFrame:
    """The first way with a centre for each name."""
    ways = features.where("lat is not null and lon is not null")
    place = F.row_number().over(Window.partitionBy("name").orderBy("pos"))
    return ways.withColumn("place", place).where("place = 1").select("id", "name", "kind", "lat", "lon", F.lit("osm").alias("source"))


def districts(elements: DataFrame, level: str = "10") -> DataFrame:
    """Features of administrative boundaries of a level: id, name, source; they have no geometry."""
    tags = F.col("tags")
    found = elements.where((tags["boundary"] == "administrative") & (tags["admin_level"] == level) & tags["name"].isNotNull())
    none = lambda kind: F.lit(None).cast(kind)
    return found.select("id", tags["name"].alias("name"), F.lit("district").alias("kind"), none("double").alias("lat"), none("double").alias("lon"), F.lit("osm").alias("source"))


def write_gazetteer(gazetteer: DataFrame, folder: str, city: str) -> dict:
    """Features (id, name, kind, lat, lon, source) as <city>_streets.geojson, and a summary of them; returns the summary."""
    point = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")))
    about = F.struct("id", "name", F.col("kind").alias("highway"), "source")
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), about.alias("properties")))
    kinds = {r["kind"]: r["n"] for r in gazetteer.groupBy("kind").agg(F.count("*").alias("n")).orderBy("kind").collect()}
    where = Path(folder)
    where.mkdir(parents=True, exist_ok=True)
    with open(where / f"{city}_streets.geojson", "w", encoding="utf-8") as f:
        f.write('{"type": "FeatureCollection", "features": [')
        for i, row in enumerate(gazetteer.orderBy("name", "id").select(feature.alias("feature")).toLocalIterator()):
            f.write(("," if i else "") + "\n" + row["feature"])
        f.write("\n]}")
    summary = {"city": city, "features": sum(kinds.values()), "by_kind": kinds}
    (where / f"{city}_summary.json").write_text(json.dumps(summary, ensure_ascii=False, indent=2), encoding="utf-8")
    return summary


ELEMENT = "struct<type:string,id:long,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>"


def map_elements(spark: SparkSession, query: str, post: Callable[[str], str]) -> DataFrame:
    """Elements (pos, type, id, lat, lon, center, tags) of a map service's answer. ``post`` sends a query and returns JSON text."""
    answer = spark.createDataFrame([(post(query),)], "value string")
    found = answer.select(F.posexplode(F.from_json("value", f"struct<elements:array<{ELEMENT}>>")["elements"]).alias("pos", "e"))
    return found.select("pos", "e.*")


def name_list(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a CSV file."""
    rows = spark.read.csv(path, header=True)
    return rows.select(F.col(rows.columns[0]).alias("name"))


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    return parse_ntriples(spark.read.text(path), "value")


_OBJECT = r'^(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)\s*\.\s*(?:#.*)?$'


_HEAD = r"^(?:<([^>]*)>|(_:\S+))\s+<([^>]*)>\s+(.*)$"
#: The same objects as _OBJECT, without steps back in a literal.
_OBJECT_FAST = _OBJECT.replace(r'"((?:[^"\\]|\\.)*)"', r'"((?:[^"\\]++|\\.)*+)"')
_CUT = "\x01"


def _grouped(df: DataFrame, column: str, pattern: str, number: int, name: str) -> DataFrame:
    """Adds array<string>: the groups of a pattern of whole texts, by one run of it; empty ones if there is no match."""
    at = range(1, number + 1)
    df = df.withColumn("cut_", F.regexp_replace(column, pattern + "(?s:.*)", _CUT + _CUT.join(f"${i}" for i in at)))
    quick = F.when(F.col("cut_").startswith(F.lit(_CUT)), F.slice(F.split("cut_", _CUT), 2, number)).otherwise(F.array(*[F.lit("") for _ in at]))
    one_by_one = F.array(*[F.regexp_extract(column, pattern, i) for i in at])
    return df.withColumn(name, F.when(F.contains(F.col(column), F.lit(_CUT)), one_by_one).otherwise(quick)).drop("cut_")


def parse_ntriples(lines: DataFrame, column: str) -> DataFrame:
    """s, p, o, kind (uri, blank, literal), datatype, lang of each line; comments and blank lines go."""
    line = F.trim(F.col(column))
    t = lines.where(~line.startswith("#") & (line != "")).select(line.alias("l"))
    t = _grouped(t.where(F.col("l").rlike(_HEAD)), "l", _HEAD, 4, "h")
    t = t.select(F.coalesce(F.nullif(F.col("h")[0], F.lit("")), F.col("h")[1]).alias("s"), F.col("h")[2].alias("p"), F.col("h")[3].alias("rest"))
    t = _grouped(t, "rest", _OBJECT_FAST, 5, "g")
    got = lambda n: F.nullif(F.col("g")[n - 1], F.lit(""))
    kind = F.when(F.col("rest").startswith("<"), "uri").when(F.col("rest").startswith("_:"), "blank").otherwise("literal")
    text = F.col("g")[2]
    # single escapes; a doubled backslash is set aside first
    for a, b in (("\\\\", "\x00"), ('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\x00", "\\")):
        text = F.replace(text, F.lit(a), F.lit(b))
    o = F.when(kind == "uri", F.coalesce(got(1), F.lit(""))).when(kind == "blank", got(2)).otherwise(text)
    return t.select("s", "p", o.alias("o"), kind.alias("kind"), got(4).alias("datatype"), got(5).alias("lang"))


def pdf_texts(spark: SparkSession, path: str, methods: list[tuple[str, Callable[[bytes], tuple[str, int]]]], least: int = X.MIN_TEXT) -> DataFrame:
    """Text of PDF files: the first method (name, function of the bytes giving text and pages) that yields enough characters.

    url, success, text, method, page_count, file_size_kb, error. Methods are plain functions, so that libraries for PDF
    or OCR are only needed where they are used.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return extract_texts(files, methods, least)


def extract_texts(files: DataFrame, methods: list[tuple[str, Callable[[bytes], tuple[str, int]]]], least: int = X.MIN_TEXT) -> DataFrame:
    def one(content: bytes) -> tuple[bool, str | None, str | None, int | None, str | None]:
        errors = []
        for name, method in methods:
            try:
                text, pages = method(content)
            except Exception as error:  # the next method may do
                errors.append(f"{name}: {error}")
                continue
            if len(text.strip()) >= least:
                return True, text, name, pages, None
            errors.append(f"{name}: only {len(text.strip())} characters")
        return False, None, None, None, "; ".join(errors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame([one(bytes(c)) for c in pdf["content"]], columns=["success", "text", "method", "page_count", "error"])
            out.insert(0, "url", pdf["path"].to_numpy())
            out["file_size_kb"] = pdf["content"].map(len).to_numpy() / 1024
            out["page_count"] = out["page_count"].astype("Int32")
            yield out[["url", "success", "text", "method", "page_count", "file_size_kb", "error"]]

    ship(files.sparkSession)
    return files.mapInPandas(run, "url string, success boolean, text string, method string, page_count int, file_size_kb double, error string")
