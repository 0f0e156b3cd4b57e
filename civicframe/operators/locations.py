"""Place mentions of papers: dedup, validity, gazetteer joins, coordinates, caps, statistics.

A paper's mentions stay one array until they meet a table, so dedup and validity need no shuffle.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.functions import text as T
from civicframe.functions.text import let
from civicframe.session import ship

#: Largest gazetteer (names) that is broadcast without asking Spark's statistics.
SMALL_GAZETTEER = 100_000


def small(gazetteer: DataFrame, rows: int = SMALL_GAZETTEER) -> DataFrame:
    """A broadcast hint where the gazetteer is known to be small; else Spark decides by size."""
    return F.broadcast(gazetteer) if gazetteer.limit(rows + 1).count() <= rows else gazetteer


def first_wins(mentions: Column) -> Column:
    """Drops later mentions of the same type and (lower-cased) text."""
    key = lambda m: F.concat_ws("\x00", m["type"], F.lower(m["value"]))
    return let(mentions, lambda ms: let(F.transform(ms, key), lambda keys: F.filter(ms, lambda m, i: F.array_position(keys, F.get(keys, i)) == i + 1)))


def valid(mentions: Column, compat: bool = False) -> Column:
    return F.filter(mentions, lambda m: T.is_valid(m["value"], m["type"], compat))


def explode_mentions(papers: DataFrame, mentions: Column, *keep: str) -> DataFrame:
    """One row per mention: the kept columns, pos, type, value, context."""
    return papers.select(*keep, F.posexplode(mentions).alias("pos", "m")).select(*keep, "pos", "m.type", "m.value", "m.context")


def _matched(value: Column, kind: Column, compat: bool) -> Column:
    low = F.lower(value)
    return low if compat else F.when(kind == "address", F.lower(T.street_part(value))).otherwise(low)


def prefix_matches(short: Column, name: Column) -> Column:
    """A street name that begins with the text, if the text is 60 percent of it and at least five characters."""
    return name.startswith(short) & (F.length(short) >= F.greatest(F.lit(X.MIN_GAZETTEER), F.floor(F.length(name) * 3 / 5).cast("int")))


def prefix_join(mentions: DataFrame, gazetteer: DataFrame, value: Column) -> DataFrame:
    """Semi join by prefix, as an equi-join on the first five characters (both sides have as many) with the rest as a residue."""
    left = mentions.withColumn("short_", F.lower(value)).where(F.length("short_") >= X.MIN_GAZETTEER).withColumn("five_", F.left("short_", F.lit(5)))
    right = gazetteer.select(F.lower("name").alias("name_")).withColumn("five_g", F.left("name_", F.lit(5)))
    return left.join(right, (F.col("five_") == F.col("five_g")) & prefix_matches(F.col("short_"), F.col("name_")), "left_semi").drop("short_", "five_")


def firewall(mentions: DataFrame, gazetteer: DataFrame, compat: bool = False, look: str | None = None) -> DataFrame:
    """Keeps mentions whose text is a street, or begins one. By default an address is looked up without its number, and
    plans and parcels pass; ``compat`` looks up everything as it stands. ``look``: name for the text that was looked up, if it stays."""
    m = mentions.withColumn("short_", _matched(F.col("value"), F.col("type"), compat)).withColumn("five_", F.left("short_", F.lit(5)))
    names = small(gazetteer.select(F.lower("name").alias("name_")).withColumn("five_g", F.left("name_", F.lit(5))))
    known = names.where((F.col("five_g") == F.col("five_").outer()) & prefix_matches(F.col("short_").outer(), F.col("name_"))).exists()
    keep = known if compat else F.col("type").isin("bplan", "flurnummer") | known
    m = m.where(keep).drop("five_")
    return m.withColumnRenamed("short_", look) if look else m.drop("short_")


def cap(mentions: DataFrame, key: str, most: int = X.CAP) -> DataFrame:
    """Of papers with more than ``most`` mentions: the first one of each text, the first ``most`` of those."""
    paper = Window.partitionBy(key)
    m = mentions.withColumn("all_", F.count("*").over(paper)).withColumn("nth_", F.row_number().over(Window.partitionBy(key, F.lower("value")).orderBy("pos")))
    m = m.withColumn("place_", F.sum((F.col("nth_") == 1).cast("int")).over(paper.orderBy("pos")))
    return m.where((F.col("all_") <= most) | (F.col("nth_") == 1) & (F.col("place_") <= most)).drop("all_", "nth_", "place_")


def capped(locations: Column, most: int = X.CAP) -> Column:
    """The same as ``cap`` for one paper's array of locations, in their order."""
    keys = F.transform(locations, lambda m: F.lower(m["value"]))
    firsts = let(keys, lambda ks: F.filter(locations, lambda m, i: F.array_position(ks, F.get(ks, i)) == i + 1))
    return F.when(F.size(locations) <= most, locations).otherwise(F.slice(firsts, 1, most))


def with_coordinates(mentions: DataFrame, gazetteer: DataFrame, look: str | None = None) -> DataFrame:
    """Adds latitude, longitude and geo_precision from the gazetteer, by the street part of the text, which column ``look`` may hold already."""
    g = small(gazetteer.select(F.lower("name").alias("name_"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude")))
    text = F.col(look) if look else _matched(F.col("value"), F.col("type"), False)
    m = mentions.join(g, text == F.col("name_"), "left").drop("name_", *[look] * bool(look))
    return m.withColumn("geo_precision", F.when(F.col("latitude").isNotNull(), F.when(F.col("type") == "address", "street").otherwise("exact")))


def located(mentions: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Mentions behind the firewall with coordinates; each is looked up by the same text in both."""
    return with_coordinates(firewall(mentions, gazetteer, look="look_"), gazetteer, "look_")


def geocode(mentions: DataFrame, cache: DataFrame, city: Column) -> DataFrame:
    """Adds what the cache (cache_key, latitude, longitude, display_name, geo_type) knows; what a mention has already stays."""
    m = mentions.withColumn("cache_key", T.cache_key(F.col("value"), F.col("type"), city))
    c = cache.select("cache_key", *[F.col(n).alias(f"{n}_c") for n in ("latitude", "longitude", "display_name", "geo_type")])
    m = m.join(c, "cache_key", "left")
    return m.select(*[F.col(n) for n in mentions.columns if n not in ("latitude", "longitude")], F.coalesce("latitude", "latitude_c").alias("latitude"), F.coalesce("longitude", "longitude_c").alias("longitude"), F.col("display_name_c").alias("display_name"), F.col("geo_type_c").alias("geo_type"), F.col("latitude_c").isNotNull().alias("cached"))


CACHED = "cache_key string, latitude double, longitude double, display_name string, geo_type string"
#: value, type and city of a place -> latitude, longitude, display name, kind; or None
Resolver = Callable[[str, str, str], tuple[float, float, str, str] | None]


def resolve(mentions: DataFrame, cache: DataFrame, city: Column, resolver: Resolver, pause: float = 0.0, tasks: int = 1) -> DataFrame:
    """Rows for the cache: each place that it lacks is asked for once. Failures aren't cached, so they are tried again.

    ``pause``: seconds between questions of a task; with ``tasks`` that bounds how often a service is asked.
    """
    ship(mentions.sparkSession)
    wanted = mentions.select(T.cache_key(F.col("value"), F.col("type"), city).alias("cache_key"), "value", "type", city.alias("city")).dropDuplicates(["cache_key"])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, value, kind, where in pdf.itertuples(index=False):
                time.sleep(pause)
                if (found := resolver(value, kind, where)) is not None:
                    rows.append((key, *found))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in CACHED.split(", ")])

    return wanted.join(cache.select("cache_key"), "cache_key", "left_anti").coalesce(tasks).mapInPandas(ask, CACHED)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored cache, of each key once; empty before anything was stored."""
    try:
        return spark.read.schema(CACHED).parquet(path).dropDuplicates(["cache_key"])
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], CACHED)


def put_cache(rows: DataFrame, path: str) -> None:
    rows.select(*[x.split()[0] for x in CACHED.split(", ")]).write.mode("append").parquet(path)


def named_entities(text: Column, model: Callable[[list[str]], list[list[str]]]) -> Column:
    """array<string>: place names that a model (texts -> names of each) finds; to be joined with ``text.keyword_candidates``."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model(texts.fillna("").tolist()))

    return run(text)


def extract(papers: DataFrame, *keep: str, text: str = "full_text", compat: bool = False, wide: bool = False) -> DataFrame:
    """All valid mentions of papers, first ones only, one row each."""
    return explode_mentions(papers, valid(first_wins(T.mentions(F.col(text), wide)), compat), *keep)


def enrich(papers: DataFrame, gazetteer: DataFrame, key: str = "key") -> DataFrame:
    """Papers with ``locations`` (array of structs, in order) and ``location_count``."""
    m = located(extract(papers, key), gazetteer)
    loc = F.struct("pos", "type", "value", "context", "latitude", "longitude")
    nested = m.groupBy(key).agg(F.array_sort(F.collect_list(loc)).alias("locations")).withColumn("locations", capped(F.col("locations")))
    none = F.array().cast("array<struct<pos:int,type:string,value:string,context:string,latitude:double,longitude:double>>")
    return papers.join(nested, key, "left").withColumn("locations", F.coalesce("locations", none)).withColumn("location_count", F.size("locations"))


def flatten(papers: DataFrame, *keep: str) -> DataFrame:
    return papers.select(*keep, F.explode("locations").alias("l")).select(*keep, "l.*")


def statistics(papers: DataFrame) -> DataFrame:
    """One row: papers, with locations, mentions, geocoded ones, rates."""
    geo = F.size(F.filter("locations", lambda m: m["latitude"].isNotNull()))
    s = papers.agg(F.count("*").alias("papers"), F.count_if(F.size("locations") > 0).alias("with_locations"), F.sum(F.size("locations").cast("long")).alias("mentions"), F.sum(geo.cast("long")).alias("geocoded"))
    return s.withColumn("per_paper", F.round(F.try_divide(F.col("mentions").cast("double"), F.col("papers").cast("double")), 6)).withColumn("geocode_rate", F.round(F.try_divide(F.col("geocoded") * F.lit(100.0), F.col("mentions").cast("double")), 6))


def categories(papers: DataFrame, text: str) -> DataFrame:
    """How many texts name a plan, else a street, else neither."""
    low = F.lower(F.col(text))
    kind = F.when(low.rlike("bebauungsplan|b-plan"), "bebauungsplan").when(low.rlike("straße|platz|allee|weg|gasse"), "strasse").otherwise("other")
    return papers.groupBy(kind.alias("category")).agg(F.count("*").alias("n"))


def markers(geocoded: DataFrame) -> DataFrame:
    """One row per place: coordinates, how often it is mentioned, marker colour."""
    m = geocoded.where("latitude is not null and longitude is not null").groupBy("value").agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"), F.count("*").alias("n"))
    return m.withColumn("color", F.when(F.col("n") >= 2, "red").otherwise("blue"))
