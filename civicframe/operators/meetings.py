"""When the council meets: counts by local time, by organization, over years. One shuffle for each aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.functions import time as T


def features(meetings: DataFrame) -> DataFrame:
    """Adds start_local, weekday, hour, year, month; meetings without start go."""
    m = meetings.where("start is not null").withColumn("start_local", T.local(F.col("start")))
    at = F.col("start_local")
    return m.withColumns({"weekday": T.day_name(at), "hour": F.hour(at), "year": F.year(at), "month": F.month(at)})


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def by_weekday(df: DataFrame) -> DataFrame:
    """All seven days, with 0 where nothing meets."""
    days = df.sparkSession.createDataFrame([(i + 1, d) for i, d in enumerate(T.DAYS)], "day int, weekday string")
    return days.join(count_by(df, "weekday"), "weekday", "left").select("day", "weekday", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def weekday_extremes(df: DataFrame) -> DataFrame:
    """The fullest and the emptiest day; ties go to the earlier one."""
    days = by_weekday(df)
    return days.agg(F.max_by("weekday", F.struct("n", -F.col("day"))).alias("most"), F.max("n").alias("most_n"), F.min_by("weekday", F.struct("n", "day")).alias("least"), F.min("n").alias("least_n"))


def weekday_hour_pivot(df: DataFrame) -> DataFrame:
    """A row for each weekday, a column for each hour."""
    p = df.groupBy("weekday").pivot("hour", list(range(24))).count().na.fill(0)
    return p.select("weekday", *[F.col(str(h)).alias(f"h{h:02}") for h in range(24)])


def yearly(df: DataFrame, hour: int = 14) -> DataFrame:
    """Meetings of each year and the share (in percent) that starts in an hour."""
    return df.groupBy("year").agg(F.count("*").alias("total"), F.count_if(F.col("hour") == hour).alias("at_hour")).withColumn("share", F.col("at_hour").cast("double") * 100.0 / F.col("total").cast("double"))


def with_organization(meetings: DataFrame, organizations: DataFrame) -> DataFrame:
    """Adds org_name: the literal for a missing organization, the reference itself for an unknown one."""
    m = meetings.join(organizations.select("organization", "org_name"), "organization", "left")
    return m.withColumn("org_name", F.when(F.col("organization").isNull(), X.UNKNOWN_ORGANIZATION).otherwise(F.coalesce("org_name", F.col("organization").cast("string"))))


def top(df: DataFrame, key: str, n: int, name: str = "n") -> DataFrame:
    """The n most frequent values; ties by value."""
    return count_by(df, key, name=name).orderBy(F.desc(name), key).limit(n)


def midnight_has_end(midnight: DataFrame, meetings: DataFrame) -> DataFrame:
    """Whether the first meeting (by id) with the same name has an end."""
    first = meetings.groupBy("name").agg(F.min_by(F.struct("finish"), "id").alias("f")).select("name", F.col("f.finish").isNotNull().alias("has_end"))
    return midnight.join(first, "name", "left")


def agenda_items(meetings: DataFrame, items: DataFrame) -> DataFrame:
    """Items of meetings, whether inline (``agendaItem`` has structs with a name) or by reference (an id to look up)."""
    m = meetings.select("id", F.posexplode("agendaItem").alias("pos", "item"))
    known = items.select(F.col("id").alias("ref"), F.col("name").alias("found"))
    return m.join(known, F.col("item.id") == F.col("ref"), "left").select("id", "pos", F.col("item.id").alias("item_id"), F.coalesce("item.name", "found").alias("item_name"))
