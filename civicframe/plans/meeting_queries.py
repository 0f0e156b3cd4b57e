"""Queries on meetings."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions import time as T
from civicframe.operators import meetings as M
from civicframe.plans import views as V
from civicframe.plans.registry import query

_DAY = "dayname(start_local)"
_HOUR = "cast(hour(start_local) as integer)"
_DAYS = "(values (1,'Monday'),(2,'Tuesday'),(3,'Wednesday'),(4,'Thursday'),(5,'Friday'),(6,'Saturday'),(7,'Sunday')) d(day, weekday)"


def _meetings(spark, d):
    return M.features(V.meetings(spark, d))


def _sessions(spark, d):
    return M.features(V.sessions(spark, d))


@query(V.sql(f"select id, {_DAY} as weekday, {_HOUR} as hour, cast(year(start_local) as integer) as year, cast(month(start_local) as integer) as month from local", "local"))
def meeting_features(spark, d):
    return _meetings(spark, d).select("id", "weekday", "hour", "year", "month")


@query(V.sql("select id, name, start, coalesce(cast(organization as varchar), 'Unknown') as organization from sessions", "sessions"))
def meeting_projection(spark, d):
    m = V.sessions(spark, d).withColumn("organizations", F.when(F.col("organization").isNotNull(), F.array(F.col("organization").cast("string"))).otherwise(F.array().cast("array<string>")))
    return m.select("id", "name", "start", F.coalesce(F.get("organizations", F.lit(0)), F.lit("Unknown")).alias("organization"))


@query(V.sql(f"select {_HOUR} as hour, count(*) as n from local group by 1", "local"))
def meetings_by_hour(spark, d):
    return M.count_by(_meetings(spark, d), "hour").orderBy("hour")


@query(V.sql(f"select day, d.weekday, coalesce(n, 0) as n from {_DAYS} left join (select {_DAY} as weekday, count(*) as n from local group by 1) x on d.weekday = x.weekday", "local"))
def meetings_by_weekday(spark, d):
    return M.by_weekday(_meetings(spark, d)).orderBy("day")


@query(V.sql(f"""w as (select day, d.weekday, coalesce(n, 0) as n from {_DAYS} left join (select {_DAY} as weekday, count(*) as n from local group by 1) x on d.weekday = x.weekday)
    select (select weekday from w order by n desc, day limit 1) as most, max(n) as most_n, (select weekday from w order by n, day limit 1) as least, min(n) as least_n from w""", "local"))
def weekday_extremes(spark, d):
    return M.weekday_extremes(_meetings(spark, d))


@query(V.sql(f"select {_DAY} as weekday, " + ", ".join(f"count(*) filter (where hour(start_local) = {h}) as h{h:02}" for h in range(24)) + " from local group by 1", "local"))
def weekday_hour_pivot(spark, d):
    return M.weekday_hour_pivot(_meetings(spark, d))


_YEARLY = "yearly as (select cast(year(start_local) as integer) as year, count(*) as total, count(*) filter (where hour(start_local) = 14) as at_hour, cast(count(*) filter (where hour(start_local) = 14) as double) * cast(100 as double) / cast(count(*) as double) as share from local_sessions group by 1)"


@query(V.sql(_YEARLY + " select * from yearly", "local_sessions"))
def yearly_stats(spark, d):
    return M.yearly(_sessions(spark, d)).orderBy("year")


@query(V.sql(_YEARLY + " select round(avg(total), 6) as mean_total, min(total) as min_total, max(total) as max_total, max(share) as max_share from yearly", "local_sessions"))
def yearly_summary(spark, d):
    return M.yearly(_sessions(spark, d)).agg(F.round(F.avg("total"), 6).alias("mean_total"), F.min("total").alias("min_total"), F.max("total").alias("max_total"), F.max("share").alias("max_share"))


@query(V.sql("select cast(year(start_local) as integer) as year, count(*) as n, year(start_local) > 1996 as late from local_sessions group by 1, 3", "local_sessions"))
def year_distribution(spark, d):
    return M.count_by(_sessions(spark, d), "year").withColumn("late", F.col("year") > 1996)


_NAMED = "named as (select s.*, case when s.organization is null then 'Unbekannt' else coalesce(org_name, cast(s.organization as varchar)) end as org_name from local_sessions s left join organizations o on s.organization = o.organization)"


@query(V.sql(_NAMED + " select id, org_name from named", "local_sessions", "organizations"))
def org_name_join(spark, d):
    return M.with_organization(V.sessions(spark, d), V.organizations(spark, d)).select("id", "org_name")


@query(V.sql(_NAMED + " select org_name, count(*) as n from named group by 1 order by n desc, org_name limit 10", "local_sessions", "organizations"))
def top_organizations(spark, d):
    return M.top(M.with_organization(V.sessions(spark, d), V.organizations(spark, d)), "org_name", 10)


@query(V.sql(_NAMED + f", t as (select org_name from named group by 1 order by count(*) desc, org_name limit 5) select org_name, {_HOUR} as hour, count(*) as n from named where org_name in (select org_name from t) group by 1, 2", "local_sessions", "organizations"))
def top5_org_hours(spark, d):
    m = M.with_organization(_sessions(spark, d), V.organizations(spark, d))
    return M.count_by(m.join(F.broadcast(M.top(m, "org_name", 5)), "org_name", "left_semi"), "org_name", "hour")


@query(V.sql("select id, start_local from local_sessions where start_local >= timestamp '1995-01-01' and start_local <= timestamp '1997-11-20'", "local_sessions"))
def meetings_date_range(spark, d):
    return _sessions(spark, d).where("start_local between timestamp_ntz '1995-01-01' and timestamp_ntz '1997-11-20'").select("id", "start_local")


@query(V.sql("select id, name, start_local from local where hour(start_local) >= 20 order by start_local, id limit 3", "local"))
def late_meetings(spark, d):
    return _meetings(spark, d).where("hour >= 20").orderBy("start_local", "id").limit(3).select("id", "name", "start_local")


_MIDNIGHT = "midnight as (select * from local_sessions where hour(start_local) = 0)"


@query(V.sql(_MIDNIGHT + " select count(*) as n, count(*) filter (where strftime(start_local, '%H:%M:%S') <> '00:00:00') as with_time, count(organization) as with_organization from midnight", "local_sessions"))
def midnight_meetings(spark, d):
    m = _sessions(spark, d).where("hour = 0")
    return m.agg(F.count("*").alias("n"), F.count_if(T.has_time(F.col("start_local"))).alias("with_time"), F.count("organization").alias("with_organization"))


@query(V.sql(_MIDNIGHT + " select strftime(start_local, '%Y-%m') as month, count(*) as n from midnight group by 1", "local_sessions"))
def midnight_timeline(spark, d):
    return _sessions(spark, d).where("hour = 0").groupBy(T.year_month(F.col("start_local")).alias("month")).agg(F.count("*").alias("n"))


@query(V.sql("m as (select id, name from local where hour(start_local) = 0), f as (select name, arg_min(finish is not null, id) as has_end from meetings group by name) select m.id, m.name, has_end from m left join f on m.name = f.name", "local"))
def midnight_has_end(spark, d):
    m = _meetings(spark, d)
    return M.midnight_has_end(m.where("hour = 0").select("id", "name"), V.meetings(spark, d))


@query(V.sql("select id, name, start from meetings where start >= timestamp '2024-01-10' and start < timestamp '2024-01-20'", "meetings"))
def scan_meetings_range(spark, d):
    return V.meetings(spark, d).where("start >= timestamp_ntz '2024-01-10' and start < timestamp_ntz '2024-01-20'").select("id", "name", "start")


@query(V.sql("select min(start) as first, max(start) as last, min(start_local) as first_local, max(start_local) as last_local from local", "local"))
def date_range(spark, d):
    return _meetings(spark, d).agg(F.min("start").alias("first"), F.max("start").alias("last"), F.min("start_local").alias("first_local"), F.max("start_local").alias("last_local"))


@query("select l_orderkey as id, cast(l_linenumber as integer) as pos, concat('item/', l_orderkey, '/', l_linenumber) as item_id, case when l_linenumber % 2 = 0 then concat('TOP ', l_linenumber) else l_returnflag end as item_name from (select distinct l_orderkey, l_linenumber, min(l_returnflag) over (partition by l_orderkey, l_linenumber) as l_returnflag from lineitem) x")
def agenda_items_by_meeting(spark, d):
    rows = V.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("flag"))
    item = F.concat(F.lit("item/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    inline = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("TOP "), F.col("l_linenumber").cast("string")))
    own = F.struct(F.col("l_linenumber").alias("n"), item.alias("id"), inline.alias("name"))
    nested = rows.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(own)).alias("agendaItem"))
    found = M.agenda_items(nested, rows.where("l_linenumber % 2 <> 0").select(item.alias("id"), F.col("flag").alias("name")))
    return found.select("id", F.split_part("item_id", F.lit("/"), F.lit(3)).cast("int").alias("pos"), "item_id", "item_name")
