"""Queries on data quality, processing state and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.functions import time as D
from civicframe.operators import quality as Q
from civicframe.operators import state as S
from civicframe.operators import topics as P
from civicframe.plans import views as V
from civicframe.plans.registry import query

# papers with faults: ids that repeat, bad dates, missing names, files without an URL
_FAULTY = "f as (select o_orderkey as n, case when o_orderkey % 50 <> 3 then concat('p', o_orderkey - o_orderkey % 20 // 19) end as id, case o_orderkey % 11 when 0 then null when 1 then '  ' else 'Vorlage' end as name, case o_orderkey % 13 when 0 then null when 1 then '15.01.2024' when 2 then '2024-02-30' when 3 then '2024-01-15T18:00:00Z' when 4 then '' else cast(cast(o_orderdate as date) as varchar) end as date, o_orderkey % 17 = 0 as no_url, o_orderkey % 4 <> 1 as has_file from orders)"


def _faulty(spark, d):
    k = F.col("o_orderkey")
    pid = F.when(k % 50 != 3, F.concat(F.lit("p"), (k - F.floor((k % 20) / 19)).cast("string")))
    name = F.when(k % 11 == 0, None).when(k % 11 == 1, "  ").otherwise("Vorlage")
    date = F.when(k % 13 == 0, None).when(k % 13 == 1, "15.01.2024").when(k % 13 == 2, "2024-02-30").when(k % 13 == 3, "2024-01-15T18:00:00Z").when(k % 13 == 4, "").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    file = F.when(k % 4 != 1, F.struct(F.when(k % 17 != 0, "https://x/y.pdf").alias("accessUrl")))
    return V.table(spark, d, "orders").select(k.alias("n"), pid.alias("id"), name.alias("name"), date.alias("date"), file.alias("main_file"))


def _row(severity, category, message, resource, field, where, source, value="cast(null as varchar)", expected="cast(null as varchar)"):
    return f"select '{severity}' as severity, '{category}' as category, '{message}' as message, {resource} as resource_id, '{field}' as field, {value} as value, {expected} as expected from {source} where {where}"


_PAPER_ISSUES = " union all ".join([
    *[_row("ERROR", "missing_field", f'Required field "{c}" is missing', "id", c, f"{c} is null", "f") for c in ("id", "name", "date")],
    _row("ERROR", "duplicate", "Duplicate paper ID", "id", "id", "nth > 1", "(select id, row_number() over (partition by id order by n) as nth from f where id is not null) y"),
    _row("ERROR", "invalid_date", "Invalid date format", "id", "date", "date <> '' and try_cast(substr(date, 1, 10) as date) is null", "f", "date", "'ISO 8601 format (YYYY-MM-DD)'"),
    _row("WARNING", "missing_field", "PDF accessUrl is missing", "id", "mainFile.accessUrl", "no_url and has_file", "f"),
    _row("WARNING", "empty_value", "Paper name is empty", "id", "name", "trim(name) = ''", "f"),
])


@query(f"with {_FAULTY} {_PAPER_ISSUES}")
def validate_papers(spark, d):
    return Q.validate_papers(_faulty(spark, d), "n")


_SPOTS = "l as (select c_custkey as n, case when c_custkey % 9 <> 0 then case when c_custkey % 7 = 0 then ' ' else c_name end end as text, case when c_custkey % 10 <> 0 then 'street' end as type, case when c_custkey % 8 <> 0 then concat('p', c_custkey) end as paper_id, case c_custkey % 6 when 0 then '95.5' when 1 then 'north' when 2 then null else '48.3' end as lat, case c_custkey % 5 when 0 then '-181' else '10.8' end as lon from customer)"
_NUM = "lat is not null and lon is not null and try_cast(lat as double) is not null and try_cast(lon as double) is not null"
_SPOT_ISSUES = " union all ".join([
    *[_row("WARNING", "missing_field", f'Field "{c}" is missing in location', "paper_id", c, f"{c} is null", "l") for c in ("text", "type", "paper_id")],
    _row("ERROR", "invalid_coordinates", "Latitude out of range", "paper_id", "coordinates.lat", _NUM + " and try_cast(lat as double) not between -90 and 90", "l", "lat", "'-90 to 90'"),
    _row("ERROR", "invalid_coordinates", "Longitude out of range", "paper_id", "coordinates.lon", _NUM + " and try_cast(lon as double) not between -180 and 180", "l", "lon", "'-180 to 180'"),
    _row("ERROR", "invalid_coordinates", "Coordinates must be numeric", "paper_id", "coordinates", "lat is not null and lon is not null and (try_cast(lat as double) is null or try_cast(lon as double) is null)", "l"),
    _row("WARNING", "empty_value", "Location text is empty", "paper_id", "text", "trim(text) = ''", "l"),
])


def _spots(spark, d):
    k = F.col("c_custkey")
    text = F.when(k % 9 != 0, F.when(k % 7 == 0, " ").otherwise(F.col("c_name")))
    lat = F.when(k % 6 == 0, "95.5").when(k % 6 == 1, "north").when(k % 6 != 2, "48.3")
    return V.table(spark, d, "customer").select(k.alias("n"), text.alias("text"), F.when(k % 10 != 0, "street").alias("type"), F.when(k % 8 != 0, F.concat(F.lit("p"), k.cast("string"))).alias("paper_id"), lat.alias("lat"), F.when(k % 5 == 0, "-181").otherwise("10.8").alias("lon"))


@query(f"with {_SPOTS} {_SPOT_ISSUES}")
def validate_locations(spark, d):
    return Q.validate_locations(_spots(spark, d))


def _report(spark, d):
    return validate_papers(spark, d).unionByName(validate_locations(spark, d))


@query(f"with {_FAULTY}, {_SPOTS}, i as ({_PAPER_ISSUES} union all {_SPOT_ISSUES}) select severity, category, field, count(*) as n from i group by 1, 2, 3")
def validation_report(spark, d):
    return _report(spark, d).groupBy("severity", "category", "field").agg(F.count("*").alias("n"))


@query(f"with {_FAULTY}, {_SPOTS}, i as ({_PAPER_ISSUES} union all {_SPOT_ISSUES}) select count(*) filter (where severity = 'ERROR') as errors, count(*) filter (where severity = 'WARNING') as warnings, count(*) filter (where severity = 'INFO') as infos, count(*) filter (where severity = 'ERROR') = 0 as is_valid from i")
def validation_summary(spark, d):
    return Q.summary(_report(spark, d))


@query("select 'WARNING' as severity, 'empty_data' as category, 'No papers to validate' as message, cast(null as varchar) as resource_id, 'rows' as field, cast(null as varchar) as value, cast(null as varchar) as expected where (select count(*) from region where r_regionkey < 0) = 0 union all select 'INFO', 'empty_data', 'No locations to validate', null, 'rows', null, null")
def validate_empty(spark, d):
    none = V.table(spark, d, "region").where("r_regionkey < 0")
    some = V.table(spark, d, "region")
    return Q.validate_empty(none, "WARNING", "papers").unionByName(Q.validate_empty(none, "INFO", "locations")).unionByName(Q.validate_empty(some, "WARNING", "rows"))


@query(f"with {_FAULTY} select 'id' as field, count(*) - count(id) as nulls from f union all select 'name', count(*) - count(name) from f union all select 'date', count(*) - count(date) from f")
def null_counts(spark, d):
    return Q.null_counts(_faulty(spark, d), ("id", "name", "date"))


@query(f"with {_FAULTY} select cast(sum(c - 1) as bigint) as duplicates from (select count(*) as c from f group by id) x")
def duplicate_ids(spark, d):
    return Q.duplicates(_faulty(spark, d), "id")


# state

_LAST = "last as (select * from state_log qualify row_number() over (partition by resource_id order by processed_at desc, seq desc) = 1)"


@query(V.sql(_LAST + " select * from last", "state_log"))
def state_latest(spark, d):
    return S.latest(V.state_log(spark, d))


@query(V.sql(_LAST + " select resource_id from last where status = 'completed'", "state_log"))
def processed_ids(spark, d):
    return S.processed_ids(V.state_log(spark, d))


@query(V.sql(_LAST + " select resource_id, processed_at from last where status = 'failed'", "state_log"))
def failed_resources(spark, d):
    return S.failed(V.state_log(spark, d)).select("resource_id", "processed_at")


@query(V.sql(_LAST + " select resource_type, status, count(*) as n from last group by 1, 2", "state_log"))
def state_statistics(spark, d):
    return S.statistics(V.state_log(spark, d))


@query(V.sql(_LAST + " select coalesce(resource_type, 'all') as resource_type, coalesce(status, 'all') as status, count(*) as n from last group by rollup (resource_type, status)", "state_log"))
def state_rollup(spark, d):
    return S.rollup(V.state_log(spark, d))


@query(V.sql(_LAST + " select resource_type, count(*) filter (where status = 'completed') as total_processed from last group by 1", "state_log"))
def checkpoint_total(spark, d):
    return S.checkpoint_totals(V.state_log(spark, d))


_POINTS = "points as (select resource_type, seq // 500 as batch, max(processed_at) as checkpoint_time, count(*) as batch_size from state_log group by 1, 2), cp as (select *, cast(sum(batch_size) over (partition by resource_type order by batch) as bigint) as total_processed from points)"


@query(V.sql(_POINTS + " select * from cp qualify row_number() over (partition by resource_type order by batch desc) = 1", "state_log"))
def last_checkpoint(spark, d):
    return S.last_checkpoint(S.checkpoints(V.state_log(spark, d), 500))


@query(V.sql(_POINTS + " select * from cp order by checkpoint_time desc, resource_type desc limit 5", "state_log"))
def recent_checkpoints(spark, d):
    return S.newest(S.checkpoints(V.state_log(spark, d), 500), 5, "checkpoint_time", "resource_type")


_RUNS = "runs as (select cast(o_orderkey as varchar) as run_id, cast(o_orderdate as timestamp) as start_time, cast(o_orderdate as timestamp) + to_seconds(o_custkey * 37) as end_time, o_orderkey, o_custkey * 37 as secs from orders)"


def _runs(spark, d):
    o = V.table(spark, d, "orders")
    start = F.col("o_orderdate").cast("timestamp_ntz")
    return o.select(F.col("o_orderkey").cast("string").alias("run_id"), start.alias("start_time"), (start + F.make_dt_interval(secs=(F.col("o_custkey") * 37).cast("decimal(18,6)"))).alias("end_time"), "o_orderkey")


@query(f"with {_RUNS} select run_id, start_time from runs order by start_time desc, o_orderkey desc limit 5")
def recent_runs(spark, d):
    return S.newest(_runs(spark, d), 5, "start_time", "o_orderkey").select("run_id", "start_time")


@query(f"with {_RUNS} select run_id, secs // 3600 as h, secs % 3600 // 60 as m, secs % 60 as s from runs")
def run_duration(spark, d):
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return _runs(spark, d).select("run_id", D.duration(seconds).alias("t")).select("run_id", "t.h", "t.m", "t.s")


@query(V.sql(_LAST + " select resource_id, seq from state_log where resource_id not in (select resource_id from last where status = 'failed')", "state_log"))
def clear_failed(spark, d):
    return S.clear_failed(V.state_log(spark, d)).select("resource_id", "seq")


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k, concat('{\"k\":', cast(json_extract(props, '$.k') as bigint), ',\"type\":\"', event_type, '\"}') as merged from events")
def checkpoint_metadata(spark, d):
    e = V.table(spark, d, "events").withColumn("m", S.from_metadata(F.col("props"), "k bigint"))
    return e.select("event_id", F.col("m.k").alias("k"), S.to_metadata(F.col("m.k").alias("k"), F.col("event_type").alias("type")).alias("merged"))


# topics

_TEXT = "concat('Vorlage ', o_orderkey, ' ', case o_orderkey % 5 when 0 then 'Neubau einer Schule mit Kita und Kindergarten' when 1 then 'Sanierung und Umbau, Modernisierung der Straße' when 2 then 'Verkehr: Bus und Fahrrad am Parkplatz' when 3 then 'Kultur und Museum' else 'Haushalt' end)"


def _score(words: tuple[str, ...]) -> str:
    return "cast(" + " + ".join(f"case when contains(lower(t), '{w}') then 1 else 0 end" for w in words) + f" as double) / cast({len(words)} as double)"


_SCORES = " union all ".join(f"select key, {i} as place, '{c}' as category, {_score(w)} as confidence from x" for i, (c, w) in enumerate(X.TOPICS.items()))


@query(f"with x as (select o_orderkey as key, {_TEXT} as t from orders), s as ({_SCORES}) select key, cast(row_number() over (partition by key order by confidence desc, place) - 1 as integer) as pos, category, confidence from s where confidence >= 0.3")
def topic_categories(spark, d):
    k = F.col("o_orderkey")
    subject = F.when(k % 5 == 0, "Neubau einer Schule mit Kita und Kindergarten").when(k % 5 == 1, "Sanierung und Umbau, Modernisierung der Straße").when(k % 5 == 2, "Verkehr: Bus und Fahrrad am Parkplatz").when(k % 5 == 3, "Kultur und Museum").otherwise("Haushalt")
    t = P.topic_text(F.concat(F.lit("Vorlage "), k.cast("string")), subject)
    o = V.table(spark, d, "orders").select(k.alias("key"), F.posexplode(P.scores(t)).alias("pos", "s"))
    return o.select("key", "pos", "s.category", "s.confidence")
