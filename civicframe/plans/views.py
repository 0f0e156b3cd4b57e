"""The council's tables as views over the star schema: gazetteer, papers, meetings, organizations, consultations, state log.

Each view is there twice, as a DataFrame and as SQL of the same rows (``sql(name, ...)`` puts them into a WITH).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.functions import time as T

API = "https://api.example.org/"
CITY = "musterstadt"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _street(name: Column) -> Column:
    first, second = F.split_part(name, F.lit(" "), F.lit(1)), F.split_part(name, F.lit(" "), F.lit(2))
    return F.concat(F.upper(F.left(first, F.lit(1))), F.substring(first, 2, 1000), second, F.lit("straße"))


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """name, lat, lon; one part in five of the streets is left out."""
    key = F.min("p_partkey").alias("k")
    g = table(spark, folder, "part").groupBy(_street(F.col("p_name")).alias("name")).agg(key).where("k % 5 <> 0")
    return g.select("name", (F.lit(48.3) + (F.col("k") % 100).cast("double") / 1000.0).alias("lat"), (F.lit(10.8) + (F.col("k") % 97).cast("double") / 1000.0).alias("lon"))


def mentions(spark: SparkSession, folder: str) -> DataFrame:
    """k (paper), i, m (text of a mention): one for each line item."""
    d = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    street, n = _street(F.col("p_name")), F.col("l_linenumber")
    amount = F.col("l_quantity").cast("int").cast("string")
    m = F.when(n % 4 == 0, F.concat(street, F.lit(" "), amount)).when(n % 4 == 1, street)
    m = m.when(n % 4 == 2, F.concat(F.lit("Bebauungsplan Nr. "), F.col("l_partkey").cast("string"), F.lit("/"), amount))
    m = m.otherwise(F.concat(F.lit("Flurstück "), F.col("l_suppkey").cast("string"), F.lit("/"), n.cast("string")))
    return d.select(F.col("l_orderkey").alias("k"), n.alias("i"), m.alias("m"))


def papers(spark: SparkSession, folder: str) -> DataFrame:
    """key, id, name, reference, date, modified, paper_type, status, pdf_url, full_text, city."""
    text = mentions(spark, folder).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("ms"))
    text = text.select("k", F.array_join(F.transform("ms", lambda x: x["m"]), ", ").alias("full_text"))
    o = table(spark, folder, "orders").join(text, F.col("o_orderkey") == F.col("k"))
    key = F.col("o_orderkey")
    url = F.concat(F.lit(API + "file/"), key.cast("string"), F.lit(".pdf"))
    return o.select(
        key.alias("key"), F.concat(F.lit(API + "paper/"), key.cast("string")).alias("id"), F.concat(F.lit("Vorlage "), key.cast("string")).alias("name"),
        F.when(key % 3 != 0, F.concat(F.lit("BV/"), key.cast("string"))).alias("reference"), F.col("o_orderdate").cast("date").alias("date"), F.date_add(F.col("o_orderdate").cast("date"), (key % 10).cast("int")).alias("modified"),
        F.col("o_orderpriority").alias("paper_type"), F.col("o_orderstatus").alias("status"), F.when(key % 4 != 0, url).alias("pdf_url"), "full_text", F.lit(CITY).alias("city"),
    )


def meetings(spark: SparkSession, folder: str) -> DataFrame:
    """id, name, start (UTC), finish (null for some), organization, from events."""
    ts = F.col("ts").cast("timestamp_ntz")
    end = F.when(F.col("event_id") % 3 != 0, ts + F.expr("interval 2 hours"))
    return table(spark, folder, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("name"), ts.alias("start"), end.alias("finish"), (F.col("user_id") % 25).cast("int").alias("organization"), "value")


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Meetings over years: id, start (an hour of the order's day), organization (null for some), from orders."""
    key = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (key % 24).cast("int"))
    return table(spark, folder, "orders").select(key.alias("id"), start.alias("start"), F.when(key % 7 != 0, (F.col("o_custkey") % 29).cast("int")).alias("organization"), F.col("o_orderpriority").alias("name"))


def organizations(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "nation").join(F.broadcast(table(spark, folder, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_nationkey").alias("organization"), F.col("n_name").alias("org_name"), F.col("r_name").alias("org_type"))


def consultations(spark: SparkSession, folder: str) -> DataFrame:
    """paper, item, organization, authoritative, role: the bridge between papers, agenda items and organizations."""
    d = table(spark, folder, "lineitem").join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return d.select(F.col("l_orderkey").alias("paper"), F.col("l_linenumber").alias("item"), F.col("s_nationkey").alias("organization"), (F.col("l_returnflag") == "R").alias("authoritative"), F.col("l_linestatus").alias("role"))


def state_log(spark: SparkSession, folder: str) -> DataFrame:
    """resource_id, resource_type, status, processed_at, seq: an append-only log of what was processed."""
    status = F.when(F.col("event_type") == "error", "failed").otherwise("completed")
    return table(spark, folder, "events").select(F.col("user_id").alias("resource_id"), F.when(F.col("user_id") % 2 == 0, "paper").otherwise("meeting").alias("resource_type"), status.alias("status"), F.col("ts").cast("timestamp_ntz").alias("processed_at"), F.col("event_id").alias("seq"))


_STREET = "concat(upper(substr(split_part(p_name,' ',1),1,1)), substr(split_part(p_name,' ',1),2), split_part(p_name,' ',2), 'straße')"
VIEWS = {
    "gazetteer": f"""select {_STREET} as name, cast(48.3 as double) + cast(min(p_partkey) % 100 as double) / cast(1000 as double) as lat,
        cast(10.8 as double) + cast(min(p_partkey) % 97 as double) / cast(1000 as double) as lon from part group by 1 having min(p_partkey) % 5 <> 0""",
    "mentions": f"""select l_orderkey as k, l_linenumber as i, case l_linenumber % 4
        when 0 then concat({_STREET}, ' ', cast(cast(l_quantity as int) as varchar)) when 1 then {_STREET}
        when 2 then concat('Bebauungsplan Nr. ', cast(l_partkey as varchar), '/', cast(cast(l_quantity as int) as varchar))
        else concat('Flurstück ', cast(l_suppkey as varchar), '/', cast(l_linenumber as varchar)) end as m from lineitem join part on l_partkey = p_partkey""",
    "papers": """select o_orderkey as key, concat('https://api.example.org/paper/', o_orderkey) as id, concat('Vorlage ', o_orderkey) as name,
        case when o_orderkey % 3 <> 0 then concat('BV/', o_orderkey) end as reference, cast(o_orderdate as date) as date,
        cast(cast(o_orderdate as date) + cast(o_orderkey % 10 as integer) as date) as modified, o_orderpriority as paper_type, o_orderstatus as status,
        case when o_orderkey % 4 <> 0 then concat('https://api.example.org/file/', o_orderkey, '.pdf') end as pdf_url, full_text, 'musterstadt' as city
        from orders join (select k, string_agg(m, ', ' order by i, m) as full_text from mentions group by k) x on o_orderkey = k""",
    "meetings": """select event_id as id, event_type as name, ts as start, case when event_id % 3 <> 0 then ts + interval 2 hour end as finish,
        cast(user_id % 25 as integer) as organization, value from events""",
    "sessions": """select o_orderkey as id, cast(o_orderdate as timestamp) + to_hours(cast(o_orderkey % 24 as integer)) as start,
        case when o_orderkey % 7 <> 0 then cast(o_custkey % 29 as integer) end as organization, o_orderpriority as name from orders""",
    "organizations": "select n_nationkey as organization, n_name as org_name, r_name as org_type from nation join region on n_regionkey = r_regionkey",
    "consultations": """select l_orderkey as paper, l_linenumber as item, s_nationkey as organization, l_returnflag = 'R' as authoritative, l_linestatus as role
        from lineitem join supplier on l_suppkey = s_suppkey""",
    "state_log": """select user_id as resource_id, case when user_id % 2 = 0 then 'paper' else 'meeting' end as resource_type,
        case when event_type = 'error' then 'failed' else 'completed' end as status, ts as processed_at, event_id as seq from events""",
    "local": """select *, timezone('Europe/Berlin', timezone('UTC', start)) as start_local from meetings""",
    "local_sessions": """select *, timezone('Europe/Berlin', timezone('UTC', start)) as start_local from sessions""",
}
_NEEDS = {"papers": ("mentions",), "local": ("meetings",), "local_sessions": ("sessions",)}


def sql(select: str, *names: str) -> str:
    """WITH the named views (and what they need): the query."""
    order: list[str] = []
    for name in names:
        order += [n for n in (*_NEEDS.get(name, ()), name) if n not in order]
    return "with " + ", ".join(f"{n} as ({VIEWS[n]})" for n in order) + (" " if select.lstrip().lower().startswith("select") else ", ") + select


def local_meetings(spark: SparkSession, folder: str) -> DataFrame:
    return meetings(spark, folder).withColumn("start_local", T.local(F.col("start")))


def local_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return sessions(spark, folder).withColumn("start_local", T.local(F.col("start")))
