"""Queries on papers at rest, sources, text routing and journeys of papers."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions import text as T
from civicframe.operators import locations as L
from civicframe.operators import storage as S
from civicframe.plans import views as V
from civicframe.plans.location_queries import _GEO, _located
from civicframe.plans.registry import query
from civicframe.sources import files as R

_DATES = "case o_orderkey % 5 when 0 then 'unknown' when 1 then '' else cast(cast(o_orderdate as date) as varchar) end"


def _raw(spark, d):
    o, k = V.table(spark, d, "orders"), F.col("o_orderkey")
    date = F.when(k % 5 == 0, "unknown").when(k % 5 == 1, "").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return o.select(k.alias("key"), date.alias("date"))


@query(f"select o_orderkey as key, 'musterstadt' as city, cast(year(try_cast({_DATES} as date)) as integer) as year, cast(month(try_cast({_DATES} as date)) as integer) as month from orders")
def papers_prepared(spark, d):
    return S.prepare(_raw(spark, d), "Musterstadt").select("key", "city", "year", "month")


def _stored(spark, d):
    path = S.scratch(spark)
    S.write_batch(S.prepare(V.papers(spark, d), "Musterstadt").select("key", "name", "paper_type", "city", "year", "month"), path)
    return path


@query(V.sql("select key, name, paper_type, 'musterstadt' as city, cast(year(date) as integer) as year, cast(month(date) as integer) as month from papers", "papers"))
def read_all_papers(spark, d):
    return S.read_all(spark, _stored(spark, d)).select("key", "name", "paper_type", "city", "year", "month")


@query(V.sql("select key, name, cast(year(date) as integer) as year from papers where year(date) = 1996", "papers"))
def read_partition(spark, d):
    return S.read_partition(spark, _stored(spark, d), "musterstadt", 1996).select("key", "name", "year")


_TABLE = _GEO + ", lt as (select concat(p.id, '_', type, '_', replace(value, ' ', '_')) as location_id, p.id as paper_id, p.name as paper_name, cast(p.date as varchar) as paper_date, coalesce(p.pdf_url, '') as pdf_url, type as location_type, value as location_value, latitude, longitude, cast(null as varchar) as display_name, cast(null as varchar) as query, 'regex' as method, 'musterstadt' as city from geo g join papers p on p.key = g.key)"


def _table(spark, d, *keep):
    return S.locations_table(_located(spark, d, "id", "name", "pdf_url").drop("context").withColumn("method", F.lit("regex")), None, "key", "musterstadt", keep)


@query(V.sql(_TABLE + " select * from lt", "papers", "gazetteer"))
def locations_table(spark, d):
    return _table(spark, d).drop("context")


@query(V.sql(_TABLE + " select paper_id, location_name, printf('%.3f', latitude) as lat, printf('%.3f', longitude) as lon, concat('{\"type\":\"Feature\",\"title\":\"', paper_name, '\"}') as head from (select *, location_value as location_name from lt) x where latitude is not null and longitude is not null", "papers", "gazetteer"))
def geojson_features(spark, d):
    f = S.geojson_features(_table(spark, d), "musterstadt")
    title = F.get_json_object("feature", "$.properties.paper_title")
    kind = F.get_json_object("feature", "$.type")
    head = F.concat(F.lit('{"type":"'), kind, F.lit('","title":"'), title, F.lit('"}'))
    return f.select("paper_id", "location_name", F.format_string("%.3f", "latitude").alias("lat"), F.format_string("%.3f", "longitude").alias("lon"), head.alias("head"))


@query(V.sql(_TABLE + " select count(*) as count, count(distinct location_value) as unique_locations from lt where latitude is not null", "papers", "gazetteer"))
def geojson_metadata(spark, d):
    return S.geojson_metadata(S.geojson_features(_table(spark, d), "musterstadt"))


@query(V.sql("select key, name, modified from papers where modified >= date '1996-01-01' and modified < date '1997-01-01'", "papers"))
def scan_papers_modified_since(spark, d):
    return V.papers(spark, d).where("modified >= date'1996-01-01' and modified < date'1997-01-01'").select("key", "name", "modified")


@query(V.sql("select key, name from papers order by date desc, key limit 10", "papers"))
def limit_papers(spark, d):
    return V.papers(spark, d).orderBy(F.desc("date"), "key").limit(10).select("key", "name")


@query(V.sql("select cast(year(date) as integer) as year, count(*) as n from papers group by 1", "papers"))
def papers_by_year(spark, d):
    return V.papers(spark, d).groupBy(F.year("date").alias("year")).agg(F.count("*").alias("n"))


@query(V.sql("select paper_type, count(*) as n from papers group by 1 order by n desc, paper_type limit 10", "papers"))
def top_paper_types(spark, d):
    return V.papers(spark, d).groupBy("paper_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "paper_type").limit(10)


@query(V.sql("select cast(date_trunc('month', date) as date) as month, count(*) as n from papers where date >= date '1997-05-01' group by 1", "papers"))
def recent_by_month(spark, d):
    return V.papers(spark, d).where("date >= date'1997-05-01'").groupBy(F.trunc("date", "MM").alias("month")).agg(F.count("*").alias("n"))


@query("select o_orderkey as key from orders where o_orderkey not in (select user_id from events where event_type <> 'error')")
def skip_existing(spark, d):
    done = V.table(spark, d, "events").where("event_type <> 'error'").select(F.col("user_id").alias("key"))
    return S.skip_existing(V.table(spark, d, "orders").select(F.col("o_orderkey").alias("key")), done, "key")


@query(V.sql("select o_orderkey as key, o_orderstatus as status, length(full_text) as chars from orders left join papers on key = o_orderkey", "papers"))
def join_paper_text(spark, d):
    """Texts come to their papers by key, whatever order they were extracted in."""
    o = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    return o.join(V.papers(spark, d).select("key", "full_text"), "key", "left").select("key", "status", F.length("full_text").cast("long").alias("chars"))


@query(V.sql("select count(*) filter (where good) as good, count(*) filter (where not good) as failed from (select status <> 'F' and length(full_text) > 0 as good from papers) x", "papers"))
def split_valid_failed(spark, d):
    p = V.papers(spark, d).select((F.col("status") != "F").alias("success"), F.col("full_text").alias("text"))
    good, bad = S.split_by_success(p)
    return good.agg(F.count("*").alias("good")).crossJoin(bad.agg(F.count("*").alias("failed")))


@query(V.sql("select key, md5(coalesce(case when key % 3 = 0 then nullif('', '') when key % 3 = 1 then full_text end, case when key % 2 = 0 then 'pdf text' end, '')) as used, case when coalesce(case when key % 3 = 1 then full_text end, case when key % 2 = 0 then 'pdf text' end, '') = '' then 0 else 1 end as has_text from papers", "papers"))
def text_coalesce(spark, d):
    k = F.col("key")
    used = T.text_source(F.when(k % 3 == 0, "").when(k % 3 == 1, F.col("full_text")), F.when(k % 2 == 0, "pdf text"))
    return V.papers(spark, d).select("key", F.md5(used).alias("used"), F.when(used == "", 0).otherwise(1).alias("has_text"))


@query(V.sql("select key, case when key % 4 <> 0 then pdf_url when key % 3 = 0 then concat('file/', key) end as url, case when key % 4 <> 0 then pdf_url when key % 8 = 0 then null when key % 3 = 0 then concat('file/', key) end as compat_url from papers", "papers"))
def pdf_url_resolve(spark, d):
    k = F.col("key")
    main = F.when((k % 4 != 0) | (k % 8 == 0), F.struct(F.col("pdf_url").alias("accessUrl")))
    files = F.when(k % 3 == 0, F.array(F.struct(F.concat(F.lit("file/"), k.cast("string")).alias("accessUrl"))))
    p = V.papers(spark, d).select("key", main.alias("main"), files.alias("files"))
    return p.select("key", T.pdf_url(F.col("main"), F.col("files")).alias("url"), T.pdf_url(F.col("main"), F.col("files"), compat=True).alias("compat_url"))


@query("select o_orderkey as key from orders where not coalesce(o_orderstatus = 'F', false)")
def not_deleted(spark, d):
    o = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_orderstatus") == "F").alias("deleted"))
    return o.where(~F.coalesce("deleted", F.lit(False))).select("key")


@query("select p_partkey as key, p_name from part where contains(p_name, 'gear')")
def keyword_search(spark, d):
    return V.table(spark, d, "part").where(F.contains("p_name", F.lit("gear"))).select(F.col("p_partkey").alias("key"), "p_name")


@query(V.sql("select 'paper' as source, key, length(full_text) as chars from papers where lower(full_text) like '%bebauungsplan%' or lower(full_text) like '%b-plan%' union all select 'agenda', k, length(m) from mentions where lower(m) like '%bebauungsplan%' or lower(m) like '%b-plan%'", "papers"))
def bplan_references(spark, d):
    names = lambda c: F.lower(c).contains("bebauungsplan") | F.lower(c).contains("b-plan")
    p = V.papers(spark, d).where(names("full_text")).select(F.lit("paper").alias("source"), "key", F.length("full_text").cast("long").alias("chars"))
    m = V.mentions(spark, d).where(names("m")).select(F.lit("agenda").alias("source"), F.col("k").alias("key"), F.length("m").cast("long").alias("chars"))
    return p.unionByName(m)


@query("select page_id, case when regexp_matches(u, '^https?://') then u else concat('https://', u) end as url from (select page_id, case when page_id % 2 = 0 then regexp_replace(url, '^https?://', '') else url end as u from pages) x")
def normalize_url(spark, d):
    u = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url"))
    return V.table(spark, d, "pages").select("page_id", T.normalize_url(u).alias("url"))


@query("select page_id, case when u is null or split_part(u, '/', -1) = '' then 'unknown' else split_part(u, '/', -1) end as id from (select page_id, case page_id % 5 when 0 then null when 1 then concat(url, '/') else url end as u from pages) x")
def extract_id(spark, d):
    u = F.when(F.col("page_id") % 5 == 1, F.concat("url", F.lit("/"))).when(F.col("page_id") % 5 != 0, F.col("url"))
    return V.table(spark, d, "pages").select("page_id", T.last_segment(u).alias("id"))


@query(V.sql("select key, concat('https://records.example.org/paper/', key) as uri, concat('https://records.example.org/meeting/', name) as plain from papers", "papers"))
def generate_uri(spark, d):
    base = "https://records.example.org/"
    return V.papers(spark, d).select("key", T.generate_uri(base, F.lit("paper"), F.col("id")).alias("uri"), T.generate_uri(base, F.lit("meeting"), F.col("name")).alias("plain"))


def _features(spark, d):
    """The gazetteer as one GeoJSON document, read back."""
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(F.col("name").alias("id"), "name", F.lit("residential").alias("highway"), F.lit("osm").alias("source")).alias("properties"))
    doc = V.gazetteer(spark, d).agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value"))
    return R.geojson_features(doc, "value")


@query(V.sql("select distinct name, lower(name) as name_key from gazetteer", "gazetteer"))
def gazetteer_names(spark, d):
    return R.names(_features(spark, d))


@query(V.sql("select lower(name) as name_key, round(lat, 6) as lat, round(lon, 6) as lon from gazetteer", "gazetteer"))
def gazetteer_coords(spark, d):
    return R.coordinates(_features(spark, d)).select("name_key", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


def _elements(spark, d):
    """Map elements from parts: ways with a centre for most, named nodes, things without a name."""
    k = F.col("p_partkey")
    name = F.when(k % 7 != 0, V._street(F.col("p_name")))
    tags = F.map_from_arrays(F.array(F.lit("name"), F.when(k % 3 == 0, "highway").otherwise("ref")), F.array(name, F.col("p_brand")))
    node = k % 4 == 0
    center = F.when(~node & (k % 5 != 0), F.struct((k % 100).cast("double").alias("lat"), (k % 97).cast("double").alias("lon")))
    return V.table(spark, d, "part").select(k.alias("pos"), F.when(node, "node").otherwise("way").alias("type"), k.alias("id"), F.when(node, (k % 100).cast("double")).alias("lat"), F.when(node, (k % 97).cast("double")).alias("lon"), center.alias("center"), tags.alias("tags"))


_ELEMENTS = f"e as (select p_partkey as pos, case when p_partkey % 4 = 0 then 'node' else 'way' end as type, p_partkey as id, case when p_partkey % 7 <> 0 then {V._STREET} end as name, case when p_partkey % 3 = 0 then p_brand end as kind, case when p_partkey % 4 = 0 or p_partkey % 5 <> 0 then cast(p_partkey % 100 as double) end as lat, case when p_partkey % 4 = 0 or p_partkey % 5 <> 0 then cast(p_partkey % 97 as double) end as lon from part), f as (select * from e where name is not null and (type = 'node' or kind is not null))"


@query(f"with {_ELEMENTS} select pos, type, id, name, kind, lat, lon from f")
def osm_to_features(spark, d):
    return R.osm_features(_elements(spark, d))


@query(f"with {_ELEMENTS} select id, name, kind, lat, lon, 'osm' as source from f where type = 'way' and lat is not null qualify row_number() over (partition by name order by pos) = 1")
def gazetteer_build(spark, d):
    return R.build_gazetteer(R.osm_features(_elements(spark, d)).where("type = 'way'"))


@query("select r_regionkey as body, e.endpoint, e.endpoint <> 'person' and (r_regionkey % 2 = 0 or e.endpoint <> 'location') as available from region, (values ('paper'), ('meeting'), ('organization'), ('person'), ('location')) e(endpoint)")
def endpoint_availability(spark, d):
    names = ("paper", "meeting", "organization", "person", "location")
    r = V.table(spark, d, "region")
    url = lambda n: F.concat(F.lit(f"{V.API}{n}/"), F.col("r_name"))
    body = {n: url(n) for n in names}
    body["person"], body["location"] = F.lit(None).cast("string"), F.when(F.col("r_regionkey") % 2 == 0, url("location"))
    m = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[body[n] for n in names]))
    return r.select(F.col("r_regionkey").alias("body"), F.explode(m).alias("endpoint", "url")).select("body", "endpoint", F.col("url").isNotNull().alias("available"))


@query(V.sql("select p.key, c.item, org_name, count(*) as steps, count(*) filter (where authoritative) as decisive from papers p join consultations c on c.paper = p.key join organizations o on o.organization = c.organization group by 1, 2, 3", "papers", "consultations", "organizations"))
def paper_journey(spark, d):
    c = V.consultations(spark, d).join(F.broadcast(V.organizations(spark, d)), "organization")
    j = V.papers(spark, d).select("key").join(c, F.col("key") == F.col("paper"))
    return j.groupBy("key", "item", "org_name").agg(F.count("*").alias("steps"), F.count_if("authoritative").alias("decisive"))


@query(V.sql("select org_name, org_type, count(distinct c.paper) as papers from consultations c join organizations o on o.organization = c.organization group by 1, 2", "consultations", "organizations"))
def papers_by_organization(spark, d):
    c = V.consultations(spark, d).select("organization", "paper").distinct().groupBy("organization").agg(F.count("*").alias("papers"))
    return c.join(F.broadcast(V.organizations(spark, d)), "organization").select("org_name", "org_type", "papers")


_STRIPPED = "trim(regexp_replace(html, '<[^>]*>', ' ', 'g'))"
_TITLE = "trim(regexp_extract(html, '<title>([^<]*)</title>', 1))"


@query(f"select page_id, case when length(trim({_TITLE})) >= 60 then 'title' when length({_STRIPPED}) >= 100 then 'text' end as method, md5(case when length({_TITLE}) >= 60 then {_TITLE} when length({_STRIPPED}) >= 100 then {_STRIPPED} end) as digest from pages")
def text_cascade(spark, d):
    title = F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    text = F.trim(F.regexp_replace("html", "<[^>]*>", " "))
    c = F.coalesce(T.cascade([("title", title)], 60), T.cascade([("text", text)]))
    return V.table(spark, d, "pages").select("page_id", c["method"].alias("method"), F.md5(c["text"]).alias("digest"))


@query("select source, count(*) filter (where strlen(text) > 2000) as file, count(*) filter (where strlen(text) <= 2000) as memory, round(sum(strlen(text)) / cast(1024 as double), 6) as kb from documents group by 1")
def size_routing(spark, d):
    n = F.octet_length("text")
    way = S.size_route(n, 2000)
    return V.table(spark, d, "documents").groupBy("source").agg(F.count_if(way == "file").alias("file"), F.count_if(way == "memory").alias("memory"), F.round(F.sum(n.cast("long")) / F.lit(1024.0), 6).alias("kb"))
