"""Queries on places."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.functions import text as T
from civicframe.operators import fuzzy
from civicframe.operators import locations as L
from civicframe.plans import views as V
from civicframe.plans.registry import query

# the same patterns for an engine without look-around and with ASCII word bounds
_I = "(?i)"
_STREET = X.STREET.replace(r"\b", "")
_Q = lambda p: p.replace("'", "''")


def _all(pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all(full_text, '{_I}{_Q(pattern)}', {group})"


_ADDRESSES = f"list_transform({_all(X.ADDRESS, 0)}, lambda x: regexp_replace(x, '\\s+', ' '))"
_STREETS = f"list_filter({_all(_STREET)}, lambda s: not list_contains(list_transform({_all(X.ADDRESS, 1)}, lambda a: lower(a)), lower(s)))"


def _typed(kind: str, values: str) -> str:
    return f"list_transform({values}, lambda v: {{'type': '{kind}', 'value': trim(v)}})"


_MENTIONS = "list_concat(list_concat(" + _typed("bplan", _all(X.BPLAN)) + ", " + _typed("flurnummer", _all(X.PARCEL)) + "), list_concat(" + _typed("address", _ADDRESSES) + ", " + _typed("street", _STREETS) + "))"
#: key, pos, type, value of all mentions; of the first ones; of the valid ones
_RAW = f"ms as (select key, date, {_MENTIONS} as ms from papers), raw as (select key, date, unnest(generate_series(0, len(ms) - 1)) as pos, unnest(ms) as m from ms), ex as (select key, date, cast(pos as integer) as pos, m.type as type, m.value as value from raw)"
_FIRST = _RAW + ", first_ as (select * from ex qualify row_number() over (partition by key, type, lower(value) order by pos) = 1)"
_BLOCK = ", ".join(f"'{w}'" for w in X.BLOCKLIST)
_GATE = f"regexp_matches(value, '{_Q(X.GATE)}')"
_NUMBERED = "type in ('bplan', 'flurnummer')"
_OK = f"(({_NUMBERED}) or {_GATE}) and length(value) <= 60 and ({_NUMBERED} or length(value) >= 3) and lower(value) not in ({_BLOCK}) and split_part(lower(value), ' ', 1) not in ({_BLOCK}) and ({_NUMBERED} or length(value) - length(replace(value, ' ', '')) <= 4)"
_VALID = _FIRST + f", valid as (select key, date, cast(row_number() over (partition by key order by pos) - 1 as integer) as pos, type, value from first_ where {_OK})"
_LOOK = "case when type = 'address' then lower(regexp_replace(value, '\\s+\\d+[a-zA-Z]?$', '')) else lower(value) end"
_HIT = "exists (select 1 from gazetteer g where starts_with(lower(g.name), look) and length(look) >= greatest(5, (length(g.name) * 3) // 5))"
_WALL = _VALID + f", wall as (select * from (select *, {_LOOK} as look from valid) v where ({_NUMBERED}) or {_HIT})"
_GEO = _WALL + ", geo as (select w.key, date, pos, type, value, lat as latitude, lon as longitude from wall w left join gazetteer g on w.look = lower(g.name))"


def _papers(spark, d):
    return V.papers(spark, d)


def _located(spark, d, *keep):
    """Mentions behind the firewall with coordinates; ``keep``: further columns of their papers."""
    return L.located(L.extract(_papers(spark, d), "key", "date", *keep), V.gazetteer(spark, d))


def _joined(column):
    return F.array_join(column, "; ")


@query(V.sql(f"select key, list_aggregate({_all(X.BPLAN)}, 'string_agg', '; ') as found, len({_all(X.BPLAN)}) as n, list_aggregate({_all(X.BPLAN, 0)}, 'string_agg', '; ') as context from papers where len({_all(X.BPLAN)}) > 0", "papers"))
def extract_bplans(spark, d):
    p = _papers(spark, d).withColumn("f", T.bplans(F.col("full_text"))).where("size(f) > 0")
    return p.select("key", _joined("f").alias("found"), F.size("f").cast("long").alias("n"), _joined(F.regexp_extract_all("full_text", F.lit(X.FLAGS + X.BPLAN), F.lit(0))).alias("context"))


@query(V.sql(f"select key, list_aggregate({_all(X.PARCEL)}, 'string_agg', '; ') as found, len({_all(X.PARCEL)}) as n from papers where len({_all(X.PARCEL)}) > 0", "papers"))
def extract_flurnummern(spark, d):
    return _papers(spark, d).withColumn("f", T.parcels(F.col("full_text"))).where("size(f) > 0").select("key", _joined("f").alias("found"), F.size("f").cast("long").alias("n"))


@query(V.sql(f"select key, list_aggregate({_all(X.ADDRESS, 1)}, 'string_agg', '; ') as street, list_aggregate({_all(X.ADDRESS, 2)}, 'string_agg', '; ') as number from papers where len({_all(X.ADDRESS)}) > 0", "papers"))
def extract_addresses(spark, d):
    p = _papers(spark, d).withColumn("a", T.addresses(F.col("full_text"))).where("size(a) > 0")
    return p.select("key", _joined(F.col("a.street")).alias("street"), _joined(F.col("a.number")).alias("number"))


@query(V.sql(f"select key, list_aggregate({_STREETS}, 'string_agg', '; ') as found from papers where len({_STREETS}) > 0", "papers"))
def extract_streets(spark, d):
    return _papers(spark, d).withColumn("f", T.streets(F.col("full_text"))).where("size(f) > 0").select("key", _joined("f").alias("found"))


@query("select c_custkey as key, list_aggregate(list_filter(list_transform(regexp_extract_all(t, '(?i)" + X.DISTRICT + "', 1), lambda x: trim(x)), lambda x: length(x) > 3), 'string_agg', '; ') as found from (select c_custkey, concat('Sanierung im Stadtteil ', c_mktsegment, ', Beschluss') as t from customer) x")
def extract_districts(spark, d):
    t = F.concat(F.lit("Sanierung im Stadtteil "), F.col("c_mktsegment"), F.lit(", Beschluss"))
    return V.table(spark, d, "customer").select(F.col("c_custkey").alias("key"), _joined(T.districts(t)).alias("found"))


@query(V.sql(_VALID + " select key, pos, type, value from valid", "papers"))
def extract_locations(spark, d):
    return L.extract(_papers(spark, d), "key").select("key", "pos", "type", "value")


@query(V.sql(_FIRST + " select key, type, value from first_", "papers"))
def dedup_mentions(spark, d):
    return L.explode_mentions(_papers(spark, d), L.first_wins(T.mentions(F.col("full_text"))), "key").select("key", "type", "value")


def _texts(spark, d):
    """Mentions and words, good and bad, to test predicates on."""
    v = L.explode_mentions(_papers(spark, d), T.mentions(F.col("full_text")), "key").select("type", "value").distinct()
    return v.union(v.sparkSession.createDataFrame([("street", w) for w in (*X.BLOCKLIST, "Programm 2024", "A", "AB", "Ab Cd Ef Gh Ij Kl", "Konrad-Adenauer-Allee", "12 34", "Platz " * 12)], "type string, value string"))


_WORDS = ", ".join("('street', '" + w + "')" for w in (*X.BLOCKLIST, "Programm 2024", "A", "AB", "Ab Cd Ef Gh Ij Kl", "Konrad-Adenauer-Allee", "12 34", "Platz " * 12))
_TEXTS = _RAW + f", texts as (select distinct type, value from ex union all select * from (values {_WORDS}) v(type, value))"


@query(V.sql(_TEXTS + f" select type, value, regexp_matches(trim(value), '{_Q(X.GATE)}') as ok from texts", "papers"))
def gatekeeper_filter(spark, d):
    return _texts(spark, d).withColumn("ok", T.passes_gate(F.col("value")))


@query(V.sql(_TEXTS + f" select type, value from texts where lower(trim(value)) not in ({_BLOCK}) and split_part(lower(trim(value)), ' ', 1) not in ({_BLOCK})", "papers"))
def blocklist_filter(spark, d):
    return _texts(spark, d).where(T.not_blocked(F.col("value")))


@query(V.sql(_TEXTS + f", t as (select type, value as v, trim(value) as value from texts) select type, v as value, {_OK} and ({_NUMBERED} or not regexp_matches(replace(value, ' ', ''), '^\\d+$')) as ok from t", "papers"))
def location_validity(spark, d):
    return _texts(spark, d).withColumn("ok", T.is_valid(F.col("value"), F.col("type")))


@query(V.sql(_WALL + " select key, pos, type, value from wall", "papers", "gazetteer"))
def gazetteer_firewall(spark, d):
    return L.firewall(L.extract(_papers(spark, d), "key"), V.gazetteer(spark, d)).select("key", "pos", "type", "value")


@query(V.sql("p as (select p_partkey as k, substr(name, 1, 5 + p_partkey % 12) as look from part join (select *, concat(upper(substr(split_part(p_name,' ',1),1,1)), substr(split_part(p_name,' ',1),2), split_part(p_name,' ',2), 'straße') as name from part) x using (p_partkey)) select k, look from (select k, lower(look) as look from p) y where " + _HIT, "gazetteer"))
def gazetteer_prefix_join(spark, d):
    p = V.table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.lower(F.substring(V._street(F.col("p_name")), F.lit(1), (5 + F.col("p_partkey") % 12).cast("int"))).alias("look"))
    return L.prefix_join(p, V.gazetteer(spark, d), F.col("look")).select("k", "look")


@query(V.sql(_RAW + ", c as (select l_suppkey as key, pos, m as value, count(*) over (partition by l_suppkey) as n, row_number() over (partition by l_suppkey, lower(m) order by pos) as nth from (select l_suppkey, m, row_number() over (partition by l_suppkey order by k, i, m) as pos from (select l_suppkey, k, i, m from lineitem join mentions on k = l_orderkey and i = l_linenumber group by all) x) y), r as (select *, sum(case when nth = 1 then 1 else 0 end) over (partition by key order by pos) as place from c) select key, cast(pos as integer) as pos, value from r where n <= 50 or nth = 1 and place <= 50", "papers"))
def cap_locations(spark, d):
    """Mentions by supplier, since papers have fewer than the cap."""
    from pyspark.sql import Window

    m = V.mentions(spark, d).distinct()
    li = V.table(spark, d, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i")).distinct()
    m = li.join(m, ["k", "i"]).withColumn("pos", F.row_number().over(Window.partitionBy("l_suppkey").orderBy("k", "i", "m")))
    return L.cap(m.select(F.col("l_suppkey").alias("key"), "pos", F.col("m").alias("value")), "key")


@query(V.sql(_GEO + " select key, pos, type, value, latitude, longitude from geo", "papers", "gazetteer"))
def location_coords(spark, d):
    return _located(spark, d).select("key", "pos", "type", "value", "latitude", "longitude")


@query(V.sql(_GEO + ", s as (select p.key, count(g.key) as n, count(latitude) as geocoded, string_agg(value, '; ' order by pos) as found from papers p left join geo g on p.key = g.key group by 1) select key, n as location_count, geocoded, coalesce(found, '') as found from s", "papers", "gazetteer"))
def enrich_papers(spark, d):
    p = L.enrich(_papers(spark, d), V.gazetteer(spark, d))
    return p.select("key", F.col("location_count").cast("long").alias("location_count"), F.size(F.filter("locations", lambda m: m["latitude"].isNotNull())).cast("long").alias("geocoded"), _joined(F.col("locations.value")).alias("found"))


@query(V.sql(_GEO + " select key, type, value, latitude from geo", "papers", "gazetteer"))
def flatten_locations(spark, d):
    return L.flatten(L.enrich(_papers(spark, d), V.gazetteer(spark, d)), "key").select("key", "type", "value", "latitude")


@query(V.sql(_GEO + ", p as (select count(*) as papers from papers), g as (select count(distinct key) as with_locations, count(*) as mentions, count(latitude) as geocoded from geo) select papers, with_locations, mentions, geocoded, round(cast(mentions as double) / cast(papers as double), 6) as per_paper, round(geocoded * cast(100 as double) / cast(mentions as double), 6) as geocode_rate from p, g", "papers", "gazetteer"))
def pipeline_stats(spark, d):
    return L.statistics(L.enrich(_papers(spark, d), V.gazetteer(spark, d)))


@query(V.sql("s as (select distinct key, cast(year(date) as integer) as year, unnest(" + _all(_STREET) + ") as street from papers) select street, year, count(*) as papers, min(lat) as lat, min(lon) as lon from s join gazetteer g on lower(s.street) = lower(g.name) group by 1, 2", "papers", "gazetteer"))
def attention_by_street_year(spark, d):
    """The flagship: how attention is spread over streets and years."""
    p = _papers(spark, d).select("key", F.year("date").alias("year"), F.explode(F.array_distinct(T.matches(F.col("full_text"), X.STREET))).alias("street"))
    g = L.small(V.gazetteer(spark, d))
    return p.join(g, F.lower("street") == F.lower("name")).groupBy("street", "year").agg(F.count("*").alias("papers"), F.min("lat").alias("lat"), F.min("lon").alias("lon"))


_TOP = " group by value order by n desc, value limit 15"


@query(V.sql(_GEO + " select value, count(*) as n from geo" + _TOP, "papers", "gazetteer"))
def top_locations(spark, d):
    return _located(spark, d).groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(15)


@query(V.sql(_GEO + " select value, count(*) as n from geo where value not in ('Oldgearstraße', 'Redboltstraße')" + _TOP, "papers", "gazetteer"))
def non_city_locations(spark, d):
    return _located(spark, d).where(~F.col("value").isin("Oldgearstraße", "Redboltstraße")).groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(15)


@query(V.sql(_GEO + " select key, value, latitude, longitude from geo where latitude is not null and longitude is not null", "papers", "gazetteer"))
def geocoded_only(spark, d):
    return _located(spark, d).where("latitude is not null and longitude is not null").select("key", "value", "latitude", "longitude")


@query(V.sql(_GEO + " select type, count(*) filter (where latitude is not null) as found, count(*) filter (where latitude is null) as missing from geo group by 1", "papers", "gazetteer"))
def geocode_success(spark, d):
    return _located(spark, d).groupBy("type").agg(F.count_if(F.col("latitude").isNotNull()).alias("found"), F.count_if(F.col("latitude").isNull()).alias("missing"))


@query(V.sql(_GEO + " select value, min(latitude) as latitude, min(longitude) as longitude, count(*) as n, case when count(*) >= 2 then 'red' else 'blue' end as color from geo where latitude is not null group by 1", "papers", "gazetteer"))
def map_markers(spark, d):
    return L.markers(_located(spark, d))


@query(V.sql(_GEO + " select count(distinct value) as places, count(distinct lower(value)) as folded, count(distinct type) as types from geo", "papers", "gazetteer"))
def distinct_locations(spark, d):
    return _located(spark, d).agg(F.count_distinct("value").alias("places"), F.count_distinct(F.lower("value")).alias("folded"), F.count_distinct("type").alias("types"))


@query(V.sql(_GEO + " select type, count(*) as n from geo group by 1", "papers", "gazetteer"))
def locations_by_type(spark, d):
    return _located(spark, d).groupBy("type").agg(F.count("*").alias("n"))


@query(V.sql(_GEO + " select p.id, p.name, p.pdf_url, count(*) as n from geo g join papers p on p.key = g.key group by 1, 2, 3 order by n desc, p.id limit 10", "papers", "gazetteer"))
def top_papers_by_locations(spark, d):
    p = _papers(spark, d).select("key", "id", "name", "pdf_url")
    return _located(spark, d).join(p, "key").groupBy("id", "name", "pdf_url").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "id").limit(10)


@query(V.sql(_GEO + " select key, type, value, latitude from geo where key = 7", "papers", "gazetteer"))
def paper_locations_lookup(spark, d):
    return _located(spark, d).where("key = 7").select("key", "type", "value", "latitude")


@query(V.sql("select case when lower(full_text) like '%bebauungsplan%' or lower(full_text) like '%b-plan%' then 'bebauungsplan' when regexp_matches(lower(full_text), 'straße|platz|allee|weg|gasse') then 'strasse' else 'other' end as category, count(*) as n from papers group by 1", "papers"))
def location_category_stats(spark, d):
    return L.categories(_papers(spark, d), "full_text")


@query(V.sql("w as (select key, unnest(string_split(replace(full_text, ',', ''), ' ')) as word from papers) select distinct key, word from w where length(word) > 4 and regexp_matches(lower(word), 'straße|platz|allee|weg|gasse')", "papers"))
def keyword_candidates(spark, d):
    return _papers(spark, d).select("key", F.explode(T.keyword_candidates(F.col("full_text"))).alias("word"))


@query(V.sql("w as (select key, unnest(string_split(replace(full_text, ',', ''), ' ')) as word from papers), s as (select key, unnest(" + _all(_STREET) + ") as word from papers) select key, word from w where length(word) > 4 and regexp_matches(lower(word), 'straße|platz|allee|weg|gasse') union select key, word from s", "papers"))
def candidate_union(spark, d):
    words = F.array_union(T.keyword_candidates(F.col("full_text")), T.matches(F.col("full_text"), X.STREET))
    return _papers(spark, d).select("key", F.explode(words).alias("word"))


def _titles(spark, d):
    s, k = V._street(F.col("p_name")), F.col("p_partkey")
    t = F.when(k % 4 == 0, F.concat(F.lit("Ausbau ‚"), s, F.lit("' in Mitte"))).when(k % 4 == 1, F.concat(F.lit("Umbau der "), s)).when(k % 4 == 2, F.concat(F.lit("Kita im Bereich "), F.initcap(F.split_part("p_name", F.lit(" "), F.lit(2))))).otherwise(F.lit("haushalt 2024"))
    return V.table(spark, d, "part").select(k.alias("key"), t.alias("title"))


_TITLES = f"titles as (select p_partkey as key, case p_partkey % 4 when 0 then concat('Ausbau ‚', {V._STREET}, ''' in Mitte') when 1 then concat('Umbau der ', {V._STREET}) when 2 then concat('Kita im Bereich ', upper(substr(split_part(p_name,' ',2),1,1)), substr(split_part(p_name,' ',2),2)) else 'haushalt 2024' end as title from part)"


def _one(pattern: str) -> str:
    return f"nullif(regexp_extract(title, '{_Q(pattern)}', 1), '')"


@query(f"with {_TITLES} select key, title, coalesce(case when regexp_matches(lower({_one(X.TITLE_QUOTED)}), '{X.TITLE_QUOTED_END}') then {_one(X.TITLE_QUOTED)} end, {_one(X.TITLE_STREET)}, {_one(X.TITLE_DISTRICT)}) as place from titles")
def title_location(spark, d):
    return _titles(spark, d).withColumn("place", T.title_location(F.col("title")))


@query(V.sql(_VALID + " select key, pos, md5(lower(value)) as plain, md5(concat(lower(value), '|', type, '|musterstadt')) as full_key from valid", "papers"))
def cache_key(spark, d):
    m = L.extract(_papers(spark, d), "key")
    return m.select("key", "pos", T.cache_key(F.col("value")).alias("plain"), T.cache_key(F.col("value"), F.col("type"), F.lit("Musterstadt")).alias("full_key"))


@query(V.sql(_VALID + " select key, pos, case when type in ('bplan', 'flurnummer') then '' when type = 'address' then concat(value, ', Musterstadt, Deutschland; Musterstadt, Deutschland') else concat(value, ', Musterstadt, Deutschland') end as asked from valid", "papers"))
def geocode_queries(spark, d):
    m = L.extract(_papers(spark, d), "key")
    return m.select("key", "pos", _joined(T.geocode_queries(F.col("value"), F.col("type"), F.lit("Musterstadt"))).alias("asked"))


def _cache(spark, d):
    g = V.gazetteer(spark, d)
    return g.select(T.cache_key(F.col("name"), F.lit("street"), F.lit("musterstadt")).alias("cache_key"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.concat("name", F.lit(", Musterstadt")).alias("display_name"), F.lit("residential").alias("geo_type"))


_CACHED = _VALID + ", cached as (select key, pos, type, value, lat, lon, case when name is not null then concat(name, ', Musterstadt') end as display_name, name is not null as hit from valid v left join gazetteer g on md5(concat(lower(value), '|', type, '|musterstadt')) = md5(concat(lower(g.name), '|street|musterstadt')))"


@query(V.sql(_CACHED + " select key, pos, lat as latitude, lon as longitude, display_name, hit as cached from cached", "papers", "gazetteer"))
def geocode_cache_join(spark, d):
    m = L.extract(_papers(spark, d), "key").withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")})
    return L.geocode(m, _cache(spark, d), F.lit("musterstadt")).select("key", "pos", "latitude", "longitude", "display_name", "cached")


@query(V.sql(_GEO + " select key, pos, value, latitude, longitude, case when type = 'street' and latitude is not null then 'residential' end as geo_type from geo", "papers", "gazetteer"))
def geocode_batch(spark, d):
    """What the gazetteer knows stays; the cache fills the rest."""
    return L.geocode(_located(spark, d), _cache(spark, d), F.lit("musterstadt")).select("key", "pos", "value", "latitude", "longitude", "geo_type")


@query(V.sql(_GEO + " select key, pos, type, value, latitude as lat, longitude as lon, case when type = 'street' and latitude is not null then 'residential' end as geo_type from geo", "papers", "gazetteer"))
def merge_geocode(spark, d):
    """The mention's own type stays beside the geocoder's; coordinates as a struct."""
    m = L.geocode(_located(spark, d), _cache(spark, d), F.lit("musterstadt")).withColumn("coordinates", F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")))
    return m.select("key", "pos", "type", "value", "coordinates.lat", "coordinates.lon", "geo_type")


@query(V.sql("select name, concat('<http://www.opengis.net/def/crs/EPSG/0/4326> POINT(', printf('%.3f', lon), ' ', printf('%.3f', lat), ')') as wkt from gazetteer", "gazetteer"))
def to_wkt(spark, d):
    return V.gazetteer(spark, d).select("name", T.wkt(F.col("lat"), F.col("lon"), digits=3).alias("wkt"))


@query(V.sql("select name, concat(printf('%.3f', lon), ' ', printf('%.3f', lat)) as coordinates from gazetteer", "gazetteer"))
def wkt_coords(spark, d):
    return V.gazetteer(spark, d).select("name", T.wkt_coordinates(T.wkt(F.col("lat"), F.col("lon"), digits=3)).alias("coordinates"))


def _typos(spark, d):
    """Street names with an edit: a letter less, or two words."""
    g = V.gazetteer(spark, d)
    return g.select(F.concat(F.left("name", F.lit(3)), F.substring("name", 5, 100)).alias("candidate")).union(g.select(F.concat(F.lit("neue "), "name"))).union(g.select(F.concat(F.left("name", F.lit(2)), F.lit("platz"))))


@query()
def fuzzy_match_streets(spark, d):
    return fuzzy.best_matches(_typos(spark, d), V.gazetteer(spark, d))


_FOLD = "replace(replace(replace(replace(lower({}), 'ä', 'a'), 'ö', 'o'), 'ü', 'u'), 'ß', 'ss')"


@query(V.sql("c as (select concat(substr(name,1,3), substr(name,5)) as candidate from gazetteer union select concat('neue ', name) from gazetteer union select concat(substr(name,1,2), 'platz') from gazetteer), p as (select candidate, name as street, levenshtein(" + _FOLD.format("candidate") + ", " + _FOLD.format("name") + ") as edits from c, gazetteer) select candidate, street, cast(edits as integer) as edits from p qualify row_number() over (partition by candidate order by edits, street) = 1", "gazetteer"))
def fuzzy_levenshtein_streets(spark, d):
    return fuzzy.nearest_by_edits(_typos(spark, d), V.gazetteer(spark, d))


@query()
def locations_with_coords(spark, d):
    """Candidates by keyword, cleaned by fuzzy match, with coordinates of the gazetteer."""
    g = V.gazetteer(spark, d)
    c = _papers(spark, d).select("key", F.explode(T.keyword_candidates(F.col("full_text"))).alias("candidate"))
    best = fuzzy.best_matches(c, g).select("candidate", "street")
    return c.join(best, "candidate").select("key", "street").distinct().join(L.small(g), F.lower("street") == F.lower("name"), "left").select("key", "street", "lat", "lon")


@query(V.sql("select k, l.name, lat, lon, id as linked from (select p_partkey as k, " + V._STREET + " as name from part) l left join (select name as n, concat('Q', row_number() over (order by name)) as id, lat, lon from gazetteer) g on lower(l.name) = lower(g.n)", "gazetteer"))
def entity_link(spark, d):
    """Places linked to an offline table of entities: the first hit of each name."""
    from pyspark.sql import Window

    g = V.gazetteer(spark, d).withColumn("linked", F.concat(F.lit("Q"), F.row_number().over(Window.orderBy("name")).cast("string")))
    p = V.table(spark, d, "part").select(F.col("p_partkey").alias("k"), V._street(F.col("p_name")).alias("name"))
    return p.join(L.small(g.withColumnRenamed("name", "n")), F.lower("name") == F.lower("n"), "left").select("k", "name", "lat", "lon", "linked")
