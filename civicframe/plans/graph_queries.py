"""Queries on the graph of papers and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.operators import graph as G
from civicframe.plans import views as V
from civicframe.plans.record_queries import _TABLE, _table
from civicframe.plans.registry import query
from civicframe.sources import files as R


def _t(s: str, p: str, o: str, where: str, source: str, kind: str = "literal", datatype: str | None = None, lang: str | None = None) -> str:
    q = lambda v: f"'{v}'" if v else "cast(null as varchar)"
    return f"select {s} as s, '{p}' as p, {o} as o, '{kind}' as kind, {q(datatype)} as datatype, {q(lang)} as lang from {source} where {where}"


_PAPER = " union ".join([
    _t("id", X.RDF_TYPE, f"'{X.OPARL}Paper'", "true", "papers", "uri"), _t("id", X.LABEL, "name", "true", "papers", lang="de"), _t("id", X.TERMS + "title", "name", "true", "papers"),
    _t("id", X.TERMS + "identifier", "reference", "reference is not null", "papers"), _t("id", X.TERMS + "date", "cast(date as varchar)", "true", "papers", datatype=X.XSD + "date"),
    _t("id", X.TERMS + "type", "paper_type", "true", "papers"), _t("id", X.TERMS + "description", "substr(full_text, 1, 1000)", "full_text <> ''", "papers"),
    _t("id", X.TERMS + "hasFormat", "pdf_url", "pdf_url is not null", "papers", "uri"), _t("id", X.TERMS + "modified", "strftime(modified, '%Y-%m-%dT%H:%M:%S')", "true", "papers", datatype=X.XSD + "dateTime"),
])
_S = f"concat('{G.BASE}location/', translate(concat(paper_id, '_', location_type, '_', location_value), ' /', '_-'))"
_NODES = f"ln as (select *, {_S} as s_ from lt)"
_PLACES = " union ".join([
    _t("paper_id", X.OPARL + "relatesToLocation", "s_", "true", "ln", "uri"), _t("s_", X.RDF_TYPE, f"'{X.GEO}Feature'", "true", "ln", "uri"), _t("s_", X.LABEL, "location_value", "location_value <> ''", "ln", lang="de"),
    _t("s_", X.OPARL + "locationType", "location_type", "true", "ln"),
    _t("s_", X.GEO + "hasGeometry", f"concat('<{X.CRS}4326> POINT(', printf('%.3f', longitude), ' ', printf('%.3f', latitude), ')')", "latitude is not null", "ln", datatype=X.GEO + "wktLiteral"),
    _t("s_", X.GEO + "lat", "printf('%.3f', latitude)", "latitude is not null", "ln", datatype=X.XSD + "double"), _t("s_", X.GEO + "long", "printf('%.3f', longitude)", "latitude is not null", "ln", datatype=X.XSD + "double"),
    _t("s_", X.OPARL + "extractionMethod", "method", "true", "ln"), _t("s_", X.OPARL + "sourceDocument", "pdf_url", "pdf_url <> ''", "ln", "uri"),
])


def _papers(spark, d, *only):
    return G.paper_triples(V.papers(spark, d), only or None, within=("key",))


def _places(spark, d, *only):
    return G.location_triples(_table(spark, d, "key"), digits=3, only=only or None, within=("key",))


def _all(spark, d, *only):
    """The graph's triples of some predicates, built once."""
    return G.stored(_papers(spark, d, *only).unionByName(_places(spark, d, *only)))


@query(V.sql(f"pt as ({_PAPER}) select * from pt", "papers"))
def paper_triples(spark, d):
    return _papers(spark, d)


@query(V.sql(_TABLE + f", {_NODES}, pl as ({_PLACES}) select * from pl", "papers", "gazetteer"))
def location_triples(spark, d):
    return _places(spark, d)


_REL = "r as (select concat('https://api.example.org/paper/', row_number() over (order by name)) as paper_id, name, case when length(name) % 2 = 0 then lat end as lat, lon, concat('POINT(1 ', length(name), ')') as w, case when length(name) % 3 = 0 then concat('https://example.org/', name) end as geo from gazetteer), q as (select *, concat('" + G.BASE + "location/', name) as s_ from r)"
_RELATIONS = " union ".join([
    _t("paper_id", X.GEO + "hasGeometry", "s_", "true", "q", "uri"), _t("s_", X.RDF_TYPE, f"'{X.GEO}Feature'", "true", "q", "uri"), _t("s_", X.LABEL, "name", "true", "q", lang="de"),
    _t("s_", X.GEO + "hasGeometry", "case when lat is not null then concat('POINT(', printf('%.3f', lon), ' ', printf('%.3f', lat), ')') else w end", "true", "q", datatype=X.GEO + "wktLiteral"),
    _t("s_", X.GEO + "lat", "printf('%.3f', lat)", "lat is not null", "q", datatype=X.XSD + "double"), _t("s_", X.GEO + "long", "printf('%.3f', lon)", "lat is not null", "q", datatype=X.XSD + "double"),
    _t("s_", X.SEE_ALSO, "geo", "geo is not null", "q", "uri"),
])


@query(V.sql(f"{_REL}, x as ({_RELATIONS}) select * from x", "gazetteer"))
def spatial_relation_triples(spark, d):
    from pyspark.sql import Window

    n = F.length("name")
    r = V.gazetteer(spark, d).withColumn("i", F.row_number().over(Window.orderBy("name")).cast("string"))
    r = r.select(F.concat(F.lit(V.API + "paper/"), "i").alias("paper_id"), "name", F.when(n % 2 == 0, F.col("lat")).alias("latitude"), F.col("lon").alias("longitude"), F.concat(F.lit("POINT(1 "), n.cast("string"), F.lit(")")).alias("wkt"), F.when(n % 3 == 0, F.concat(F.lit("https://example.org/"), "name")).alias("geo_uri"))
    return G.relation_triples(r, digits=3)


_LINE = "concat('<', s, '> <', p, '> ', case when kind = 'uri' then concat('<', o, '>') else concat('\"', o, '\"', case when datatype is not null then concat('^^<', datatype, '>') when lang is not null then concat('@', lang) else '' end) end, ' .') as value"


@query(V.sql(f"pt as ({_PAPER}) select {_LINE} from pt", "papers"))
def ntriples_lines(spark, d):
    return G.ntriples_lines(_papers(spark, d))


@query(V.sql(f"pt as ({_PAPER}) select * from pt", "papers"))
def ntriples_parse(spark, d):
    """Written and read back: the same triples."""
    return R.parse_ntriples(G.ntriples_lines(_papers(spark, d)), "value")


@query(V.sql("select id as paper, name as title, cast(date as varchar) as date from papers order by date desc, id", "papers"))
def bgp_paper_title_date(spark, d):
    t = G.stored(_papers(spark, d, X.RDF_TYPE, X.TERMS + "title", X.TERMS + "date"))
    b = G.bgp(t, [("?paper", X.RDF_TYPE, X.OPARL + "Paper"), ("?paper", X.TERMS + "title", "?title"), ("?paper", X.TERMS + "date", "?date")])
    return b.orderBy(F.desc("date"), "paper")


@query(V.sql("select count(*) as n from papers", "papers"))
def bgp_count_papers(spark, d):
    return G.bgp(_papers(spark, d), [("?paper", X.RDF_TYPE, X.OPARL + "Paper")]).agg(F.count("*").alias("n"))


def _solved(select: str, *predicates: str) -> str:
    """SQL of a pattern over the graph: the triples of each predicate once, as tables a, b, c."""
    parts = [f"{n} as materialized (select distinct s, o from t where p = '{p}')" for n, p in zip("abc", predicates, strict=True)]
    wanted = ", ".join(f"'{p}'" for p in predicates)
    graph = f"{_NODES}, t as materialized (select * from ({_PAPER}) where p in ({wanted}) union all select * from ({_PLACES}) where p in ({wanted}))"
    return V.sql(_TABLE.replace("geo as (", "geo as materialized (").replace("lt as (", "lt as materialized (") + f", {graph}, {', '.join(parts)} {select}", "papers", "gazetteer")


@query(_solved("select a.s as place, a.o as label, b.o as lat, c.o as long from a join b on a.s = b.s join c on a.s = c.s", X.LABEL, X.GEO + "lat", X.GEO + "long"))
def bgp_locations_coords(spark, d):
    t = _all(spark, d, X.RDF_TYPE, X.LABEL, X.GEO + "lat", X.GEO + "long")
    return G.bgp(t, [("?place", X.RDF_TYPE, X.GEO + "Feature"), ("?place", X.LABEL, "?label"), ("?place", X.GEO + "lat", "?lat"), ("?place", X.GEO + "long", "?long")])


@query(_solved("select a.s as paper, a.o as place, b.o as title, c.o as pdf from a join b on a.s = b.s join c on a.o = c.s", X.OPARL + "relatesToLocation", X.TERMS + "title", X.OPARL + "sourceDocument"))
def bgp_location_pdf(spark, d):
    t = _all(spark, d, X.OPARL + "relatesToLocation", X.TERMS + "title", X.OPARL + "sourceDocument")
    return G.bgp(t, [("?paper", X.OPARL + "relatesToLocation", "?place"), ("?paper", X.TERMS + "title", "?title"), ("?place", X.OPARL + "sourceDocument", "?pdf")])


@query(V.sql("select id as paper, name as label, reference as number, pdf_url as pdf from papers", "papers"))
def bgp_optional(spark, d):
    return G.bgp(_papers(spark, d), [("?paper", X.LABEL, "?label")], [("?paper", X.TERMS + "identifier", "?number"), ("?paper", X.TERMS + "hasFormat", "?pdf")], {"label": "de"})


@query(V.sql(f"select id as focus, '{X.TERMS}identifier' as path, 'minCount' as problem from papers where reference is null union all select id, '{X.TERMS}date', 'datatype' from papers", "papers"))
def shacl_min_count(spark, d):
    """Papers need a title, an identifier and (here, to find some) a date that is a dateTime."""
    return G.shape_issues(_papers(spark, d), X.OPARL + "Paper", {X.TERMS + "title": None, X.TERMS + "identifier": None, X.TERMS + "date": X.XSD + "dateTime"})
