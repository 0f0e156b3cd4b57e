import json
from datetime import datetime
from xml.etree import ElementTree

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicframe import pipeline, plans
from civicframe.functions import fixed as X
from civicframe.operators import graph as G
from civicframe.operators import locations as L
from civicframe.operators import meetings as M
from civicframe.operators import quality as Q
from civicframe.operators import state, topics
from civicframe.operators import storage as S
from civicframe.sources import files, rest
from civicframe.streaming import ingest


def papers(spark, rows):
    return S.prepare(spark.createDataFrame(rows, "id string, name string, date string, modified string"), "Musterstadt")


def test_prepare_coerces_dates(spark):
    got = papers(spark, [("a", "x", "2024-01-15", ""), ("b", "x", "unknown", "")]).collect()
    assert [(r["city"], r["year"], r["month"]) for r in got] == [("musterstadt", 2024, 1), ("musterstadt", None, None)]
    now = S.prepare(spark.createDataFrame([("a",)], "id string"), "x", datetime(2020, 5, 1)).first()
    assert (now["year"], now["month"]) == (2020, 5)


def test_upsert_is_idempotent_and_moves_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    S.upsert(papers(spark, [("a", "old", "2023-01-01", "1"), ("b", "keep", "2023-02-01", "1"), ("c", "far", "2020-01-01", "1")]), path)
    batch = papers(spark, [("a", "new", "2024-01-01", "2")])
    for _ in range(2):
        S.upsert(batch, path)
        assert sorted((r["id"], r["name"], r["year"]) for r in S.read_all(spark, path).collect()) == [("a", "new", 2024), ("b", "keep", 2023), ("c", "far", 2020)]
    S.upsert(papers(spark, [("a", "stale", "2024-01-01", "1")]), path)
    assert S.read_partition(spark, path, "musterstadt", 2024).first()["name"] == "new"
    plan = S.read_partition(spark, path, "musterstadt", 2024)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024" in plan


def test_geojson_document(spark, tmp_path):
    t = spark.createDataFrame([("p1", "N", "2024-01-01", "u", "A", 48.0, 10.0, "regex", "musterstadt"), ("p1", "N", None, "u", "B", None, None, "regex", "musterstadt"), ("p2", "N", None, "u", "A", 0.0, 10.0, None, "musterstadt"), ("p3", "N", None, "u", "C", 1.0, 1.0, None, "other")], "paper_id string, paper_name string, paper_date string, pdf_url string, location_value string, latitude double, longitude double, method string, city string")
    path = tmp_path / "x" / "g.geojson"
    assert S.write_geojson(S.geojson_features(t, "musterstadt"), str(path), "musterstadt") == 2
    doc = json.loads(path.read_text())
    assert doc["metadata"]["unique_locations"] == 1 and doc["features"][0]["geometry"]["coordinates"] == [10.0, 48.0]
    assert S.geojson_features(t, "musterstadt", compat=True).count() == 1  # there 0 counts as missing


def test_sources(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}, "properties": {"name": "A"}}, {"type": "Feature", "geometry": {"type": "Point", "coordinates": [3.0, 4.0]}, "properties": {"name": "a"}}, {"type": "Feature", "geometry": {"type": "Point", "coordinates": [3.0]}, "properties": {"name": "B"}}, {"type": "Feature", "geometry": None, "properties": {"name": None}}]}
    (tmp_path / "g.geojson").write_text(json.dumps(doc))
    f = files.geojson(spark, str(tmp_path / "g.geojson"))
    assert [tuple(r) for r in files.coordinates(f).collect()] == [("a", 4.0, 3.0)]  # the last one counts
    assert [r["name"] for r in files.names(f).collect()] == ["A", "B", "a"]
    (tmp_path / "s.csv").write_text("street,x\nA,1\nB,2\n")
    assert [r["name"] for r in files.name_list(spark, str(tmp_path / "s.csv")).collect()] == ["A", "B"]


def test_pdf_cascade(spark, tmp_path):
    for name, content in (("a.pdf", b"first " * 40), ("b.pdf", b"SECOND" * 40), ("c.pdf", b"none")):
        (tmp_path / name).write_bytes(content)

    def one(content):
        if not content.startswith(b"first"):
            raise ValueError("not mine")
        return content.decode(), 1

    def two(content):
        return content.decode().lower(), 2

    got = {r["url"][-5:]: r for r in files.pdf_texts(spark, str(tmp_path), [("one", one), ("two", two)]).collect()}
    assert got["a.pdf"]["method"] == "one" and got["b.pdf"]["method"] == "two" and got["b.pdf"]["page_count"] == 2
    assert not got["c.pdf"]["success"] and "not mine" in got["c.pdf"]["error"]


TEXTS = st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00\x85  \x0b\x0c\x1c\x1d\x1e"), min_size=1, max_size=20)


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8))
def test_ntriples_round_trip(spark, values):
    t = spark.createDataFrame([(f"http://s/{i}", "http://p", v, "literal", None if i % 2 else "http://d", "de" if i % 2 else None) for i, v in enumerate(values)], "s string, p string, o string, kind string, datatype string, lang string")
    back = files.parse_ntriples(G.ntriples_lines(t), "value")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, t.collect()), key=str)


def test_triples_are_a_set_and_append(spark, tmp_path):
    p = spark.createDataFrame([("http://p/1", "N", None, ""), ("http://p/1", "N", None, "")], "id string, name string, reference string, full_text string")
    t = G.paper_triples(p)
    assert t.count() == 3
    G.write_ntriples(t, str(tmp_path / "g"))
    G.write_ntriples(t, str(tmp_path / "g"), append=True)
    assert files.ntriples(spark, str(tmp_path / "g")).count() == 6
    block = G.turtle_blocks(t).first()["value"]
    assert block.startswith("<http://p/1> ") and block.endswith(" .") and block.count(";") == 2


def test_patterns(spark):
    t = spark.createDataFrame([("a", "knows", "b"), ("b", "knows", "c"), ("a", "name", "A"), ("c", "name", "C")], "s string, p string, o string").withColumns({"kind": F.lit("literal"), "datatype": F.lit(None).cast("string"), "lang": F.lit("de")})
    got = G.bgp(t, [("?x", "knows", "?y"), ("?y", "knows", "?z")], [("?z", "name", "?n")]).collect()
    assert [(r["x"], r["y"], r["z"], r["n"]) for r in got] == [("a", "b", "c", "C")]
    assert G.bgp(t, [("?x", "name", "?n")], langs={"n": "fr"}).count() == 0
    assert G.bgp(t, [("?x", "knows", "?x")]).count() == 0


def test_reports(spark, tmp_path):
    p = spark.createDataFrame([(1, "a", "x", "2024-01-15"), (2, "a", " ", "15.1.2024"), (3, None, None, None)], "n int, id string, name string, date string")
    issues = Q.validate_papers(p, "n")
    counts = Q.write_report(issues, str(tmp_path))
    assert counts == {"errors": 5, "warnings": 1, "infos": 0, "is_valid": False}
    assert len(json.loads((tmp_path / "report.json").read_text())["issues"]) == 6 and "<table>" in (tmp_path / "report.html").read_text()
    assert Q.summary(issues.limit(0)).first()["is_valid"]


def test_validate_dataset(spark, tmp_path):
    assert Q.validate_dataset(spark, str(tmp_path / "none")).first()["category"] == "missing_dataset"
    spark.createDataFrame([("a", None), ("a", "x")], "id string, name string").write.parquet(str(tmp_path / "d"))
    got = {(r["category"], r["field"]): r["value"] for r in Q.validate_dataset(spark, str(tmp_path / "d")).collect()}
    assert got == {("null_values", "name"): "1", ("duplicate", "id"): "1"}


def test_state(spark):
    log = spark.createDataFrame([("a", "paper", "failed", 1), ("a", "paper", "completed", 2), ("b", "paper", "completed", 1), ("b", "paper", "failed", 3)], "resource_id string, resource_type string, status string, seq long").withColumn("processed_at", F.timestamp_seconds("seq"))
    assert [r["resource_id"] for r in state.processed_ids(log).collect()] == ["a"]
    assert [r["resource_id"] for r in state.failed(log).collect()] == ["b"]
    assert {r["resource_id"] for r in state.clear_failed(log).collect()} == {"a"}


def test_topics_and_entities(spark):
    df = spark.createDataFrame([("Schule, Kita und Bildung im Park",)], "t string")
    got = df.select(topics.scores(F.col("t"))).first()[0]
    assert [s["category"] for s in got] == ["Bildung"] and got[0]["confidence"] == pytest.approx(0.6)
    places = spark.createDataFrame([("A",), ("B",)], "name string")
    found = topics.link_first(places, spark.createDataFrame([("a", 2, "Q2"), ("a", 1, "Q1")], "name string, rank int, wiki string"))
    assert {r["name"]: r["wiki"] for r in found.collect()} == {"A": "Q1", "B": None}
    assert topics.sentiment(places, "name").first()["sentiment"] is None
    assert {r["sentiment_score"] for r in topics.sentiment(places, "name", lambda x: [("pos", float(len(t))) for t in x]).collect()} == {1.0}


def test_organizations_and_agenda(spark):
    m = spark.createDataFrame([(1, 0), (2, 99), (3, None)], "id int, organization int")
    o = spark.createDataFrame([(0, "Rat")], "organization int, org_name string")
    assert {r["id"]: r["org_name"] for r in M.with_organization(m, o).collect()} == {1: "Rat", 2: "99", 3: X.UNKNOWN_ORGANIZATION}
    a = spark.createDataFrame([(1, [("i1", "TOP 1"), ("i2", None)])], "id int, agendaItem array<struct<id:string,name:string>>")
    items = spark.createDataFrame([("i2", "by reference")], "id string, name string")
    assert sorted((r["pos"], r["item_name"]) for r in M.agenda_items(a, items).collect()) == [(0, "TOP 1"), (1, "by reference")]


# the paginated source

PAGES = {n: {"data": [{"id": f"p{n}{k}", "modified": f"2024-0{n}-01T00:00:00Z", "name": "N"} for k in range(2)], "links": {"next": f"mem://x?page={n + 1}" if n < 4 else None, "last": "mem://x?page=4"}} for n in range(1, 5)}


def fake(url, params):
    from urllib.parse import parse_qs, urlparse

    return PAGES[int(params.get("page") or parse_qs(urlparse(url).query).get("page", ["1"])[0])]


def test_paged_listing():
    assert [o["id"] for o in rest.objects(fake, "mem://x")] == [f"p{n}{k}" for n in range(1, 5) for k in range(2)]
    assert len(list(rest.objects(fake, "mem://x", limit=2))) == 4
    calls = []

    class Busy(Exception):
        code = 503

    def flaky(url, params):
        calls.append(url)
        if len(calls) < 3:
            raise Busy
        return {"data": []}

    pauses = []
    rest.with_retries(flaky, "u", {}, sleep=pauses.append)
    assert pauses == [1.0, 2.0]

    def broken(url, params):
        if "2" in url:
            raise ValueError
        return fake(url, params)

    assert len(list(rest.pages(broken, "mem://x"))) == 1  # ends, keeps what came before
    assert rest.first_body(lambda u, p: {"body": ["b"]} if u == "s" else {"id": u}, "s") == {"id": "b"}
    assert rest.endpoint({"papers": "x"}, "paper", "papers") == "x"
    assert rest.organization_name(fake, None) == X.UNKNOWN_ORGANIZATION and rest.organization_name(broken, "2") == "2"


@pytest.fixture
def offline(spark, tmp_path, monkeypatch):
    """A module with a fetcher that workers can import."""
    import os

    (tmp_path / "offline_pages.py").write_text(f"PAGES = {PAGES!r}\n\ndef fetch(url, params):\n    from urllib.parse import parse_qs, urlparse\n    return PAGES[int(params.get('page') or parse_qs(urlparse(url).query).get('page', ['1'])[0])]\n")
    spark.sparkContext.addPyFile(str(tmp_path / "offline_pages.py"))
    monkeypatch.syspath_prepend(str(tmp_path))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment["PYTHONPATH"] = root
    monkeypatch.setenv("PYTHONPATH", root)
    rest.register(spark)
    return "offline_pages:fetch"


def test_paged_source(spark, offline):
    read = spark.read.format("paged_json").option("url", "mem://x").option("fetcher", offline)
    assert read.load().count() == 8
    assert sorted(r["id"] for r in read.option("modified_since", "2024-02").option("modified_until", "2024-04").load().collect()) == ["p20", "p21", "p30", "p31"]
    numbered = spark.read.format("paged_json").option("url", "mem://x").option("fetcher", offline).option("pagesPerTask", 1).load()
    assert numbered.rdd.getNumPartitions() == 4 and numbered.count() == 8


# streaming


def landing(folder, rows):
    folder.mkdir(exist_ok=True)
    for i, part in enumerate(rows):
        (folder / f"{i}.json").write_text("\n".join(json.dumps(r) for r in part))


def paper(k, version=1, **more):
    return {"id": f"https://x/paper/{k}", "name": f"V{k}.{version}", "date": f"20{10 + k % 3}-01-01", "modified": f"2024-01-0{version}T00:00:00Z", **more}


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    folder = tmp_path / "in"
    landing(folder, [[paper(k) for k in range(5)], [paper(k, 2) for k in range(3)], [paper(9, deleted=True)]])
    paths = ingest.Paths(str(tmp_path / "out"), str(tmp_path / "log"), str(tmp_path / "cp"))
    ingest.start(ingest.landed(spark, str(folder), 1), paths, "Musterstadt").awaitTermination()
    once = sorted((r["id"], r["name"]) for r in spark.read.parquet(paths.papers).collect())
    latest = {f"https://x/paper/{k}": f"V{k}.{2 if k < 3 else 1}" for k in range(5)}
    assert dict(once) == latest and len(once) == 5
    assert {r["resource_id"] for r in ingest.processed(spark, paths).collect()} == set(latest)
    (folder / "new.json").write_text(json.dumps(paper(7)))
    ingest.start(ingest.landed(spark, str(folder), 1), paths, "Musterstadt").awaitTermination()
    assert spark.read.parquet(paths.papers).count() == 6


def test_watermarked_streams(spark, tmp_path):
    folder = tmp_path / "in"
    landing(folder, [[paper(k) for k in range(4)], [paper(k) for k in range(4)]])
    s = ingest.distinct_within(ingest.landed(spark, str(folder), 1))
    s.writeStream.format("memory").queryName("once").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("once").count() == 4
    events = spark.readStream.schema(spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema).parquet("/root/testdata/sf0.001/event[s].parquet")
    d = ingest.daily_counts(events.withColumn("start", F.col("ts")))
    d.writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet").groupBy(F.to_date("ts").alias("day")).count()
    assert {r["day"].date(): r["n"] for r in spark.table("days").collect()} == {r["day"]: r["count"] for r in batch.collect()}


# the whole run


def test_run_twice(spark, tmp_path):
    landing(tmp_path / "in", [[paper(k, mainFile={"accessUrl": f"https://x/{k}.pdf"}) for k in range(4)]])
    spark.createDataFrame([(f"https://x/paper/{k}", f"Am Königsplatz {k}, Bebauungsplan {k}") for k in range(3)], "id string, full_text string").write.parquet(str(tmp_path / "texts"))
    g = {"features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [10.0, 48.0]}, "properties": {"name": "Königsplatz"}}]}
    (tmp_path / "g.geojson").write_text(json.dumps(g))
    config = pipeline.Config(papers=str(tmp_path / "in"), texts=str(tmp_path / "texts"), gazetteer=str(tmp_path / "g.geojson"), output=str(tmp_path / "out"))
    stats = pipeline.run(spark, config)
    assert stats["papers"] == 4 and stats["locations"] == 6 and stats["features"] == 3
    again = pipeline.run(spark, config)
    assert again["papers"] == 1 and again["locations"] == 6  # only the one without text is tried again
    assert spark.read.parquet(str(tmp_path / "out" / "papers")).count() == 4
    assert spark.read.parquet(str(tmp_path / "out" / "runs")).count() == 2


def test_changed_papers_replace_their_places(spark, tmp_path):
    """Batches of the given size, a checkpoint row each; a paper that is processed again has its new places and triples only."""
    landing(tmp_path / "in", [[paper(k) for k in range(9)]])

    def texts(what):
        spark.createDataFrame([(f"https://x/paper/{k}", what(k)) for k in range(9)], "id string, full_text string").write.mode("overwrite").parquet(str(tmp_path / "texts"))

    out = tmp_path / "out"
    config = pipeline.Config(papers=str(tmp_path / "in"), texts=str(tmp_path / "texts"), output=str(out), batch_size=3, skip_existing=False)
    texts(lambda k: f"Bebauungsplan {k}0 und Bebauungsplan {k}1")
    first = pipeline.run(spark, config)
    assert first["papers"] == 9 and first["batches"] == 3 and first["locations"] == 18
    points = spark.read.parquet(str(out / "checkpoints")).orderBy("batch").collect()
    assert [p["batch"] for p in points] == [0, 1, 2] and sum(p["batch_size"] for p in points) == 9 and points[-1]["total_processed"] == 9
    lines = spark.read.text(str(out / "graph.nt")).count()
    texts(lambda k: f"Bebauungsplan {k}5" if k else "nichts")
    again = pipeline.run(spark, config)
    assert again["locations"] == 8
    left = {r["value"] for r in spark.read.text(str(out / "graph.nt")).collect()}
    assert len(left) < lines and not any("_40" in x for x in left) and any("_45" in x for x in left)
    assert pipeline.run(spark, config)["locations"] == 8
    assert {r["value"] for r in spark.read.text(str(out / "graph.nt")).collect()} == left


def test_graph_forms(spark, tmp_path):
    t = spark.createDataFrame([("https://x/1", "https://y#name", 'A & "B" <c>', "literal", None, "de"), ("https://x/1", "https://y/z/knows", "https://x/2", "uri", None, None), ("https://x/2", "https://y#n", "5", "literal", "https://w#int", None)], "s string, p string, o string, kind string, datatype string, lang string")
    path = G.serialize(t, str(tmp_path / "g"), "xml")
    root = ElementTree.parse(path).getroot()
    rdf = "{http://www.w3.org/1999/02/22-rdf-syntax-ns#}"
    got = {(d.get(rdf + "about"), e.tag, e.text or e.get(rdf + "resource"), e.get(rdf + "datatype"), e.get("{http://www.w3.org/XML/1998/namespace}lang")) for d in root for e in d}
    assert got == {("https://x/1", "{https://y#}name", 'A & "B" <c>', None, "de"), ("https://x/1", "{https://y/z/}knows", "https://x/2", None, None), ("https://x/2", "{https://y#}n", "5", "https://w#int", None)}
    assert G.serialize(t, str(tmp_path / "h"), "nt").endswith("h.nt") and G.serialize(t, str(tmp_path / "h"), "turtle").endswith("h.ttl")
    assert spark.read.text(str(tmp_path / "h.nt")).count() == 3
    G.write_ntriples(t, str(tmp_path / "h.nt"), append=True, once=True)  # repeated: nothing new
    assert spark.read.text(str(tmp_path / "h.nt")).count() == 3
    with pytest.raises(ValueError):
        G.serialize(t, str(tmp_path / "h"), "json")


def test_gazetteer_set_up(spark, tmp_path):
    """A posted query, its elements, districts of a level, the files written."""
    answer = {"elements": [
        {"type": "way", "id": 1, "center": {"lat": 48.0, "lon": 10.0}, "tags": {"name": "Lange Gasse", "highway": "residential"}},
        {"type": "relation", "id": 2, "tags": {"name": "Altstadt", "boundary": "administrative", "admin_level": "10"}},
        {"type": "relation", "id": 3, "tags": {"name": "Kreis", "boundary": "administrative", "admin_level": "6"}},
    ]}
    asked = []

    def send(url, body):
        asked.append((url, body))
        if len(asked) == 1:
            raise OSError("later")
        return json.dumps(answer)

    elements = files.map_elements(spark, "[out:json];way;", rest.post_form("https://map", send=send, sleep=lambda s: None))
    assert elements.count() == 3 and asked[0] == asked[1] == ("https://map", b"data=%5Bout%3Ajson%5D%3Bway%3B")
    parts = files.districts(elements)
    assert [(r["name"], r["lat"]) for r in parts.collect()] == [("Altstadt", None)]
    g = files.build_gazetteer(files.osm_features(elements)).select("id", "name", "kind", "lat", "lon", "source").unionByName(parts)
    assert files.write_gazetteer(g, str(tmp_path / "g"), "x") == {"city": "x", "features": 2, "by_kind": {"district": 1, "residential": 1}}
    assert [(r["name_key"], r["lat"], r["lon"]) for r in files.coordinates(files.geojson(spark, str(tmp_path / "g" / "x_streets.geojson"))).collect()] == [("lange gasse", 48.0, 10.0)]


def test_cache_is_filled_once(spark, tmp_path):
    """Each unknown place is asked for once; failures are tried again."""
    m = spark.createDataFrame([("Lange Gasse", "street"), ("lange gasse", "street"), ("Nirgends", "street")], "value string, type string")
    path, city = str(tmp_path / "cache"), F.lit("x")
    find = lambda value, kind, where: None if value == "Nirgends" else (48.0, 10.0, value, kind)
    L.put_cache(L.resolve(m, L.read_cache(spark, path), city, find), path)
    assert L.read_cache(spark, path).count() == 1
    assert L.resolve(m, L.read_cache(spark, path), city, lambda *a: (1.0, 2.0, "n", "k")).count() == 1
    assert L.geocode(m.withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")}), L.read_cache(spark, path), city).where("cached").count() == 2
    names = spark.createDataFrame([("In Berlin",), (None,)], "t string").select(L.named_entities(F.col("t"), lambda ts: [t.split()[1:] for t in ts]).alias("n"))
    assert [r["n"] for r in names.collect()] == [["Berlin"], []]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], 'a "b", c')], "k int, xs array<int>, t string")
    S.export_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "c")).first()["xs"] == "[1,2]"
    S.write_geojson_lines(df.select(F.lit('{"type":"Feature"}').alias("feature")), str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).first()["type"] == "Feature"


def test_report_keeps_all_issues(spark, tmp_path):
    issues = spark.createDataFrame([("ERROR", "c", f"m{i}", str(i), "f", None, None) for i in range(30)], Q.ISSUE)
    assert Q.write_report(issues, str(tmp_path / "r"), most=10)["errors"] == 30
    assert spark.read.json(str(tmp_path / "r" / "issues")).count() == 30
    assert json.loads((tmp_path / "r" / "report.json").read_text())["more"] == 20 and "20 more issues" in (tmp_path / "r" / "report.txt").read_text()


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"output": "base", "papers": "${output}/in"}))
    c = pipeline.load_config(str(tmp_path / "c.json"), city="x", limit=None)
    assert (c.papers, c.city, c.limit) == ("base/in", "x", None)
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("output: base\npapers: ${output}/in\nbatch_size: 7\n")
    c = pipeline.load_config(str(tmp_path / "c.yaml"))
    assert (c.papers, c.batch_size) == ("base/in", 7)


def test_triples_meet_by_node(spark):
    """Each triple once, also where values or papers share a node; rows are brought together, not triples."""
    columns = "paper_id string, location_type string, location_value string, latitude double, longitude double, display_name string, method string, pdf_url string"
    rows = [("p", "street", v, lat, 10.0, None, "regex", u) for v in ("A 1", "A_1", "A 1", "B/2", "B-2", "", None) for lat, u in ((48.0, "u"), (None, "u"), (48.0001, ""))]
    rows += [("q r", "street", "C", 1.0, 2.0, "n", "m", "u"), ("q_r", "street", "C", 1.0, 2.0, "n", "m", "u")]
    df = spark.createDataFrame(rows, columns)
    t = G.location_triples(df, digits=3)
    got = [tuple(r) for r in t.collect()]
    assert len(got) == len(set(got))
    alone = G.location_triples(df.withColumn("i", F.monotonically_increasing_id()), digits=3, keep=("i",)).drop("i").distinct()
    assert set(got) == {tuple(r) for r in alone.collect()}
    assert sum(r[1].endswith("relatesToLocation") and r[2].endswith("q_r_street_C") for r in got) == 2
    assert "Aggregate" not in t._jdf.queryExecution().executedPlan().toString()


def test_papers_are_built_once(spark):
    plan = plans.QUERIES["locations_table"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderkey#") and plan.count("l_linenumber#") and sum("Relation" in line and "o_orderkey" in line for line in plan.splitlines()) == 1


def test_ntriples_by_one_run(spark):
    """Odd lines: the groups are those of the patterns one by one, and a long literal doesn't exhaust the stack."""
    heads = ["<a> <b> ", "_:n <b> ", "<> <> ", "<a\x01> <b> ", "<a> b ", "  <a>\t<b>  "]
    tails = ['"x" .', '"x\\"y\\n"@de .', '"x"^^<t> . # c', "<u> .", "_:m .", '"" .', '"x', '"a\x01b"@en .', "<> .", '"x"@de .\n', '"$1 \\\\ \\t" .', "z .", '"' + "\\\\n" * 20000 + '" .']
    df = spark.createDataFrame([(h + o,) for h in heads for o in tails], "value string")
    own = files._grouped(df, "value", files._HEAD, 4, "g").where(F.col("value").rlike(files._HEAD))
    assert own.where(~(F.col("g") == F.array(*[F.regexp_extract("value", files._HEAD, i) for i in range(1, 5)]))).count() == 0
    rest = spark.createDataFrame([(o,) for o in tails[:-1]], "rest string")
    own = files._grouped(rest, "rest", files._OBJECT_FAST, 5, "g")
    assert own.where(~(F.col("g") == F.array(*[F.regexp_extract("rest", files._OBJECT, i) for i in range(1, 6)]))).count() == 0
    assert files.parse_ntriples(df, "value").where(F.length("o") == 40000).count() == 5
