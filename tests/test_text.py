import pytest
from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.functions import text as T
from civicframe.functions import time as D

TEXT = """Bebauungsplan Nr. 2024/01 und BEBAUUNGSPLAN 45a. In der Maximilianstraße 12 und am KÖNIGSPLATZ,
Bebauungsplan Nr. 482. Flurstück 123/4, Flur Nr. 7; Äußere-Straße; Konrad-Adenauer-Allee. Vom 15.01.2024."""


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column).first()[0]


def test_extractors(spark):
    assert one(spark, T.bplans(F.col("t")), t=TEXT) == ["2024/01", "45a", "482"]
    assert one(spark, T.parcels(F.col("t")), t=TEXT) == ["123/4", "7"]
    assert [tuple(a) for a in one(spark, T.addresses(F.col("t")), t=TEXT)] == [("Maximilianstraße", "12")]
    found = one(spark, T.streets(F.col("t")), t=TEXT)
    assert "Äußere-Straße" in found and "Konrad-Adenauer-Allee" in found and "KÖNIGSPLATZ" in found and "Maximilianstraße" not in found


def test_wide_patterns(spark):
    t = "Bebauungsplan (BP) Nr. 482; Flurstücke: 123/4, B-Plan 7"
    assert one(spark, T.bplans(F.col("t")), t=t) == [] and one(spark, T.bplans(F.col("t"), wide=True), t=t) == ["482", "7"]
    assert one(spark, T.parcels(F.col("t")), t=t) == [] and one(spark, T.parcels(F.col("t"), wide=True), t=t) == ["123/4"]


@pytest.mark.parametrize("value", ["Maximilianstraße", "Maximilianstraße 1", "Am Königsplatz", "Lechhauser Straße", "Königsplatz 12a"])
def test_gate_accepts(spark, value):
    assert one(spark, T.passes_gate(F.col("v")), v=value)


@pytest.mark.parametrize("value", ["45", "2024/01", "123/4", "Konrad-Adenauer-Allee", "Maxstr.", "arbeitsplatz", "AB"])
def test_gate_rejects(spark, value):
    assert not one(spark, T.passes_gate(F.col("v")), v=value)


def test_validity_by_type(spark):
    ok = lambda v, k, compat=False: one(spark, T.is_valid(F.col("v"), F.col("k"), compat), v=v, k=k)
    assert ok("45", "bplan") and not ok("45", "bplan", True)
    assert ok("7", "flurnummer") and not ok("7", "flurnummer", True)
    assert not ok("Programm", "street") and not ok("Haushalt 2024", "address")
    assert not ok("Ab", "street") and not ok("A" + "b" * 60, "street") and not ok("A B C D E F", "street") and ok("Weg", "street")


def test_text_in_order_with_context(spark):
    rows = one(spark, T.mentions(F.col("t")), t=TEXT)
    assert [r["type"] for r in rows] == ["bplan"] * 3 + ["flurnummer"] * 2 + ["address"] + ["street"] * 3
    assert rows[0]["context"] == "Bebauungsplan Nr. 2024/01" and rows[5]["value"] == "Maximilianstraße 12"
    assert one(spark, T.mentions(F.col("t")), t=None) == []


def test_small_functions(spark):
    assert one(spark, T.title_location(F.col("t")), t="Ausbau ‚Lange Gasse' im Bereich Mitte") == "Lange Gasse"
    assert one(spark, T.title_location(F.col("t")), t="Kita im Stadtteil Lechhausen Ost") == "Lechhausen Ost"
    assert one(spark, T.title_location(F.col("t")), t="haushalt") is None
    assert one(spark, T.last_segment(F.col("u")), u="https://x/y/") == "unknown" and one(spark, T.last_segment(F.col("u")), u="https://x/y") == "y"
    assert one(spark, T.normalize_url(F.col("u")), u="x.org") == "https://x.org" and one(spark, T.normalize_url(F.col("u")), u="http://x") == "http://x"
    assert one(spark, T.generate_uri("b/", F.lit("paper"), F.col("u")), u="https://x/12") == "b/paper/12"
    assert one(spark, T.cache_key(F.col("v")), v="ÄB") == one(spark, T.cache_key(F.col("v")), v="äb")
    point = T.wkt(F.col("a").cast("double"), F.col("b").cast("double"))
    assert one(spark, point, a="48.5", b="10.25") == f"<{X.CRS}4326> POINT(10.25 48.5)"
    assert one(spark, T.wkt_coordinates(point), a="48.5", b="10.25") == "10.25 48.5"
    assert one(spark, T.keyword_candidates(F.col("t")), t="am Platz, Ringweg Ringweg, Weg") == ["Platz", "Ringweg"]
    c = T.cascade([("a", F.col("x")), ("b", F.col("y"))], 3)
    assert tuple(one(spark, c, x=" ab ", y="abc")) == ("abc", "b") and one(spark, c, x=None, y="ab") is None


def test_local_time_across_dst(spark):
    # clocks go forward at 01:00 UTC on 2024-03-31 and back at 01:00 UTC on 2024-10-27
    for utc, local in (("2024-03-31 00:59:00", "2024-03-31 01:59"), ("2024-03-31 01:00:00", "2024-03-31 03:00"), ("2024-10-27 00:30:00", "2024-10-27 02:30"), ("2024-10-27 01:30:00", "2024-10-27 02:30"), ("2024-12-31 23:30:00", "2025-01-01 00:30")):
        assert one(spark, F.date_format(D.local(F.col("t")), "yyyy-MM-dd HH:mm"), t=utc) == local
    assert one(spark, D.day_name(D.local(F.col("t"))), t="2024-12-31 23:30:00") == "Wednesday"


@pytest.mark.parametrize(("text", "good"), [("2024-01-15", True), ("2024-01-15T18:00:00Z", True), ("2024-01-15T18:00:00.5+01:00", True), ("15.01.2024", False), ("2024-02-30", False), ("x", False)])
def test_iso_dates(spark, text, good):
    assert one(spark, D.is_iso(F.col("t")), t=text) is good


def test_quick_patterns_find_the_same(spark):
    """Odd runs of letters, addresses without a gap, folded letters, line ends: the same matches as the plain patterns."""
    import random

    r = random.Random(3)
    bits = ["ß", "ẞ", "Ä", "x", "K", "ſtraße", "straße", "STRAẞE", "weg", "Weg 5b", " ", "\n", "-", "'", "7", "12 ", "Haupt", "str.", "str. 9", " ", "é", "gasse", "Programm", "A B"]
    texts = ["Hauptstraße 5bHauptstraße 7", "ßAstraße 5", "Weg 3", "Abc\n", *("".join(r.choices(bits, k=r.randrange(1, 14))) for _ in range(3000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = [F.regexp_extract_all("t", F.lit(X.FLAGS + p), F.lit(g)) == F.regexp_extract_all("t", F.lit(X.FLAGS + q), F.lit(g)) for p, q in ((X.ADDRESS, X.ADDRESS_FAST), (X.STREET, X.STREET_FAST)) for g in (0, 1)]
    both += [T.passes_gate(F.col("t")) == F.trim("t").rlike("(?U)" + X.GATE)]
    low = F.lower(F.trim("t"))
    both += [T.not_blocked(F.col("t")) == (~low.isin(*X.BLOCKLIST) & ~F.split_part(low, F.lit(" "), F.lit(1)).isin(*X.BLOCKLIST))]
    assert df.select(F.count_if(~F.forall(F.array(*both), lambda x: x)).alias("n")).first()["n"] == 0
    assert df.select(F.count_if(F.size(F.regexp_extract_all("t", F.lit(X.FLAGS + X.ADDRESS_FAST), F.lit(0))) > 0)).first()[0] > 100
