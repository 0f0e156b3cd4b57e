"""Patterns, word lists and names that results depend on."""

from __future__ import annotations

#: Fixed values. Java flags: i and u fold all letters, U makes \s and \d as wide as in other engines.
FLAGS = "(?iuU)"
BPLAN = r"Bebauungsplan(?:\s+(?:Nr\.?|Nummer))?\s*([A-Z]?\d+[a-z]?(?:\s*[-/]\s*\d+)?)"
PARCEL = r"Flur(?:stück)?(?:\s+(?:Nr\.?|Nummer))?\s*(\d+(?:\s*/\s*\d+)?)"
ADDRESS = r"([A-ZÄÖÜ][a-zäöüß]+(?:straße|str\.|platz|weg|allee|gasse))\s+(\d+[a-z]?)"
STREET = r"\b([A-ZÄÖÜ][a-zäöüß-]+(?:straße|str\.|platz|weg|allee|gasse))\b"
#: The same matches: within a run of letters an earlier start of an address matches whenever a later one does, so only the
#: first is tried; endings are only tried at their first letters.
ADDRESS_FAST = r"(?:\G|(?<![A-ZÄÖÜ]))" + ADDRESS.replace("(?:straße", "(?=[spwag])(?:straße")
STREET_FAST = STREET.replace("(?:straße", "(?=[spwag])(?:straße")
DISTRICT = r"(?:Stadtteil|Stadtbezirk|in)\s+([A-ZÄÖÜ][a-zäöüß\s]+)"
GATE = r"^[A-ZÄÖÜ](?:[a-zäöüß\-'/]|\s[A-ZÄÖÜ])*(?:\s+\d+[a-z]?)?$"
#: The same texts as GATE, without steps back.
GATE_FAST = r"^[A-ZÄÖÜ](?:[a-zäöüß\-'/]++|\s[A-ZÄÖÜ])*+(?:\s+\d+[a-z]?)?$"
TITLE_QUOTED = r"[‚'„](.*?)[''\"]"
TITLE_QUOTED_END = r"(straße|platz|allee|weg|gasse|ring|pfad)$"
TITLE_STREET = r"([A-ZÄÖÜ][a-zäöüß\-]+(?:\s+[A-ZÄÖÜ][a-zäöüß\-]+)*(?:straße|platz|allee|weg|gasse|ring|pfad))"
TITLE_DISTRICT = r"(?:in|im Bereich|im Stadtteil)\s+([A-ZÄÖÜ][a-zäöüß\-]+(?:\s+[A-ZÄÖÜ][a-zäöüß\-]+)?)"

#: Patterns of ours that also match "Bebauungsplan (BP) Nr. 482" and "Flurstücke: 123/4".
BPLAN_WIDE = r"(?:Bebauungsplan|B-Plan)(?:\s*\([A-Z]+\))?(?:\s+(?:Nr\.?|Nummer))?\s*:?\s*([A-Z]?\d+[a-z]?(?:\s*[-/]\s*\d+)?)"
PARCEL_WIDE = r"Flur(?:stück(?:e|s)?)?(?:\s+(?:Nr\.?|Nummer))?\s*:?\s*(\d+(?:\s*/\s*\d+)?)"

#: Words that are no places.
BLOCKLIST = (
    "programm", "programms", "programme", "teilzeit", "vollzeit", "wohngebiete", "wohngebiet", "ferien", "fahrdienst", "öffentlichen", "nahverkehr",
    "richtung", "zusammenhang", "erfolgsfaktoren", "erfolgsfall", "zeitraum", "zeitspanne", "haushalt", "einzelheiten", "sachverhalt", "stellungnahme",
)
STREET_WORDS = ("straße", "platz", "allee", "weg", "gasse")

#: Topics and the words that score for them.
TOPICS = {
    "Verkehr": ("straße", "verkehr", "bus", "rad", "fahrrad", "parkplatz", "stau"),
    "Stadtentwicklung": ("entwicklung", "planung", "konzept", "strategie", "zukunft"),
    "Bauprojekte": ("bau", "bebauung", "neubau", "bauvorhaben", "baugebiet"),
    "Grünflächen": ("park", "grün", "baum", "natur", "garten", "spielplatz"),
    "Wohnungsbau": ("wohnung", "wohnen", "wohngebiet", "miete", "sozialwohnungen"),
    "Sanierung": ("sanierung", "renovierung", "umbau", "modernisierung"),
    "Bildung": ("schule", "kita", "kindergarten", "bildung", "lernen"),
    "Soziales": ("sozial", "integration", "migration", "pflege", "gesundheit"),
    "Kultur": ("kultur", "museum", "theater", "veranstaltung", "kunst"),
    "Wirtschaft": ("wirtschaft", "gewerbe", "unternehmen", "arbeitsplätze", "industrie"),
}

#: Names of the graph.
OPARL = "https://schema.oparl.org/1.1/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
SEE_ALSO = "http://www.w3.org/2000/01/rdf-schema#seeAlso"
TERMS = "http://purl.org/dc/terms/"
GEO = "http://www.opengis.net/ont/geosparql#"
XSD = "http://www.w3.org/2001/XMLSchema#"
CRS = "http://www.opengis.net/def/crs/EPSG/0/"

#: Bounds.
MIN_LENGTH, MAX_LENGTH, MAX_SPACES, MIN_GAZETTEER, CAP = 3, 60, 4, 5, 50
DESCRIPTION_CHARS, TOPIC_CHARS, TOPIC_THRESHOLD, FUZZY_THRESHOLD, MIN_TEXT = 1000, 1000, 0.3, 85, 100
UNKNOWN_ORGANIZATION = "Unbekannt"
