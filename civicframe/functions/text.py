"""Text of papers: columns in, columns out. All built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicframe.functions import fixed as X


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(text: Column, pattern: str, group: int = 1) -> Column:
    """All matches of a group, without white space at their ends."""
    return F.transform(F.regexp_extract_all(text, F.lit(X.FLAGS + pattern), F.lit(group)), lambda m: F.trim(m))


def hits(text: Column, pattern: str) -> Column:
    """All matches as they stand: one pass of the pattern, whose groups ``group`` then takes from the short matches."""
    return F.regexp_extract_all(text, F.lit(X.FLAGS + pattern), F.lit(0))


def group(hit: Column, pattern: str, number: int = 1) -> Column:
    """A group of a match of a pattern without look-around, trimmed: the same as in the whole text."""
    return F.trim(F.regexp_extract(hit, X.FLAGS + pattern, number))


def bplans(text: Column, wide: bool = False) -> Column:
    return matches(text, X.BPLAN_WIDE if wide else X.BPLAN)


def parcels(text: Column, wide: bool = False) -> Column:
    return matches(text, X.PARCEL_WIDE if wide else X.PARCEL)


def addresses(text: Column) -> Column:
    """array<struct<street, number>>"""
    return F.transform(hits(text, X.ADDRESS_FAST), lambda h: F.struct(group(h, X.ADDRESS, 1).alias("street"), group(h, X.ADDRESS, 2).alias("number")))


def _free_streets(text: Column, taken: Column) -> Column:
    first = F.transform(taken, lambda a: F.lower(F.split_part(a["street"], F.lit(" "), F.lit(1))))
    return let(first, lambda words: F.filter(matches(text, X.STREET_FAST), lambda s: ~F.array_contains(words, F.lower(s))))


def streets(text: Column) -> Column:
    """Street names that aren't the first word of an address in the text."""
    return _free_streets(text, addresses(text))


def districts(text: Column) -> Column:
    return F.filter(matches(text, X.DISTRICT), lambda d: F.length(d) > 3)


def mentions(text: Column, wide: bool = False, with_districts: bool = False) -> Column:
    """array<struct<type, value, context>> in order of extraction: plans, parcels, addresses, streets (, districts)."""

    def found(kind: str, values: Column, value: Callable[[Column], Column], context: Callable[[Column], Column] | None = None) -> Column:
        none = F.lit(None).cast("string")
        one = lambda v: F.struct(F.lit(kind).alias("type"), value(v).alias("value"), (none if context is None else context(v)).alias("context"))
        return F.transform(values, one)

    itself = lambda v: v
    text = F.coalesce(text, F.lit(""))
    plan, parcel = (X.BPLAN_WIDE, X.PARCEL_WIDE) if wide else (X.BPLAN, X.PARCEL)
    numbered = [found(kind, hits(text, p), lambda h, p=p: group(h, p), itself) for kind, p in (("bplan", plan), ("flurnummer", parcel))]
    address = lambda a: F.concat_ws(" ", a["street"], a["number"])
    placed = let(addresses(text), lambda taken: F.concat(found("address", taken, address), found("street", _free_streets(text, taken), itself)))
    parts = [*numbered, placed]
    if with_districts:
        parts.append(found("district", districts(text), itself))
    return F.concat(*parts)


def passes_gate(value: Column) -> Column:
    return F.trim(value).rlike("(?U)" + X.GATE_FAST)


def not_blocked(value: Column) -> Column:
    """No blocked word comes first; a text that is one has no other word."""
    return ~F.substring_index(F.lower(F.trim(value)), " ", 1).isin(*X.BLOCKLIST)


def is_valid(value: Column, kind: Column, compat: bool = False) -> Column:
    """The composite rule. By default the gate lets plans and parcels pass; ``compat`` gates all types. Other texts of digits
    alone need no rule, as none passes the gate."""
    text = F.trim(value)
    numbered = kind.isin("bplan", "flurnummer")
    gate = passes_gate(text) if compat else numbered | passes_gate(text)
    long_enough = F.length(text).between(X.MIN_LENGTH, X.MAX_LENGTH)
    if not compat:
        long_enough = (numbered & F.length(text).between(1, X.MAX_LENGTH)) | long_enough
    return long_enough & gate & not_blocked(text) & (numbered | (spaces(text) <= X.MAX_SPACES))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def street_part(value: Column) -> Column:
    """An address without its house number."""
    return F.regexp_replace(value, r"\s+\d+[a-zA-Z]?$", "")


def keyword_candidates(text: Column) -> Column:
    """Distinct words of more than four characters that hold a street word; commas are dropped."""
    words = F.split(F.replace(text, F.lit(","), F.lit("")), r"(?U)\s+")
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 4) & F.lower(w).rlike("|".join(X.STREET_WORDS))))


def title_location(title: Column) -> Column:
    """A place in a title: in quotes if it ends like a street, else a street, else what follows 'in' and the like."""
    some = lambda pattern: F.nullif(F.regexp_extract(title, "(?U)" + pattern, 1), F.lit(""))
    quoted = some(X.TITLE_QUOTED)
    return F.coalesce(F.when(F.lower(quoted).rlike(X.TITLE_QUOTED_END), quoted), some(X.TITLE_STREET), some(X.TITLE_DISTRICT))


def normalize_url(url: Column) -> Column:
    return F.when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit("https://"), url))


def last_segment(url: Column) -> Column:
    """The last path segment; 'unknown' for a missing or empty one."""
    part = F.element_at(F.split(url, "/"), -1)
    return F.when(url.isNull() | (part == ""), F.lit("unknown")).otherwise(part)


def generate_uri(base: str, kind: Column, original: Column) -> Column:
    own = F.when(original.startswith("http"), F.element_at(F.split(original, "/"), -1)).otherwise(original)
    return F.concat(F.lit(base), kind, F.lit("/"), own)


def location_id(paper: Column, kind: Column, value: Column) -> Column:
    return F.concat_ws("_", paper, kind, F.replace(value, F.lit(" "), F.lit("_")))


def graph_location_id(paper: Column, kind: Column, value: Column) -> Column:
    return F.translate(F.concat_ws("_", paper, kind, F.coalesce(value, F.lit("unknown"))), " /", "_-")


def cache_key(value: Column, kind: Column | None = None, city: Column | None = None) -> Column:
    """MD5 of the lower-cased text, or (our default for the cache) of text, type and city."""
    if kind is None:
        return F.md5(F.lower(value))
    return F.md5(F.concat_ws("|", F.lower(value), kind, F.lower(city)))


def geocode_queries(value: Column, kind: Column, city: Column) -> Column:
    """What a geocoder is asked, in order; plans and parcels aren't asked for."""
    whole = F.concat(value, F.lit(", "), city, F.lit(", Deutschland"))
    fallback = F.concat(city, F.lit(", Deutschland"))
    return F.when(kind.isin("bplan", "flurnummer"), F.array().cast("array<string>")).when(kind.isin("address", "district"), F.array(whole, fallback)).otherwise(F.array(whole))


def wkt(lat: Column, lon: Column, srid: int | None = 4326, digits: int | None = None) -> Column:
    """A point, with the reference system in front; ``digits``: decimals (shortest text if None)."""
    number = (lambda c: c.cast("string")) if digits is None else (lambda c: F.format_string(f"%.{digits}f", c))
    point = F.concat(F.lit("POINT("), number(lon), F.lit(" "), number(lat), F.lit(")"))
    return point if srid is None else F.concat(F.lit(f"<{X.CRS}{srid}> "), point)


def wkt_coordinates(text: Column) -> Column:
    return F.regexp_replace(text, r".*POINT\(([^)]+)\).*", "$1")


def pdf_url(main: Column, files: Column, compat: bool = False) -> Column:
    """accessUrl of mainFile, else of the first file; ``compat``: a mainFile without URL hides the files."""
    first = F.get(files, F.lit(0))["accessUrl"]
    if compat:
        return F.when(main.isNotNull(), main["accessUrl"]).otherwise(first)
    return F.coalesce(main["accessUrl"], first)


def map_pdf_url(auxiliary: Column, main: Column) -> Column:
    """For maps: the first auxiliary file if there is one, else mainFile."""
    return F.coalesce(F.when(F.size(auxiliary) > 0, F.coalesce(F.get(auxiliary, F.lit(0))["accessUrl"], F.lit(""))), main["accessUrl"], F.lit(""))


def text_source(full: Column, pdf: Column) -> Column:
    return F.coalesce(F.nullif(full, F.lit("")), pdf, F.lit(""))


def cascade(methods: list[tuple[str, Column]], least: int = X.MIN_TEXT) -> Column:
    """struct<text, method> of the first method that yields at least so many characters; null if none does."""
    return F.coalesce(*[F.when(F.length(F.trim(c)) >= least, F.struct(c.alias("text"), F.lit(name).alias("method"))) for name, c in methods])
