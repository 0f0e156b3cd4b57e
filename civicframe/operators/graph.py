"""A graph as a table of triples (s, p, o, kind, datatype, lang): writing, patterns, shapes."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicframe.functions import fixed as X
from civicframe.functions import text as T
from civicframe.operators.storage import scratch

BASE = "https://records.example.org/"
TRIPLE = ["s", "p", "o", "kind", "datatype", "lang"]


#: A triple of a row: subject, object, kind, datatype, language.
Parts = tuple[Column, Column, str, str | None, str | None]


def uri(s: Column, p: str, o: Column) -> tuple[str, Parts]:
    return p, (s, o, "uri", None, None)


def literal(s: Column, p: str, o: Column, datatype: str | None = None, lang: str | None = None) -> tuple[str, Parts]:
    return p, (s, o.cast("string"), "literal", datatype, lang)


def _triple(s: Column, p: str, o: Column, kind: str, datatype: str | None, lang: str | None) -> Column:
    text = lambda v: F.lit(v).cast("string")
    whole = F.struct(s.alias("s"), text(p).alias("p"), o.alias("o"), text(kind).alias("kind"), text(datatype).alias("datatype"), text(lang).alias("lang"))
    return F.when((s.isNotNull()) & o.isNotNull() & (o != ""), whole)


def _exploded(df: DataFrame, triples: list[tuple[str, Parts]], only: Collection[str] | None = None, keep: tuple[str, ...] = (), node: Column | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """The triples (of the wanted predicates) that have all parts, each once (a graph is a set); ``keep``: further columns.

    ``node``: only rows with the same one have triples in common, and these are in the same place of the list. Then rows, not
    triples, are brought together, and a row leaves out what rows of its node before it had. ``within``: columns that the node
    determines; a table that is dealt by one of them needn't be dealt anew.
    """
    wanted = [(p, *t) for p, t in triples if only is None or p in only]
    if not wanted:
        return df.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in TRIPLE))
    # all texts are made once, in a projection of their own; arrays that a lambda filters would be computed without compiled code
    exploded = lambda rows, some: rows.select(*keep, F.explode(some).alias("t")).where("t is not null").select("t.*", *keep)
    names = [f"end{i}_" for i in range(len(wanted))]
    if node is None:
        rows = df.select(*keep, *[F.struct(t[1].alias("s"), t[2].alias("o")).alias(n) for n, t in zip(names, wanted, strict=True)])
        return exploded(rows, F.array(*[_triple(F.col(n)["s"], p, F.col(n)["o"], *rest) for n, (p, _, _, *rest) in zip(names, wanted, strict=True)])).dropDuplicates()
    ends = [(t[1] if t[2] is node else t[2]).alias(n) for n, t in zip(names, wanted, strict=True)]  # what isn't the node
    own = list(dict.fromkeys((*within, *keep)))
    before = Window.partitionBy(*own, "node_").orderBy("node_").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.select(*own, node.alias("node_"), *ends).withColumn("before_", F.collect_list(F.struct(*names)).over(before))
    cells = [_triple(F.col(n if o is node else "node_"), p, F.col("node_" if o is node else n), *rest) for n, (p, _, o, *rest) in zip(names, wanted, strict=True)]
    had = lambda n: F.exists("before_", lambda r: r[n].eqNullSafe(F.col(n)))
    fresh = [F.when(~had(n), t) for n, t in zip(names, cells, strict=True)]
    return exploded(rows, F.when(F.size("before_") == 0, F.array(*cells)).otherwise(F.array(*fresh)))


def paper_triples(papers: DataFrame, only: Collection[str] | None = None, keep: tuple[str, ...] = (), within: tuple[str, ...] = ()) -> DataFrame:
    """``only``: build just the triples of these predicates; columns that none of them needs aren't read. ``within``: columns
    that a paper's id determines."""
    s, c = F.col("id"), papers.columns
    stamp = lambda n: F.date_format(F.col(n).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss")
    out = [uri(s, X.RDF_TYPE, F.lit(X.OPARL + "Paper"))]
    if "name" in c:
        out += [literal(s, X.LABEL, F.col("name"), lang="de"), literal(s, X.TERMS + "title", F.col("name"))]
    if "reference" in c:
        out.append(literal(s, X.TERMS + "identifier", F.col("reference")))
    if "date" in c:
        out.append(literal(s, X.TERMS + "date", F.date_format(F.col("date"), "yyyy-MM-dd"), X.XSD + "date"))
    if "paper_type" in c:
        out.append(literal(s, X.TERMS + "type", F.col("paper_type")))
    if "full_text" in c:
        out.append(literal(s, X.TERMS + "description", F.left("full_text", F.lit(X.DESCRIPTION_CHARS))))
    if "pdf_url" in c:
        out.append(uri(s, X.TERMS + "hasFormat", F.col("pdf_url")))
    out += [literal(s, X.TERMS + n, stamp(n), X.XSD + "dateTime") for n in ("created", "modified") if n in c]
    return _exploded(papers, out, only, keep, s, within)


def location_triples(table: DataFrame, digits: int | None = None, only: Collection[str] | None = None, keep: tuple[str, ...] = (), within: tuple[str, ...] = ()) -> DataFrame:
    """Of the locations table: relation, feature, label, type, point, coordinates, names, method, document. ``within``: columns
    that a place's node determines."""
    paper = F.col("paper_id")
    s = F.concat(F.lit(BASE + "location/"), T.graph_location_id(paper, F.col("location_type"), F.col("location_value")))
    number = (lambda c: F.col(c).cast("string")) if digits is None else (lambda c: F.format_string(f"%.{digits}f", F.col(c)))
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    point = T.wkt(F.col("latitude"), F.col("longitude"), digits=digits)
    return _exploded(table, [
        uri(paper, X.OPARL + "relatesToLocation", s), uri(s, X.RDF_TYPE, F.lit(X.GEO + "Feature")),
        literal(s, X.LABEL, F.col("location_value"), lang="de"), literal(s, X.OPARL + "locationType", F.col("location_type")),
        literal(s, X.GEO + "hasGeometry", F.when(both, point), X.GEO + "wktLiteral"),
        literal(s, X.GEO + "lat", F.when(both, number("latitude")), X.XSD + "double"),
        literal(s, X.GEO + "long", F.when(both, number("longitude")), X.XSD + "double"),
        literal(s, X.OPARL + "displayName", F.col("display_name")), literal(s, X.OPARL + "extractionMethod", F.col("method")),
        uri(s, X.OPARL + "sourceDocument", F.col("pdf_url")),
    ], only, keep, s, within)


def relation_triples(relations: DataFrame, digits: int | None = None) -> DataFrame:
    """Stand-alone relations (paper_id, name, latitude, longitude, wkt, geo_uri): coordinates, else the given geometry."""
    name = F.nullif(F.col("name"), F.lit(""))
    s = F.concat(F.lit(BASE + "location/"), F.replace(F.translate(name, " /", "_-"), F.lit(","), F.lit("")))
    number = (lambda c: F.col(c).cast("string")) if digits is None else (lambda c: F.format_string(f"%.{digits}f", F.col(c)))
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    point = F.when(both, T.wkt(F.col("latitude"), F.col("longitude"), None, digits)).otherwise(F.col("wkt"))
    return _exploded(relations.where(name.isNotNull()), [
        uri(F.col("paper_id"), X.GEO + "hasGeometry", s), uri(s, X.RDF_TYPE, F.lit(X.GEO + "Feature")), literal(s, X.LABEL, name, lang="de"), literal(s, X.GEO + "hasGeometry", point, X.GEO + "wktLiteral"),
        literal(s, X.GEO + "lat", F.when(both, number("latitude")), X.XSD + "double"), literal(s, X.GEO + "long", F.when(both, number("longitude")), X.XSD + "double"), uri(s, X.SEE_ALSO, F.col("geo_uri")),
    ])


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """One line of N-Triples each (column value)."""
    text = F.col("o")
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(a), F.lit(b))
    tail = F.when(F.col("datatype").isNotNull(), F.concat(F.lit("^^<"), "datatype", F.lit(">"))).when(F.col("lang").isNotNull(), F.concat(F.lit("@"), "lang")).otherwise("")
    o = F.when(F.col("kind") == "uri", F.concat(F.lit("<"), "o", F.lit(">"))).when(F.col("kind") == "blank", F.col("o")).otherwise(F.concat(F.lit('"'), text, F.lit('"'), tail))
    s = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), "s", F.lit(">")))
    return triples.select(F.concat(s, F.lit(" <"), "p", F.lit("> "), o, F.lit(" .")).alias("value"))


def turtle_blocks(triples: DataFrame) -> DataFrame:
    """One block of Turtle for each subject (column value)."""
    line = ntriples_lines(triples).select(F.regexp_extract("value", r"^(\S+) (\S+) (.*) \.$", 1).alias("s"), F.regexp_extract("value", r"(?s)^(\S+) (\S+ .*) \.$", 2).alias("po"))
    return line.groupBy("s").agg(F.array_sort(F.collect_list("po")).alias("pos")).select(F.concat("s", F.lit(" "), F.array_join("pos", " ;\n    "), F.lit(" .")).alias("value"))


def write_ntriples(triples: DataFrame, path: str, append: bool = False, once: bool = False) -> None:
    """Lines of N-Triples. ``once``: lines that are there already aren't appended again, so that a run can be repeated."""
    lines = ntriples_lines(triples)
    if append and once:
        lines = lines.distinct()
        try:
            there = lines.sparkSession.read.text(path)
        except AnalysisException as error:  # nothing there yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
        else:
            lines = lines.join(there, "value", "left_anti")
    lines.write.mode("append" if append else "overwrite").text(path)


def write_turtle(triples: DataFrame, path: str) -> None:
    turtle_blocks(triples).write.mode("overwrite").text(path)


def xml_blocks(triples: DataFrame) -> DataFrame:
    """One RDF/XML description for each subject (column value); a predicate's namespace ends at its last # or /."""
    clean = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    name, space = F.regexp_extract("p", r"([^#/]*)$", 1), F.regexp_extract("p", r"^(.*[#/])", 1)
    head = F.concat(F.lit("<v:"), name, F.lit(' xmlns:v="'), clean(space), F.lit('"'))
    kind = F.when(F.col("datatype").isNotNull(), F.concat(F.lit(' rdf:datatype="'), clean(F.col("datatype")), F.lit('"')))
    kind = kind.when(F.col("lang").isNotNull(), F.concat(F.lit(' xml:lang="'), "lang", F.lit('"'))).otherwise("")
    node = F.when(F.col("kind") == "uri", F.concat(F.lit(' rdf:resource="'), clean(F.col("o")), F.lit('"/>')))
    node = node.when(F.col("kind") == "blank", F.concat(F.lit(' rdf:nodeID="'), F.regexp_replace("o", "^_:", ""), F.lit('"/>')))
    line = F.concat(F.lit("  "), head, node.otherwise(F.concat(kind, F.lit(">"), clean(F.col("o")), F.lit("</v:"), name, F.lit(">"))))
    about = F.when(F.col("s").startswith("_:"), F.concat(F.lit('rdf:nodeID="'), F.regexp_replace("s", "^_:", ""))).otherwise(F.concat(F.lit('rdf:about="'), clean(F.col("s"))))
    blocks = triples.groupBy("s").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("lines"))
    return blocks.select(F.concat(F.lit("<rdf:Description "), about, F.lit('">\n'), "lines", F.lit("\n</rdf:Description>")).alias("value"))


def write_xml(triples: DataFrame, path: str) -> None:
    """One RDF/XML document in a local file, streamed through the driver; for large graphs use N-Triples."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(f'<?xml version="1.0" encoding="UTF-8"?>\n<rdf:RDF xmlns:rdf="{X.RDF_TYPE.removesuffix("type")}">\n')
        for row in xml_blocks(triples).toLocalIterator():
            f.write(row["value"] + "\n")
        f.write("</rdf:RDF>\n")


def serialize(triples: DataFrame, path: str, form: str = "turtle") -> str:
    """Writes the graph as nt, turtle or xml; returns the path, with the form's extension."""
    writers = {"nt": (".nt", write_ntriples), "turtle": (".ttl", write_turtle), "xml": (".rdf", write_xml)}
    if form not in writers:
        raise ValueError(f"unknown form {form!r}; known are {', '.join(writers)}")
    ending, write = writers[form]
    path = path if path.endswith(ending) else path + ending
    write(triples, path)
    return path


def stored(triples: DataFrame) -> DataFrame:
    """Written once, a folder for each predicate, and read again: each pattern of a query then reads its own folder."""
    path = scratch(triples.sparkSession)
    triples.write.partitionBy("p").parquet(path)
    schema = StructType([*[f for f in triples.schema if f.name != "p"], triples.schema["p"]])
    return triples.sparkSession.read.schema(schema).parquet(path).select(*TRIPLE)


def bgp(triples: DataFrame, patterns: list[tuple[str, str, str]], optional: list[tuple[str, str, str]] = (), langs: dict[str, str] | None = None) -> DataFrame:
    """Solutions of a basic graph pattern: one join per pattern, which Catalyst orders.

    Terms that begin with ? are variables, all others are constants. ``optional`` patterns are left joins;
    ``langs`` asks for a language of a variable's literals.
    """

    def one(k: int, pattern: tuple[str, str, str]) -> DataFrame:
        t, names = triples, {}
        for col, term in zip(("s", "p", "o"), pattern, strict=True):
            if not term.startswith("?"):
                t = t.where(F.col(col) == term)
            elif term[1:] in names:
                t = t.where(F.col(col) == F.col(names[term[1:]]))
            else:
                names[term[1:]] = col
            if col == "o" and langs and term.startswith("?") and term[1:] in langs:
                t = t.where(F.col("lang") == langs[term[1:]])
        return t.select(*[F.col(c).alias(n) for n, c in names.items()])

    def join(how: str):
        def f(left: DataFrame, right: DataFrame) -> DataFrame:
            on = [c for c in right.columns if c in left.columns]
            return left.join(right, on, how) if on else left.crossJoin(right)

        return f

    out = reduce(join("inner"), (one(k, p) for k, p in enumerate(patterns)))
    return reduce(join("left"), (one(k, p) for k, p in enumerate(optional)), out)


def shape_issues(triples: DataFrame, target: str, required: dict[str, str | None]) -> DataFrame:
    """focus, path, problem: subjects of a class without a required predicate, or with a value of another datatype."""
    members = triples.where((F.col("p") == X.RDF_TYPE) & (F.col("o") == target)).select(F.col("s").alias("focus")).distinct()
    own = members.join(triples, F.col("focus") == F.col("s"), "left")
    counts = []
    for path, datatype in required.items():
        mine = F.col("p") == path
        counts.append(F.struct(F.lit(path).alias("path"), F.count_if(mine).alias("n"), (F.count_if(mine & ~F.col("datatype").eqNullSafe(F.lit(datatype))) if datatype else F.lit(0).cast("long")).alias("bad")))
    found = own.groupBy("focus").agg(F.array(*counts).alias("c")).select("focus", F.explode("c").alias("c"))
    found = found.select("focus", "c.path", F.when(F.col("c.n") == 0, "minCount").when(F.col("c.bad") > 0, "datatype").alias("problem"))
    return found.where("problem is not null")
