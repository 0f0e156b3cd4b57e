"""Data quality: issues as rows (severity, category, message, resource_id, field, value, expected), summaries, reports."""

from __future__ import annotations

import html
import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicframe.functions import time as D

ISSUE = "severity string, category string, message string, resource_id string, field string, value string, expected string"
_NAMES = [x.split()[0] for x in ISSUE.split(", ")]


def _issue(when: Column, severity: str, category: str, message: str, resource: Column, field: str, value: Column | None = None, expected: str | None = None) -> Column:
    text = lambda v: F.lit(v).cast("string")
    parts = (text(severity), text(category), text(message), resource.cast("string"), text(field), text(None) if value is None else value.cast("string"), text(expected))
    return F.when(F.coalesce(when, F.lit(False)), F.struct(*[p.alias(n) for p, n in zip(parts, _NAMES, strict=True)]))


def _issues(df: DataFrame, rules: list[Column]) -> DataFrame:
    return df.select(F.explode(F.filter(F.array(*rules), lambda i: i.isNotNull())).alias("i")).select("i.*")


def validate_papers(papers: DataFrame, order: str) -> DataFrame:
    """Rules for papers (id, name, date as text, main_file as a struct with accessUrl). ``order`` tells which of equal ids came first."""
    p = papers.withColumn("nth_", F.row_number().over(Window.partitionBy("id").orderBy(order)))
    rid = F.col("id")
    rules = [_issue(F.col(f).isNull(), "ERROR", "missing_field", f'Required field "{f}" is missing', rid, f) for f in ("id", "name", "date")]
    rules.append(_issue((F.col("nth_") > 1) & rid.isNotNull(), "ERROR", "duplicate", "Duplicate paper ID", rid, "id"))
    rules.append(_issue((F.col("date") != "") & ~D.is_iso(F.col("date")), "ERROR", "invalid_date", "Invalid date format", rid, "date", F.col("date"), "ISO 8601 format (YYYY-MM-DD)"))
    if "main_file" in papers.columns:
        rules.append(_issue(F.col("main_file").isNotNull() & F.col("main_file.accessUrl").isNull(), "WARNING", "missing_field", "PDF accessUrl is missing", rid, "mainFile.accessUrl"))
    rules.append(_issue(F.trim("name") == "", "WARNING", "empty_value", "Paper name is empty", rid, "name"))
    return _issues(p, rules)


def validate_locations(locations: DataFrame) -> DataFrame:
    """Rules for locations (text, type, paper_id, lat and lon as text)."""
    rid = F.col("paper_id")
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    given = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    numeric = given & lat.isNotNull() & lon.isNotNull()
    rules = [_issue(F.col(f).isNull(), "WARNING", "missing_field", f'Field "{f}" is missing in location', rid, f) for f in ("text", "type", "paper_id")]
    rules.append(_issue(numeric & ~lat.between(-90, 90), "ERROR", "invalid_coordinates", "Latitude out of range", rid, "coordinates.lat", F.col("lat"), "-90 to 90"))
    rules.append(_issue(numeric & ~lon.between(-180, 180), "ERROR", "invalid_coordinates", "Longitude out of range", rid, "coordinates.lon", F.col("lon"), "-180 to 180"))
    rules.append(_issue(given & ~numeric, "ERROR", "invalid_coordinates", "Coordinates must be numeric", rid, "coordinates"))
    rules.append(_issue(F.trim("text") == "", "WARNING", "empty_value", "Location text is empty", rid, "text"))
    return _issues(locations, rules)


def validate_empty(df: DataFrame, severity: str, what: str) -> DataFrame:
    """One issue if there are no rows."""
    none = df.limit(1).agg(F.count("*").alias("n")).where("n = 0")
    return _issues(none, [_issue(F.lit(True), severity, "empty_data", f"No {what} to validate", F.lit(None), "rows")])


def null_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """field, nulls: a row for each column, in one pass."""
    counts = df.agg(F.array(*[F.struct(F.lit(c).alias("field"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in columns]).alias("c"))
    return counts.select(F.explode("c").alias("c")).select("c.*")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows that repeat a key; nulls count as equal."""
    per = df.groupBy(key).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def validate_dataset(spark: SparkSession, path: str, critical: tuple[str, ...] = ("id", "name", "city", "year")) -> DataFrame:
    """Issues of a Parquet dataset: missing or unreadable, empty, nulls in critical columns, repeated ids."""
    try:
        df = spark.read.parquet(path)
    except Exception as error:  # a report has to say so
        missing = "PATH_NOT_FOUND" in str(error)
        row = ("ERROR", "missing_dataset" if missing else "read_error", "Dataset does not exist" if missing else "Dataset cannot be read", path, None, None, None)
        return spark.createDataFrame([row], ISSUE)
    out = validate_empty(df, "WARNING", "rows")
    have = tuple(c for c in critical if c in df.columns)
    nulls = null_counts(df, have).where("nulls > 0")
    out = out.unionByName(_issues(nulls.withColumn("message", F.concat(F.lit("Null values in "), "field")), [F.struct(F.lit("WARNING").alias("severity"), F.lit("null_values").alias("category"), F.col("message"), F.lit(path).alias("resource_id"), F.col("field"), F.col("nulls").cast("string").alias("value"), F.lit(None).cast("string").alias("expected"))]))
    if "id" in df.columns:
        again = duplicates(df, "id").where("duplicates > 0")
        out = out.unionByName(_issues(again, [_issue(F.lit(True), "ERROR", "duplicate", "Duplicate ids in dataset", F.lit(path), "id", F.col("duplicates"))]))
    return out


def summary(issues: DataFrame) -> DataFrame:
    """errors, warnings, infos, is_valid in one row."""
    by = lambda s: F.count_if(F.col("severity") == s)
    return issues.agg(by("ERROR").alias("errors"), by("WARNING").alias("warnings"), by("INFO").alias("infos")).withColumn("is_valid", F.col("errors") == 0)


def write_report(issues: DataFrame, folder: str, at: datetime | None = None, most: int = 10_000) -> dict:
    """All issues as JSON lines in ``issues`` (by Spark), and report.json, report.txt, report.html with the counts of all and
    the first ``most``; they say how many more there are. Returns the counts.
    """
    issues.write.mode("overwrite").json(f"{folder}/issues")
    issues = issues.sparkSession.read.schema(ISSUE).json(f"{folder}/issues")
    counts = summary(issues).first().asDict()
    rows = [r.asDict() for r in issues.orderBy(*_NAMES).limit(most).collect()]
    more = counts["errors"] + counts["warnings"] + counts["infos"] - len(rows)
    stamp = (at or datetime.now()).isoformat()
    where = Path(folder)
    where.mkdir(parents=True, exist_ok=True)
    (where / "report.json").write_text(json.dumps({"generated_at": stamp, "summary": counts, "issues": rows, "more": more}, ensure_ascii=False, indent=2), encoding="utf-8")
    lines = [f"Report of {stamp}", ", ".join(f"{k}: {v}" for k, v in counts.items()), ""] + [f"[{r['severity']}] {r['category']}: {r['message']} ({r['resource_id']}, {r['field']})" for r in rows]
    rest = [f"{more} more issues are in the folder issues"] if more else []
    (where / "report.txt").write_text("\n".join(lines + rest), encoding="utf-8")
    cells = "".join("<tr>" + "".join(f"<td>{html.escape(str(r[n] or ''))}</td>" for n in _NAMES) + "</tr>" for r in rows)
    head = "".join(f"<th>{n}</th>" for n in _NAMES)
    page = f"<!DOCTYPE html><meta charset='utf-8'><title>Report</title><p>{html.escape(lines[1])}</p><table><tr>{head}</tr>{cells}</table>" + "".join(f"<p>{x}</p>" for x in rest)
    (where / "report.html").write_text(page, encoding="utf-8")
    return counts
