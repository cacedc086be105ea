"""Audits: rules become rows of one issues table, metrics are counted in one pass and must reconcile to their totals."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.functions import fixed
from sedimenta.functions.values import percent
from sedimenta.operators.classify import coordinate_class, coordinate_reasons

ISSUE = "severity string, code string, path string, message string"


def counts_by(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def fixed_domain_counts(df: DataFrame, c: str, domain: list[str]) -> DataFrame:
    """Every value of the domain, with 0 where it doesn't occur."""
    values = df.sparkSession.createDataFrame([(v,) for v in domain], "value string")
    return values.join(counts_by(df, c), "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


def metrics(df: DataFrame, cells: dict[str, Column]) -> DataFrame:
    """Many conditional aggregates in one pass, as rows of metric and value."""
    wide = df.agg(*[c.cast("double").alias(name) for name, c in cells.items()])
    return wide.unpivot([], list(cells), "metric", "value")


def described(values: DataFrame, definitions: dict[str, tuple[str, str, str]]) -> DataFrame:
    """metric, definition, input, method and result of each metric."""
    rows = values.sparkSession.createDataFrame([(m, *d) for m, d in definitions.items()], "metric string, definition string, input string, method string")
    return rows.join(values.withColumnRenamed("value", "result"), "metric", "left")


def distinct_summary(df: DataFrame, c: str) -> DataFrame:
    """rows, distinct values and how many rows repeat one."""
    return df.agg(F.count(c).alias("total"), F.count_distinct(c).alias("distinct_values")).withColumn("repeated", F.col("total") - F.col("distinct_values"))


def dangling(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose key has no parent; a null key has none."""
    return children.join(parents.select(F.col(parent_key).alias("_p")).distinct(), F.col(child_key) == F.col("_p"), "left_anti")


def mismatched(live: DataFrame, outcomes: DataFrame, key: str, status: str) -> DataFrame:
    """Items without an outcome, or with another status than it."""
    o = outcomes.select(F.col(key).alias("_k"), F.col(status).alias("_s"))
    out = live.join(o, F.col(key) == F.col("_k"), "left")
    return out.where(F.col("_k").isNull() | ~F.col(status).eqNullSafe(F.col("_s"))).select(key, status, F.col("_s").alias("outcome"))


def reconciled(name: str, total: DataFrame, terms: DataFrame) -> DataFrame:
    """check, total, sum of terms and whether they balance; total and terms have one column n each."""
    t = total.agg(F.sum("n").alias("total"))
    return t.withColumn("terms", F.coalesce(terms.agg(F.sum("n").alias("s")).scalar(), F.lit(0))).select(F.lit(name).alias("check"), "total", "terms", (F.col("total") == F.col("terms")).alias("balanced"))


def contiguity(df: DataFrame, sequence: str) -> DataFrame:
    """Gaps in a sequence that should run from 1 to its length: first and last missing number of each."""
    n = df.select(F.col(sequence).cast("bigint").alias("s")).where("s is not null").distinct()
    ranges = n.withColumn("_b", F.floor(F.col("s") / 100_000))
    inner = ranges.withColumn("before", F.lag("s").over(Window.partitionBy("_b").orderBy("s")))
    edges = ranges.groupBy("_b").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    # Only the edges of blocks of 100,000 numbers meet in one place.
    between = edges.withColumn("before", F.coalesce(F.lag("hi").over(Window.orderBy("lo")), F.lit(0))).select(F.col("lo").alias("s"), "before")
    gaps = inner.where("before is not null").select("s", "before").unionByName(between)
    return gaps.where("s - before > 1").select((F.col("before") + 1).alias("first_missing"), (F.col("s") - 1).alias("last_missing"))


@dataclass(frozen=True)
class Rule:
    """Rows that break a rule, as an issue each."""

    code: str
    severity: str
    message: str
    path: str
    find: Callable[[dict[str, DataFrame]], DataFrame]


def issues(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """All issues of all rules."""
    parts = [r.find(tables).select(F.lit(r.severity).alias("severity"), F.lit(r.code).alias("code"), F.col(r.path).cast("string").alias("path"), F.lit(r.message).alias("message")) for r in rules]
    return reduce(DataFrame.unionByName, parts)


def verdict(found: DataFrame) -> DataFrame:
    """Issues by severity, and passed: none is critical."""
    cells = [F.count_if(F.col("severity") == s).alias(s) for s in ("critical", "warning", "info")]
    return found.agg(*cells).withColumn("passed", F.col("critical") == 0)


def record_rules() -> list[Rule]:
    """Keys, links between tables, truth of statuses, and coordinates."""
    repeated = lambda t, k: t.groupBy(k).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return [
        Rule("record_id_repeated", "critical", "a record's id isn't its own", "record_id", lambda t: repeated(t["records"], "record_id")),
        Rule("source_id_repeated", "critical", "a source's id isn't its own", "source_id", lambda t: repeated(t["sources"], "source_id")),
        Rule("reference_id_repeated", "critical", "a reference's id isn't its own", "source_reference_id", lambda t: repeated(t["references"], "source_reference_id")),
        Rule("reference_without_record", "critical", "a reference's record doesn't exist", "source_reference_id", lambda t: dangling(t["references"], t["records"], "record_id", "record_id")),
        Rule("reference_without_source", "critical", "a reference's source doesn't exist", "source_reference_id", lambda t: dangling(t["references"].where("source_id is not null"), t["sources"], "source_id", "source_id")),
        Rule("full_text_without_text", "critical", "a full-text status without a text", "source_id", lambda t: t["sources"].where("content_status like 'FULL_TEXT%' and coalesce(text, '') = ''")),
        Rule("metadata_only_with_text", "critical", "a metadata-only status with a text", "source_id", lambda t: t["sources"].where("content_status = 'METADATA_ONLY' and coalesce(text, '') != ''")),
        Rule("blocked_as_success", "critical", "a 403 that counts as fetched", "source_id", lambda t: t["sources"].where("http_status = 403 and reachability = 'FETCHED'")),
        Rule("record_without_reference", "warning", "a record cites no source", "record_id", lambda t: t["records"].join(t["references"].select("record_id"), "record_id", "left_anti")),
        Rule("coordinates_not_drawable", "info", "a record that can't be on the map", "record_id", lambda t: t["records"].where(coordinate_class("latitude", "longitude") != "drawable")),
    ]


def release_gates(t: dict[str, DataFrame]) -> DataFrame:
    """name, found and ok of each gate of a release: found counts what breaks it.

    t has records, sources and references, and optionally index (id, kind), points (record_id), pages (record_id) and
    exports (raw_url, normalized_url); gates of tables that aren't given are left out.
    """
    records, sources, references = t["records"], t["sources"], t["references"]
    statuses = sources.groupBy("content_status").agg(F.count(F.lit(1)).alias("n"))
    unknown = statuses.where(~F.col("content_status").isin(*fixed.SOURCE_STATUSES))
    gates = [(r.code, r.find(t)) for r in record_rules() if r.severity == "critical"]
    gates += [
        ("status_unknown", unknown),
        ("status_missing", sources.where("content_status is null")),
        ("blocked_without_evidence", sources.where("content_status = 'BLOCKED' and reachability != 'BLOCKED'")),
        ("dead_without_evidence", sources.where("content_status = 'DEAD' and reachability != 'DEAD'")),
        ("malformed_with_host", sources.where("content_status = 'MALFORMED' and url_status != 'malformed'") if "url_status" in sources.columns else sources.where("false")),
        ("raw_url_lost", references.where("raw_url is null") if "raw_url" in references.columns else references.where("false")),
        ("source_without_reference", sources.join(references.select("source_id"), "source_id", "left_anti")),
    ]
    if "index" in t:
        wanted = records.select(F.col("record_id").alias("id"), F.lit("record").alias("kind")).unionByName(sources.select(F.col("source_id").alias("id"), F.lit("source").alias("kind")))
        gates += [("index_lacks", wanted.join(t["index"], ["id", "kind"], "left_anti")), ("index_has_more", t["index"].join(wanted, ["id", "kind"], "left_anti"))]
    if "points" in t:
        drawable = records.where(coordinate_class("latitude", "longitude") == "drawable").select("record_id")
        gates += [("point_missing", drawable.join(t["points"], "record_id", "left_anti")), ("point_not_drawable", t["points"].join(drawable, "record_id", "left_anti"))]
    if "pages" in t:
        gates += [("page_missing", records.select("record_id").join(t["pages"], "record_id", "left_anti")), ("page_orphaned", t["pages"].join(records.select("record_id"), "record_id", "left_anti"))]
    if "exports" in t:
        gates += [(f"export_lacks_{c}", references.where(F.coalesce(F.col(c), F.lit("")) != "").select(c).join(t["exports"].select(c), c, "left_anti")) for c in ("raw_url", "normalized_url")]
    parts = [rows.agg(F.count(F.lit(1)).alias("found")).select(F.lit(name).alias("name"), "found", (F.col("found") == 0).alias("ok")) for name, rows in gates]
    return reduce(DataFrame.unionByName, parts)


def map_coverage(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Records in all and on the map, the share, and records by coordinate class."""
    kind = coordinate_class(lat, lon)
    n = F.count(F.lit(1))
    cells = [F.count_if(F.col("_c") == c).alias(c) for c in ("drawable", "missing", "malformed", "outside_accepted_range")]
    return df.select(kind.alias("_c")).agg(n.alias("total"), *cells, percent(F.count_if(F.col("_c") == "drawable"), n, 4).alias("coverage_pct"))


def coordinate_faults(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Records by each reason why they aren't on the map."""
    return df.select(F.explode(coordinate_reasons(lat, lon)).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def acceptance(criteria: DataFrame) -> DataFrame:
    """accepted: all criteria hold. criteria has name and ok."""
    return criteria.agg(F.count(F.lit(1)).alias("criteria"), F.count_if(~F.col("ok")).alias("failed"), F.bool_and("ok").alias("accepted"))


def resolve_link(page: Column, href: Column) -> Column:
    """The site path that a relative link leads to; null if it leaves the site's root. Query and fragment go."""
    bare = F.regexp_replace(href, r"[?#].*$", "")
    base = F.regexp_replace(page, r"[^/]*$", "")
    whole = F.when(bare.startswith("/"), bare).when(bare == "", page).otherwise(F.concat(base, bare))
    parts = F.filter(F.split(whole, "/"), lambda p: (p != "") & (p != "."))
    start = F.struct(F.array().cast("array<string>").alias("path"), F.lit(True).alias("ok"))

    def step(acc: Column, p: Column) -> Column:
        up = p == ".."
        inside = ~up | (F.size(acc["path"]) > 0)
        path = F.when(up, F.slice(acc["path"], F.lit(1), F.greatest(F.size(acc["path"]) - 1, F.lit(0)))).otherwise(F.concat(acc["path"], F.array(p)))
        return F.struct(path.alias("path"), (acc["ok"] & inside).alias("ok"))

    return F.aggregate(parts, start, step, lambda acc: F.when(acc["ok"], F.concat(F.lit("/"), F.array_join(acc["path"], "/"), F.when(whole.endswith("/") & (F.size(acc["path"]) > 0), "/").otherwise(""))))


def link_audit(pages: DataFrame, files: DataFrame) -> DataFrame:
    """page, href, target and problem (broken or escapes) of every bad internal link.

    pages has path and html; files has path. A folder stands for its index.html.
    """
    links = pages.select("path", F.explode(F.regexp_extract_all("html", F.lit(r"(?i)\b(?:href|src)\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))).alias("href"))
    internal = links.where(~F.col("href").rlike(r"(?i)^([a-z][a-z0-9+.-]*:|//|#)"))
    found = internal.withColumn("target", resolve_link(F.col("path"), F.col("href")))
    found = found.withColumn("target", F.when(F.col("target").endswith("/"), F.concat("target", F.lit("index.html"))).otherwise(F.col("target")))
    known = files.select(F.col("path").alias("_f")).distinct()
    broken = found.where("target is not null").join(known, F.col("target") == F.col("_f"), "left_anti").withColumn("problem", F.lit("broken"))
    return broken.unionByName(found.where("target is null").withColumn("problem", F.lit("escapes")))


def summary_report(spark: SparkSession, records: DataFrame, status: str, domain: list[str]) -> DataFrame:
    """For each status of the domain its records and up to 20 of their ids."""
    rows = records.select(F.col(status).alias("value"), "record_id")
    # Each task keeps its first 20 of a status before anything is shuffled.
    first = rows.distinct().withColumn("_n", F.row_number().over(Window.partitionBy("value").orderBy("record_id"))).where("_n <= 20")
    examples = first.groupBy("value").agg(F.array_sort(F.collect_list("record_id")).alias("examples"))
    groups = rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).join(examples, "value")
    values = spark.createDataFrame([(v,) for v in domain], "value string")
    return values.join(groups, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))
