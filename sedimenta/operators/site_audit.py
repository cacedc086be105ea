"""The validator of a site: records, sources, relationships, media, map, files and pages, as one table of issues.

Rules that look at one row are tested together: each table is read once and gives an array of faults a row. Rules about keys are
counts by key, rules between tables are anti joins. Nothing is collected; a table that isn't given has no rules, and `checks` says so.

Tables (columns that a rule doesn't find are taken as null):

    records        record_id, path, public_code, schema_version, parser_version, canonical_url, completeness_status, missing_sections
                   (array), provenance (array of field names), sources_section_present, source_urls, media_urls (arrays), and
                   the columns that SiteRules names
    sources        source_id, path, normalized_url, content_hash, status, text_original, text_translated, duplicate_group, record_ids (array)
    relationships  record_id, source_id
    media          media_id, local_path, sha256
    points         record_id, lat, lon
    coverage       included, excluded, total (one row)
    files          path (below the site's root) and content (null for what isn't read)
    stored         path of every file that is kept, published or not

Not among the rules: JSON that can't be parsed before it is a record (the readers keep it apart), JSON Schema, the scope of a pilot, and
saved credentials (`extract.credential_like` finds those).

Null ids count as one key that is missing. Null arrays are empty. Rows that repeat are issues of each row, but a key that repeats
is one issue. Empty tables give none, except that expected files and an empty coverage are missing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.audit import resolve_link
from sedimenta.operators.classify import coordinate_reasons

#: Codes of issues with their severities. Fixed values.
SEVERITIES = {
    "absolute_repository_root_path": "critical",
    "invalid_external_url": "warning",
    "internal_link_escapes_site": "critical",
    "broken_internal_link": "critical",
    "missing_case_page": "critical",
    "missing_case_json": "critical",
    "invalid_case_json": "critical",
    "missing_pagination_page": "critical",
    "unexpected_schema_version": "warning",
    "unexpected_parser_version": "warning",
    "missing_internal_id": "critical",
    "normalized_json_not_published": "critical",
    "invalid_primary_source_url": "critical",
    "complete_record_missing_requirements": "critical",
    "missing_field_provenance": "critical",
    "empty_source_section": "warning",
    "invalid_source_url": "warning",
    "embedded_media_binary": "critical",
    "missing_local_media_file": "critical",
    "duplicate_internal_id": "critical",
    "duplicate_public_incident_code": "warning",
    "missing_map_coverage_report": "critical",
    "map_point_count_mismatch": "critical",
    "map_coverage_total_mismatch": "critical",
    "invalid_coordinate_in_map": "critical",
    "committed_media_binary": "critical",
    "duplicate_stable_source_id": "critical",
    "unknown_source_retrieval_status": "critical",
    "source_text_not_separated": "critical",
    "missing_source_page": "critical",
    "source_page_missing_provenance": "critical",
    "duplicate_normalized_source_url": "critical",
    "unrecorded_exact_content_duplicate": "critical",
    "duplicate_incident_source_relationship": "critical",
    "orphan_incident_source_relationship": "critical",
    "missing_incident_source_relationship": "critical",
    "media_placeholder_has_local_binary": "critical",
}

#: Endings of files that hold images, video or sound. Fixed values.
MEDIA_ENDINGS = [".jpg", ".jpeg", ".png", ".gif", ".webp", ".avif", ".tif", ".tiff", ".mp4", ".mov", ".avi", ".mkv", ".webm", ".mp3", ".wav", ".ogg"]

#: A link of a page, as the validator finds them. Fixed value.
LINK = r"(?i)(?<![-\w])(?:href|src)\s*=\s*[\"']([^\"']+)[\"']"

#: Files of the case with a number, and of the page of a list. Fixed values.
CASE_PAGE, CASE_JSON, LIST_PAGE, LIST_LENGTH = "cases/%04d/index.html", "cases/%04d/data.json", "pages/page-%03d.html", 100

Tables = dict[str, DataFrame]
FAULT = "array<struct<code:string,value:string>>"


@dataclass(frozen=True)
class SiteRules:
    """What a site's records must have."""

    schema_version: str
    parser_version: str
    required_fields: tuple[str, ...] = ()  # of records that are called complete
    provenance_fields: tuple[str, ...] = ()  # where a value needs an origin
    statuses: tuple[str, ...] = ()  # of sources
    expected_cases: int | None = None


def valid_external(url: Column) -> Column:
    """mailto and tel with something behind them, http and https with a host."""
    return url.rlike(r"(?i)^(?:(?:mailto|tel):[^?#]|https?://[^/?#])")


def external(url: Column) -> Column:
    """With a scheme, or relative to one."""
    return url.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:|//)")


def _given(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("")) != ""


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _fault(code: str, found: Column, value: Column | None = None) -> Column:
    """One fault where found holds."""
    one = F.array(F.struct(F.lit(code).alias("code"), (F.lit(None) if value is None else value).cast("string").alias("value")))
    return F.when(found, one.cast(FAULT)).otherwise(F.array().cast(FAULT))


def _faults(code: str, values: Column) -> Column:
    """A fault for each of an array's values."""
    return F.transform(F.coalesce(values.cast("array<string>"), F.array().cast("array<string>")), lambda v: F.struct(F.lit(code).alias("code"), v.alias("value"))).cast(FAULT)


def _rows(df: DataFrame, path: Column, *faults: Column) -> DataFrame:
    """All faults of a table's rows by one pass."""
    return df.select(path.cast("string").alias("path"), F.explode(F.concat(*faults)).alias("f")).select("f.code", "path", "f.value")


def _issue(df: DataFrame, code: str, path: Column, value: Column | None = None) -> DataFrame:
    return df.select(F.lit(code).alias("code"), path.cast("string").alias("path"), (F.lit(None) if value is None else value).cast("string").alias("value"))


def _without(df: DataFrame, wanted: Column, known: DataFrame, column: str) -> DataFrame:
    """Rows whose wanted value isn't in a column of known."""
    have = "_have"
    while have in df.columns:
        have += "_"
    values = known.select(F.col(column).alias(have)).where(F.col(have).isNotNull()).distinct()
    return df.join(values, wanted == F.col(have), "left_anti")


def record_issues(t: Tables, rules: SiteRules) -> list[DataFrame]:
    r = t["records"]
    value = lambda name, kind="string": _column(r, name, kind)
    path = F.coalesce(value("path"), value("record_id"))
    own, listed = value("record_id"), "array<string>"
    some = lambda name: F.coalesce(value(name, listed), F.array().cast(listed))
    lacks = F.array_compact(F.array(*[F.when(~_given(value(f)), F.lit(f)) for f in rules.required_fields]).cast(listed))
    missing = F.concat(lacks, some("missing_sections"))
    unexplained = F.array_compact(F.array(*[F.when(_given(value(f)) & ~F.array_contains(some("provenance"), f), F.lit(f)) for f in rules.provenance_fields]).cast(listed))
    found = _rows(
        r,
        path,
        _fault("unexpected_schema_version", ~value("schema_version").eqNullSafe(F.lit(rules.schema_version)), value("schema_version")),
        _fault("unexpected_parser_version", ~value("parser_version").eqNullSafe(F.lit(rules.parser_version)), value("parser_version")),
        _fault("missing_internal_id", ~_given(own)),
        _fault("invalid_primary_source_url", _given(value("canonical_url")) & ~valid_external(value("canonical_url")), value("canonical_url")),
        _fault("complete_record_missing_requirements", value("completeness_status").eqNullSafe(F.lit("complete")) & (F.size(missing) > 0), F.array_join(missing, ",")),
        _faults("missing_field_provenance", unexplained),
        _fault("empty_source_section", F.coalesce(value("sources_section_present", "boolean"), F.lit(False)) & (F.size(some("source_urls")) == 0)),
        _faults("invalid_source_url", F.filter(some("source_urls"), lambda u: (u != "") & ~valid_external(u))),
        _fault("embedded_media_binary", F.exists(some("media_urls"), lambda u: u.startswith("data:"))),
    )
    keys = r.select(F.coalesce(own, F.lit("")).alias("k"), path.alias("p")).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("p")).where("k = '' or n > 1")
    codes = r.where(_given(value("public_code"))).groupBy(value("public_code").alias("c")).agg(F.min(F.coalesce(own, F.lit(""))).alias("a"), F.max(F.coalesce(own, F.lit(""))).alias("b"))
    out = [found, _issue(keys, "duplicate_internal_id", F.col("p"), F.col("k")), _issue(codes.where("a != b"), "duplicate_public_incident_code", F.lit("data/incidents"), F.col("c"))]
    if "files" in t:
        out.append(_issue(_without(r.where(_given(own)), F.concat(F.lit("data/incidents/"), own, F.lit(".json")), t["files"], "path"), "normalized_json_not_published", path))
        local = r.select(path.alias("p"), F.explode(F.filter(some("media_urls"), lambda u: (u != "") & ~external(u))).alias("u"))
        inside = F.coalesce(F.substring(resolve_link(F.lit("/"), F.col("u")), 2, 1 << 30), F.lit(""))
        out.append(_issue(_without(local, inside, t["files"], "path"), "missing_local_media_file", F.col("p"), F.col("u")))
    return out


def source_issues(t: Tables, rules: SiteRules) -> list[DataFrame]:
    s = t["sources"]
    value = lambda name: _column(s, name)
    own = value("source_id")
    path = F.coalesce(value("path"), F.concat(F.lit("data/sources/"), own, F.lit(".json")), F.lit("data/sources"))
    found = _rows(
        s,
        path,
        _fault("unknown_source_retrieval_status", ~F.coalesce(value("status").isin(*rules.statuses), F.lit(False)), value("status")),
        _fault("source_text_not_separated", value("text_original").isNull() | value("text_translated").isNull()),
    )
    ids = s.groupBy(own.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min(path).alias("p")).where("n > 1")
    urls = s.groupBy(F.coalesce(value("normalized_url"), F.lit("")).alias("u")).agg(F.count(F.lit(1)).alias("n")).where("u = '' or n > 1")
    bodies = s.where(_given(value("content_hash"))).groupBy(value("content_hash").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~_given(value("duplicate_group"))).alias("bare")).where("n > 1 and bare > 0")
    out = [
        found,
        _issue(ids, "duplicate_stable_source_id", F.col("p"), F.col("k")),
        _issue(urls, "duplicate_normalized_source_url", F.lit("data/sources"), F.col("u")),
        _issue(bodies, "unrecorded_exact_content_duplicate", F.lit("data/sources"), F.col("h")),
    ]
    if "files" in t:
        page = F.concat(F.lit("sources/"), own, F.lit("/index.html"))
        pages = t["files"].select(F.col("path").alias("_p"), F.coalesce(F.col("content"), F.lit("")).contains("source-provenance").alias("_ok")).groupBy("_p").agg(F.bool_and("_ok").alias("_ok"))
        seen = s.select(page.alias("p")).where("p is not null").join(pages, F.col("p") == F.col("_p"), "left")
        out.append(seen.where("_ok is null").select(F.lit("missing_source_page").alias("code"), F.col("p").alias("path"), F.lit(None).cast("string").alias("value")))
        out.append(seen.where("not _ok").select(F.lit("source_page_missing_provenance").alias("code"), F.col("p").alias("path"), F.lit(None).cast("string").alias("value")))
    return out


def relationship_issues(t: Tables) -> list[DataFrame]:
    """Pairs that repeat, that lead nowhere, and that a source claims but no row has."""
    pair = t["relationships"].select(F.col("record_id").cast("string").alias("r"), F.col("source_id").cast("string").alias("s"))
    known = pair.groupBy("r", "s").agg(F.count(F.lit(1)).alias("n"))
    name = F.concat_ws("|", "r", "s")
    at = F.lit("data/relationships")
    records = t["records"].select(F.col("record_id").cast("string").alias("r")).where("r is not null").distinct()
    sources = t["sources"].select(F.col("source_id").cast("string").alias("s")).where("s is not null").distinct()
    both = known.join(records.withColumn("_r", F.lit(True)), "r", "left").join(sources.withColumn("_s", F.lit(True)), "s", "left")
    out = [
        _issue(known.where("n > 1"), "duplicate_incident_source_relationship", at, name),
        _issue(both.where("_r is null or _s is null"), "orphan_incident_source_relationship", at, name),
    ]
    if "record_ids" in t["sources"].columns:
        claimed = t["sources"].select(F.col("source_id").cast("string").alias("s"), F.explode(F.col("record_ids").cast("array<string>")).alias("r"))
        lost = claimed.join(known.select("r", "s"), ["r", "s"], "left_anti")
        out.append(_issue(lost, "missing_incident_source_relationship", F.concat(F.lit("data/sources/"), F.col("s"), F.lit(".json")), F.col("r")))
    return out


def media_issues(t: Tables) -> list[DataFrame]:
    m = t["media"]
    held = _column(m, "local_path").isNotNull() | _column(m, "sha256").isNotNull()
    return [_issue(m.where(held), "media_placeholder_has_local_binary", F.concat(F.lit("data/media/"), F.col("media_id").cast("string"), F.lit(".json")))]


def map_issues(t: Tables) -> list[DataFrame]:
    at, report = F.lit("data/generated/map-points.json"), F.lit("data/reports/map-coverage.json")
    p = t["points"]
    n = lambda c: F.coalesce(F.sum(c), F.lit(0))
    said = t["coverage"].agg(F.count(F.lit(1)).alias("reports"), n("included").alias("i"), n("excluded").alias("e"), n("total").alias("t"))
    beside = said.withColumn("points", F.coalesce(p.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0)))
    reasons = coordinate_reasons(F.col("lat").cast("string"), F.col("lon").cast("string"))
    bad = p.select("record_id", reasons.alias("why")).where(F.size("why") > 0)
    return [
        _issue(beside.where("reports = 0"), "missing_map_coverage_report", report),
        _issue(beside.where("reports > 0 and i != points"), "map_point_count_mismatch", at, F.concat_ws("|", F.col("i"), F.col("points"))),
        _issue(beside.where("reports > 0 and i + e != t"), "map_coverage_total_mismatch", report),
        _issue(bad, "invalid_coordinate_in_map", at, F.concat_ws("|", F.col("record_id").cast("string"), F.concat_ws(",", "why"))),
    ]


def file_issues(t: Tables, rules: SiteRules) -> list[DataFrame]:
    """Pages and data of every case, pages of the list, data that can't be parsed, and media among the stored files."""
    out = []
    if "files" in t and rules.expected_cases is not None:
        f, spark = t["files"], t["files"].sparkSession
        cases = spark.range(1, rules.expected_cases + 1).select(F.format_string(CASE_PAGE, "id").alias("page"), F.format_string(CASE_JSON, "id").alias("json"))
        lists = spark.range(1, -(-rules.expected_cases // LIST_LENGTH) + 1).select(F.format_string(LIST_PAGE, "id").alias("page"))
        out += [
            _issue(_without(cases, F.col("page"), f, "path"), "missing_case_page", F.col("page")),
            _issue(_without(cases, F.col("json"), f, "path"), "missing_case_json", F.col("json")),
            _issue(_without(lists, F.col("page"), f, "path"), "missing_pagination_page", F.col("page")),
        ]
        data = f.where(F.col("path").rlike(r"^cases/\d+/data\.json$")).join(cases.select("json"), F.col("path") == F.col("json"), "left_semi")
        out.append(_issue(data.where(F.try_parse_json(F.coalesce("content", F.lit(""))).isNull()), "invalid_case_json", F.col("path")))
    if "stored" in t:
        ending = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
        out.append(_issue(t["stored"].where(ending.isin(*MEDIA_ENDINGS)), "committed_media_binary", F.col("path")))
    return out


def _unescaped(text: Column) -> Column:
    """The character references that stand in links."""
    for name, char in (("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def page_links(files: DataFrame) -> DataFrame:
    """path (of the page), value (the link), kind (root, external, malformed, escapes or internal) and target of every link that counts."""
    links = files.where(F.lower("path").endswith(".html")).select("path", F.explode(F.regexp_extract_all(F.coalesce("content", F.lit("")), F.lit(LINK), F.lit(1))).alias("raw"))
    v = F.col("value")
    links = links.select("path", _unescaped(F.trim("raw")).alias("value")).where((v != "") & ~v.startswith("#"))
    way = F.regexp_extract("value", r"^([^?#]*)", 1)
    decoded = F.coalesce(F.try_url_decode(F.replace(way, F.lit("+"), F.lit("%2B"))), way)
    target = F.substring(resolve_link(F.concat(F.lit("/"), F.col("path")), decoded), 2, 1 << 30)
    kind = F.when(v.startswith("/") & ~v.startswith("//"), "root").when(external(v), F.when(valid_external(v), "external").otherwise("malformed")).when(target.isNull(), "escapes").otherwise("internal")
    found = links.withColumn("kind", kind).where((F.col("kind") != "internal") | (way != ""))
    return found.withColumn("target", F.when(F.col("kind") == "internal", F.when((target == "") | target.endswith("/"), F.concat(target, F.lit("index.html"))).otherwise(target)))


def link_issues(t: Tables) -> list[DataFrame]:
    links = page_links(t["files"])
    by_kind = F.create_map(*[F.lit(x) for x in ("root", "absolute_repository_root_path", "malformed", "invalid_external_url", "escapes", "internal_link_escapes_site")])
    told = links.where(F.col("kind").isin("root", "malformed", "escapes")).select(by_kind[F.col("kind")].alias("code"), "path", "value")
    # A folder stands for the page in it: its name, or that page, is enough.
    paths = t["files"].select("path")
    known = paths.unionByName(paths.where(F.col("path").endswith("/index.html")).select(F.regexp_replace("path", "/index[.]html$", "").alias("path")))
    broken = _without(links.where("kind = 'internal'"), F.col("target"), known, "path")
    return [told, _issue(broken, "broken_internal_link", F.col("path"), F.col("value"))]


def _parts(t: Tables, rules: SiteRules) -> dict[str, tuple[tuple[str, ...], Callable[[], list[DataFrame]]]]:
    """Each group of rules, with the tables that it needs."""
    return {
        "internal_links": (("files",), lambda: link_issues(t)),
        "files": ((), lambda: file_issues(t, rules)),
        "records": (("records",), lambda: record_issues(t, rules)),
        "map": (("points", "coverage"), lambda: map_issues(t)),
        "sources": (("sources",), lambda: source_issues(t, rules)),
        "relationships": (("relationships", "records", "sources"), lambda: relationship_issues(t)),
        "media": (("media",), lambda: media_issues(t)),
    }


def site_issues(t: Tables, rules: SiteRules) -> DataFrame:
    """severity, code, path and value of every issue of the tables that are given."""
    parts = [df for needs, make in _parts(t, rules).values() if all(n in t for n in needs) for df in make()]
    if not parts:
        raise ValueError("no table to validate")
    severity = F.create_map(*[F.lit(x) for pair in SEVERITIES.items() for x in pair])
    return reduce(DataFrame.unionByName, parts).select(severity[F.col("code")].alias("severity"), "code", "path", "value")


def checks(t: Tables, rules: SiteRules) -> dict[str, bool]:
    """Which groups of rules the given tables allow; a site isn't valid by what wasn't looked at."""
    able = {name: all(n in t for n in needs) for name, (needs, _) in _parts(t, rules).items()}
    return able | {"files": "stored" in t and "files" in t and rules.expected_cases is not None}


def site_verdict(t: Tables, rules: SiteRules) -> DataFrame:
    """critical, warning and info issues, unchecked groups, and passed: none is critical and every group was checked."""
    unchecked = sorted(name for name, able in checks(t, rules).items() if not able)
    cells = [F.count_if(F.col("severity") == s).alias(s) for s in ("critical", "warning", "info")]
    told = F.lit(",".join(unchecked)).alias("unchecked")
    return site_issues(t, rules).agg(*cells).select("*", told, ((F.col("critical") == 0) & F.lit(not unchecked)).alias("passed"))
