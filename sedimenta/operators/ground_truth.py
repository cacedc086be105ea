"""The ground-truth audit of an archive: every metric with its definition, equations that must balance, the gates of a release
and the criteria of its acceptance.

Tables come as a dictionary. Those of the archive are

    records      record_id, page_id, latitude, longitude, direct_ok, direct_statuses (array), direct_errors (array), origin_status, description
    references   source_reference_id, record_id, external_source_id, raw_url, normalized_url, url_status, duplicate_relationship, malformed, manual_review, origin
    sources      source_id, content_status, reachability, text, full_text_passed, content_hash, needs_review, checked
    pages        kind (record, reference or source), id
    links        checked, broken, escaped (one row)

and of a release in addition index (id, kind), points (record_id), exports (kind, url), manifest and report (name, n), layout, assets,
search_fields and search_filters (name). Each table is read once for its counts; only counts meet in one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import fixed
from sedimenta.functions.values import case, contains_any, is_missing
from sedimenta.operators.classify import coordinate_class

Tables = dict[str, DataFrame]

#: What a metric counts, by table: name, definition and how it is counted. Names are fixed values.
RECORDS, REFERENCES, SOURCES, PAGES, LINKS = "records", "references", "sources", "pages", "links"
FULL_TEXT = ("FULL_TEXT_DIRECT", "FULL_TEXT_ARCHIVED", "FULL_TEXT_LOCAL_SNAPSHOT")
LAYOUT = ("data", "site", "reports", "logs", "exports")
SEARCH_FIELDS = (
    "incident identifier",
    "date",
    "location",
    "narrative",
    "victim",
    "source domain",
    "source title",
    "original URL",
    "record code",
    "actor",
    "allegation",
    "source preservation status",
)
SEARCH_FILTERS = ("source_status", "coordinates", "date", "search_text")


def _count() -> Column:
    return F.count(F.lit(1))


def _present(c: str) -> Column:
    return F.when(~is_missing(c), F.col(c))


def direct_class() -> Column:
    """success, blocked_403 or other_failure of a record's direct attempts; copies in archives don't count."""
    errors = F.lower(F.array_join(F.coalesce("direct_errors", F.array().cast("array<string>")), " "))
    blocked = F.array_contains(F.coalesce("direct_statuses", F.array().cast("array<int>")), 403) | contains_any(errors, ["http_403"])
    return case((F.coalesce("direct_ok", F.lit(False)), "success"), (blocked, "blocked_403"), otherwise="other_failure")


def _of(table: str, status: str) -> tuple[str, Column]:
    return table, F.count_if(F.col("content_status") == status)


def _metrics() -> list[tuple[str, str, str, Column]]:
    """metric, table, definition and aggregate."""
    where = lambda c, v: F.count_if(F.col(c) == v)
    true = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    distinct = lambda c: F.count_distinct(F.col(c))
    repeats = lambda c: F.count(c) - F.count_distinct(c)
    good = F.when((F.col("url_status") != "malformed") & ~is_missing("normalized_url"), F.col("normalized_url"))
    checked = F.coalesce(F.col("checked"), F.lit(False))
    has_description = ~is_missing("description")
    rows = [
        ("incident_records_total", RECORDS, "records of the archive", _count()),
        ("incident_ids_unique", RECORDS, "different record ids", distinct("record_id")),
        ("incident_ids_duplicate", RECORDS, "records beyond the first of their id", repeats("record_id")),
        ("source_reference_records_total", REFERENCES, "every occurrence of a source in a record, repeats included", _count()),
        ("source_reference_ids_unique", REFERENCES, "different reference ids", distinct("source_reference_id")),
        ("source_reference_ids_duplicate", REFERENCES, "references beyond the first of their id", repeats("source_reference_id")),
        ("source_reference_duplicate_relationships", REFERENCES, "references that repeat a record's raw URL", true("duplicate_relationship")),
        ("source_reference_url_reuse_occurrences", REFERENCES, "references beyond the first of their raw URL", F.count(_present("raw_url")) - F.count_distinct(_present("raw_url"))),
        ("source_reference_malformed_urls", REFERENCES, "references whose raw URL is no HTTP URL", true("malformed")),
        ("source_reference_manual_review", REFERENCES, "references that need a look", true("manual_review")),
        ("unique_raw_source_urls", REFERENCES, "different raw URLs", F.count_distinct(_present("raw_url"))),
        ("unique_normalized_source_urls", REFERENCES, "different URLs that could be normalised", F.count_distinct(good)),
        ("external_links_discovered", REFERENCES, "different raw URLs that references name", F.count_distinct(_present("raw_url"))),
        ("source_record_files_total", SOURCES, "source records that are stored", _count()),
        ("source_record_ids_unique", SOURCES, "different source ids", distinct("source_id")),
        ("source_record_ids_duplicate", SOURCES, "source records beyond the first of their id", repeats("source_id")),
        ("sources_full_text_direct", *_described("sources with a whole text, fetched directly", *_of(SOURCES, "FULL_TEXT_DIRECT"))),
        ("sources_full_text_archived", *_described("sources with a whole text from an archive", *_of(SOURCES, "FULL_TEXT_ARCHIVED"))),
        ("sources_full_text_local_snapshot", *_described("sources with a whole text from a local copy only", *_of(SOURCES, "FULL_TEXT_LOCAL_SNAPSHOT"))),
        ("sources_partial_text", *_described("sources whose text isn't known to be whole", *_of(SOURCES, "PARTIAL_TEXT"))),
        ("sources_metadata_only", *_described("sources with metadata and no text", *_of(SOURCES, "METADATA_ONLY"))),
        ("sources_link_only", SOURCES, "sources with a URL and nothing else", F.count_if(F.col("content_status").isin("URL_PRESERVED", "REFERENCE_ONLY"))),
        ("sources_blocked", *_described("sources without a text that were refused", *_of(SOURCES, "BLOCKED"))),
        ("sources_dead", *_described("sources without a text that are gone", *_of(SOURCES, "DEAD"))),
        ("sources_malformed", *_described("sources without a text whose URL is none", *_of(SOURCES, "MALFORMED"))),
        ("sources_requires_manual_review", SOURCES, "sources with review flags, or malformed, or for review", F.count_if(F.coalesce(F.col("needs_review"), F.lit(False)) | F.col("content_status").isin("MALFORMED", "NEEDS_MANUAL_REVIEW"))),
        ("incidents_with_valid_coordinates", RECORDS, "records that can be drawn on the map", where("_coordinates", "drawable")),
        ("incidents_without_coordinates", RECORDS, "records without latitude or longitude", where("_coordinates", "missing")),
        ("incidents_with_malformed_coordinates", RECORDS, "records whose coordinates are no place on earth", where("_coordinates", "malformed")),
        ("incidents_outside_coordinate_range", RECORDS, "records outside the accepted range", where("_coordinates", "outside_accepted_range")),
        ("direct_fetch_success", RECORDS, "records whose direct fetch succeeded", where("_direct", "success")),
        ("direct_fetch_blocked_403", RECORDS, "records whose direct fetch was answered 403", where("_direct", "blocked_403")),
        ("direct_fetch_other_failure", RECORDS, "records whose direct fetch failed otherwise", where("_direct", "other_failure")),
        ("historical_or_local_text_records", RECORDS, "records with a description of historical origin", F.count_if(has_description & F.contains(F.coalesce("origin_status", F.lit("")), F.lit("historical")))),
        ("records_without_usable_incident_text", RECORDS, "records without a description", F.count_if(~has_description)),
        ("internal_links_checked", LINKS, "internal links that were followed", F.coalesce(F.sum("checked"), F.lit(0))),
        ("internal_links_broken", LINKS, "internal links that lead nowhere", F.coalesce(F.sum("broken"), F.lit(0))),
        ("external_links_checked", SOURCES, "sources with an attempt", F.count_if(checked)),
        ("external_links_reachable", SOURCES, "checked sources that were fetched", F.count_if(checked & (F.col("reachability") == "FETCHED"))),
        ("external_links_blocked", SOURCES, "checked sources that were refused", F.count_if(checked & (F.col("reachability") == "BLOCKED"))),
        ("external_links_dead", SOURCES, "checked sources that are gone", F.count_if(checked & (F.col("reachability") == "DEAD"))),
        ("external_links_not_checked", SOURCES, "sources without an attempt", F.count_if(~checked)),
    ]
    return rows


def _described(definition: str, table: str, cell: Column) -> tuple[str, str, Column]:
    return table, definition, cell


#: Counts of two sets of ids: kind of page, table and key, and the metrics of both, of the table only, of the pages only.
PAGE_SETS = (
    ("record", RECORDS, "page_id", "incident_pages_generated", "incident_pages_missing", "incident_pages_orphaned"),
    ("reference", REFERENCES, "source_reference_id", "source_reference_pages_generated", "source_reference_pages_missing", "source_reference_pages_orphaned"),
    ("source", SOURCES, "source_id", "local_source_entity_pages_generated", None, None),
)


def classified(records: DataFrame) -> DataFrame:
    return records.withColumn("_coordinates", coordinate_class("latitude", "longitude")).withColumn("_direct", direct_class())


def page_sets(t: Tables, kind: str, table: str, key: str) -> DataFrame:
    """both, missing and orphaned: ids of the table and of its pages, of the table only, of the pages only."""
    wanted = t[table].select(F.col(key).cast("string").alias("id")).distinct().withColumn("_w", F.lit(True))
    found = t[PAGES].where(F.col("kind") == kind).select(F.col("id").cast("string").alias("id")).distinct().withColumn("_f", F.lit(True))
    both = wanted.join(found, "id", "full_outer")
    w, f = F.col("_w").isNotNull(), F.col("_f").isNotNull()
    return both.agg(F.count_if(w & f).alias("both"), F.count_if(w & ~f).alias("missing"), F.count_if(~w & f).alias("orphaned"))


def ground_truth(t: Tables, claims: dict[str, str] | None = None) -> DataFrame:
    """metric, old_claim, definition, input, method and result of each of the audit's 50 metrics."""
    claims, found, tables = claims or {}, [], t | {RECORDS: classified(t[RECORDS])}
    by_table: dict[str, list[tuple]] = {}
    for row in _metrics():
        by_table.setdefault(row[1], []).append(row)

    def rows_of(wide: DataFrame, described: list[tuple[str, str, str, str, str]]) -> DataFrame:
        cell = lambda name, definition, table, method, column: F.struct(F.lit(name).alias("metric"), F.lit(claims.get(name)).cast("string").alias("old_claim"), F.lit(definition).alias("definition"), F.lit(table).alias("input"), F.lit(method).alias("method"), F.col(column).cast("bigint").alias("result"))
        return wide.select(F.explode(F.array(*[cell(*d) for d in described])).alias("m")).select("m.*")

    for name, rows in by_table.items():
        wide = tables[name].agg(*[cell.alias(metric) for metric, _, _, cell in rows])
        found.append(rows_of(wide, [(metric, definition, name, "count over the table", metric) for metric, _, definition, _ in rows]))
    for kind, name, key, both, missing, orphaned in PAGE_SETS:
        described = [(both, f"ids of {name} with a page", f"{name}, pages", "ids in both sets", "both")]
        described += [(missing, f"ids of {name} without a page", f"{name}, pages", "ids less pages", "missing")] if missing else []
        described += [(orphaned, f"pages of no id of {name}", f"{name}, pages", "pages less ids", "orphaned")] if orphaned else []
        found.append(rows_of(page_sets(t, kind, name, key), described))
    hashes = t[SOURCES].where(~is_missing("content_hash")).groupBy("content_hash").agg(_count().alias("n")).where("n > 1")
    shared = hashes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    found.append(rows_of(shared, [("sources_duplicate_content", "sources whose content another source has as well", SOURCES, "rows in groups of a content hash", "n")]))
    return reduce(DataFrame.unionByName, found)


def equations(t: Tables) -> DataFrame:
    """equation, total, terms (the sum over categories) and balanced. A row of no known category tips the balance."""
    records = classified(t[RECORDS])
    parts = [
        ("source_entity_primary_status_reconciliation", t[SOURCES], F.col("content_status"), fixed.SOURCE_STATUSES),
        ("coordinate_reconciliation", records, F.col("_coordinates"), ["drawable", "missing", "malformed", "outside_accepted_range"]),
        ("direct_attempt_reconciliation", records, F.col("_direct"), ["success", "blocked_403", "other_failure"]),
        ("source_reference_origin_reconciliation", t[REFERENCES], F.col("origin"), ["historical", "provenance", "embedded"]),
    ]
    rows = [df.agg(F.lit(name).alias("equation"), _count().alias("total"), F.count_if(F.coalesce(c.isin(*domain), F.lit(False))).alias("terms")) for name, df, c, domain in parts]
    return reduce(DataFrame.unionByName, rows).withColumn("balanced", F.col("total") == F.col("terms"))


def _facts(df: DataFrame, **cells: Column) -> DataFrame:
    """Aggregates of a table in one pass, as rows of name and n."""
    wide = df.agg(*[c.cast("bigint").alias(name) for name, c in cells.items()])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("n")) for name in cells])))


def _met(**sides: tuple[DataFrame, Column]) -> DataFrame:
    """value and how often each side has it: equal values of all sides meet once. A value is compared as text."""
    n = lambda side: [F.lit(int(side == s)).cast("bigint").alias(s) for s in sides]
    rows = reduce(DataFrame.unionByName, [df.select(c.cast("string").alias("value"), *n(side)) for side, (df, c) in sides.items()])
    return rows.groupBy("value").agg(*[F.sum(s).alias(s) for s in sides])


def _differ(a: str, b: str) -> Column:
    """How many values only one of the two sides has; a null equals none."""
    x, y = (F.col(c) > 0 for c in (a, b))
    return F.coalesce(F.sum(F.when(F.col("value").isNull(), x.cast("int") + y.cast("int")).otherwise((x != y).cast("int"))), F.lit(0))


def _not_alone(side: str) -> Column:
    """Rows of a side beyond the first of their value, and all without one."""
    return F.coalesce(F.sum(F.when(F.col(side) > 0, F.when(is_missing("value"), F.col(side)).otherwise(F.col(side) - 1))), F.lit(0))


def _dangling(children: str, parents: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("value").isNull() | (F.col(parents) == 0), F.col(children))), F.lit(0))


def release_gates(t: Tables, expected_records: int) -> DataFrame:
    """gate, found and ok of each of a release's gates; found counts what breaks it.

    Each table is counted in one pass, and the values of a kind (ids, pages, URLs) meet once for all gates that need them.
    """
    records, references, sources = classified(t[RECORDS]), t[REFERENCES], t[SOURCES]
    pages = lambda kind: (t[PAGES].where(F.col("kind") == kind), F.col("id"))
    exported = lambda kind: (t["exports"].where(F.col("kind") == kind), F.col("url"))
    full, passed = F.col("content_status").isin(*FULL_TEXT), F.coalesce("full_text_passed", F.lit(False))
    raw = references.where(~is_missing("raw_url"))
    normalized = references.where(~is_missing("normalized_url") & (F.col("url_status") != "malformed"))
    wanted = records.select(F.concat(F.lit("record:"), F.col("record_id").cast("string")).alias("v")).unionByName(sources.select(F.concat(F.lit("source:"), F.col("source_id").cast("string")).alias("v")))
    truth = {
        "incident_records_total": "records",
        "source_reference_records_total": "references",
        "source_record_files_total": "sources",
        "incident_pages_generated": "record_pages",
        "source_reference_pages_generated": "reference_pages",
        "local_source_entity_pages_generated": "source_pages",
    }
    said = lambda name: F.coalesce(F.max(F.when(F.col("name") == name, F.col("n"))), F.lit(-1))
    listed = {"layout": LAYOUT, "search_fields": SEARCH_FIELDS, "search_filters": SEARCH_FILTERS, "assets": ("map_script", "map_page", "url_wrapping")}
    by_record = _met(own=(records, F.col("record_id")), reference=(references, F.col("record_id")), drawable=(records.where("_coordinates = 'drawable'"), F.col("record_id")), point=(t["points"], F.col("record_id")))
    by_source = _met(own=(sources, F.col("source_id")), page=pages("source"), reference=(references.where(~is_missing("external_source_id")), F.col("external_source_id")))
    by_reference = _met(own=(references, F.col("source_reference_id")), page=pages("reference"))
    by_page = _met(own=(records, F.col("page_id")), page=pages("record"))
    total = lambda side: F.coalesce(F.sum(side), F.lit(0))
    facts = [
        _facts(
            records,
            records=_count(),
            no_origin=F.count_if(F.col("direct_ok").isNull() | F.col("origin_status").isNull()),
            direct_success=F.count_if(F.col("_direct") == "success"),
            not_blocked=F.count_if(F.col("_direct") != "blocked_403"),
            no_class=F.count_if(F.col("_coordinates").isNull()),
        ),
        _facts(references, references=_count()),
        _facts(
            sources,
            sources=_count(),
            empty_full=F.count_if(full & (F.trim(F.coalesce("text", F.lit(""))) == "")),
            unvalidated_full=F.count_if(full & ~passed),
            metadata_full=F.count_if((F.col("content_status") == "METADATA_ONLY") & passed),
            no_status=F.count_if(~F.coalesce(F.col("content_status").isin(*fixed.SOURCE_STATUSES), F.lit(False))),
        ),
        _facts(by_record, record_repeats=_not_alone("own"), no_record=_dangling("reference", "own"), points=_differ("point", "drawable")),
        _facts(by_source, source_repeats=_not_alone("own"), no_source=_dangling("reference", "own"), source_sets=_differ("own", "page"), source_pages=total("page")),
        _facts(by_reference, reference_repeats=_not_alone("own"), reference_sets=_differ("own", "page"), reference_pages=total("page")),
        _facts(by_page, record_sets=_differ("own", "page"), record_pages=total("page")),
        _facts(_met(own=(raw, F.col("raw_url")), export=exported("raw")), raw_urls=_differ("own", "export")),
        _facts(_met(own=(normalized, F.col("normalized_url")), export=exported("normalized")), normalized_urls=_differ("own", "export")),
        _facts(_met(own=(wanted, F.col("v")), index=(t["index"], F.concat_ws(":", "kind", F.col("id").cast("string")))), index=_differ("own", "index")),
        _facts(t[LINKS], links=F.coalesce(F.sum(F.col("broken") + F.col("escaped")), F.lit(0))),
        _facts(t["manifest"], manifest=_count(), said_references=said("source_reference_records"), said_sources=said("source_entities")),
        _facts(t["report"], report=_count(), **{f"said_{name}": said(name) for name in truth}),
        *[_facts(t[table], **{f"{table}_{name}": F.count_if(F.col("name") == name) for name in names}) for table, names in listed.items()],
    ]
    if "damaged" in t:
        facts.append(_facts(t["damaged"], damaged=_count()))
    of = lambda name: F.max(F.when(F.col("name") == name, F.col("n")))
    differs = lambda a, b: F.abs(a - b)
    none = lambda name: (of(name) == 0).cast("int")
    lacking = lambda table, names: sum((none(f"{table}_{name}") for name in names), F.lit(0))
    gates = {
        "missing_release_artifacts": lacking("layout", LAYOUT),
        "missing_build_manifest": none("manifest"),
        "missing_source_reference_index": none("references"),
        "incident_missing_separate_origin_fields": of("no_origin"),
        "incident_file_count_mismatch": differs(of("records"), F.lit(expected_records)),
        "incident_ids_not_unique": of("record_repeats"),
        "incident_page_set_mismatch": of("record_sets"),
        "source_reference_count_mismatch": differs(of("references"), of("said_references")),
        "source_reference_ids_not_unique": of("reference_repeats"),
        "source_reference_page_set_mismatch": of("reference_sets"),
        "source_entity_count_mismatch": differs(of("sources"), of("said_sources")),
        "source_ids_not_unique": of("source_repeats"),
        "source_page_set_mismatch": of("source_sets"),
        "reference_to_missing_incident": of("no_record"),
        "reference_to_missing_source_entity": of("no_source"),
        "raw_url_export_mismatch": of("raw_urls"),
        "normalized_url_export_mismatch": of("normalized_urls"),
        "direct_fetch_success_not_zero": of("direct_success"),
        "http_403_reconciliation_failed": of("not_blocked"),
        "empty_source_counted_full": of("empty_full"),
        "unvalidated_source_counted_full": of("unvalidated_full"),
        "metadata_source_counted_full": of("metadata_full"),
        "source_status_reconciliation_failed": of("no_status"),
        "coordinate_reconciliation_failed": of("no_class"),
        "utf8_or_json_errors": of("damaged") if "damaged" in t else F.lit(1),
        "search_document_count_mismatch": of("index"),
        "search_fields_missing": lacking("search_fields", SEARCH_FIELDS),
        "search_filters_not_implemented": lacking("search_filters", SEARCH_FILTERS),
        "map_point_count_mismatch": of("points"),
        "map_assets_missing": lacking("assets", ("map_script", "map_page")),
        "long_url_layout_protection_missing": lacking("assets", ("url_wrapping",)),
        "internal_links_broken": of("links"),
        "ground_truth_report_missing": none("report"),
        "ground_truth_release_mismatch": sum(((of(fact) != of(f"said_{name}")).cast("int") for name, fact in truth.items()), F.lit(0)),
    }
    found = _facts(reduce(DataFrame.unionByName, facts), **gates).toDF("gate", "found")
    return found.withColumn("ok", F.col("found") == 0)


#: The criteria of acceptance, each with the gates that must hold; none stands for all of them.
CRITERIA: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("canonical_counters_recomputed", ("ground_truth_report_missing", "ground_truth_release_mismatch")),
    ("count_differences_explained", ("source_reference_count_mismatch", "source_entity_count_mismatch")),
    ("every_canonical_incident_represented", ("incident_file_count_mismatch", "incident_ids_not_unique")),
    ("every_incident_has_one_page", ("incident_page_set_mismatch",)),
    ("every_source_reference_represented", ("source_reference_page_set_mismatch", "source_reference_ids_not_unique")),
    ("every_source_entity_has_page", ("source_page_set_mismatch", "source_ids_not_unique")),
    ("every_raw_reference_url_exported", ("raw_url_export_mismatch",)),
    ("every_normalized_reference_url_exported", ("normalized_url_export_mismatch",)),
    ("source_relationships_complete", ("reference_to_missing_incident", "reference_to_missing_source_entity")),
    ("http_403_never_counted_success", ("direct_fetch_success_not_zero", "http_403_reconciliation_failed")),
    ("metadata_never_counted_full", ("metadata_source_counted_full",)),
    ("empty_source_never_counted_archived", ("empty_source_counted_full",)),
    ("unvalidated_source_never_counted_full", ("unvalidated_source_counted_full",)),
    ("search_index_and_filters_present", ("search_document_count_mismatch", "search_fields_missing", "search_filters_not_implemented")),
    ("map_every_drawable_point", ("map_point_count_mismatch",)),
    ("map_exclusions_explicit", ("coordinate_reconciliation_failed",)),
    ("zero_broken_internal_links", ("internal_links_broken",)),
    ("release_has_independent_local_assets", ("map_assets_missing", "long_url_layout_protection_missing")),
    ("release_has_complete_layout", ("missing_release_artifacts", "missing_build_manifest")),
    ("generic_engine_separated_from_connector", ("incident_missing_separate_origin_fields",)),
    ("validation_has_no_blocking_failures", ()),
)


def acceptance_matrix(gates: DataFrame) -> DataFrame:
    """criterion and passed, from the gates' outcomes, which are computed once. A gate that isn't there doesn't hold."""
    needed = sorted({g for _, own in CRITERIA for g in own})
    holds = [F.coalesce(F.bool_and(F.when(F.col("gate") == g, F.coalesce("ok", F.lit(False)))), F.lit(False)).alias(g) for g in needed]
    wide = gates.agg(F.bool_and("ok").alias("_all"), *holds)
    passed = lambda own: reduce(Column.__and__, [F.col(g) for g in own]) if own else F.col("_all")
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("criterion"), passed(own).alias("passed")) for c, own in CRITERIA])))
