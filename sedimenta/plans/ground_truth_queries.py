"""The ground-truth audit, its equations, a release's gates and its acceptance, over an archive that is read into the order tables:
customers are its records, orders its references, parts its sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators import ground_truth
from sedimenta.plans.registry import query, table

_STATUSES = "REFERENCE_ONLY URL_PRESERVED METADATA_ONLY PARTIAL_TEXT FULL_TEXT_DIRECT FULL_TEXT_ARCHIVED FULL_TEXT_LOCAL_SNAPSHOT BLOCKED DEAD MALFORMED RESTRICTED NEEDS_MANUAL_REVIEW".split()

#: What Spark's SQL and DuckDB's both read.
_VIEWS = {
    "records": """SELECT c_custkey AS record_id, lpad(CAST(c_custkey AS STRING), 6, '0') AS page_id,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN 30 + (c_acctbal + 1000) / 1000 END AS latitude, CASE WHEN c_nationkey = 7 THEN 4239.00416 ELSE 33 + c_nationkey / 2.0 END AS longitude,
        c_nationkey = 0 AS direct_ok, CASE WHEN c_nationkey < 12 THEN 403 WHEN c_nationkey < 20 THEN 404 ELSE 500 END AS direct_status, CASE WHEN c_nationkey = 20 THEN 'circuit HTTP_403' ELSE 'none' END AS direct_error,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'historical_snapshot' WHEN c_mktsegment = 'FURNITURE' THEN 'mixed_historical_and_direct' ELSE 'direct' END AS origin_status, CASE WHEN c_acctbal >= 0 THEN c_name ELSE '' END AS description FROM customer""",
    "refs": """SELECT concat('r', CAST(o_orderkey AS STRING)) AS source_reference_id, o_custkey AS record_id, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_custkey END AS external_source_id,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'not a url' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE concat('http://h/', CAST(o_custkey AS STRING), '#', o_orderstatus) END AS raw_url,
        CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN '' ELSE concat('http://h/', CAST(o_custkey AS STRING)) END AS normalized_url, CASE WHEN o_orderpriority = '5-LOW' THEN 'malformed' ELSE 'ok' END AS url_status,
        o_orderstatus = 'P' AS duplicate_relationship, o_orderpriority = '5-LOW' AS malformed, o_orderpriority = '1-URGENT' AS manual_review, CASE o_orderstatus WHEN 'F' THEN 'historical' WHEN 'O' THEN 'provenance' ELSE 'embedded' END AS origin FROM orders""",
    "srcs": "SELECT p_partkey AS source_id, CASE "
    + " ".join(f"WHEN p_size % 12 = {i} THEN '{s}'" for i, s in enumerate(_STATUSES))
    + """ END AS content_status, CASE WHEN p_size < 20 THEN 'FETCHED' WHEN p_size < 30 THEN 'BLOCKED' WHEN p_size < 40 THEN 'DEAD' ELSE 'DISCOVERED' END AS reachability,
        CASE WHEN p_size > 25 THEN p_name ELSE ' ' END AS text, p_retailprice > 1000 AS full_text_passed, CASE WHEN p_size > 5 THEN p_type END AS content_hash, p_brand = 'Brand#11' AS needs_review, p_size > 10 AS checked FROM part""",
    "pages_of": """SELECT DISTINCT 'record' AS kind, lpad(CAST(o_custkey AS STRING), 6, '0') AS id FROM orders UNION ALL SELECT 'record', concat('s', CAST(s_suppkey AS STRING)) FROM supplier
        UNION ALL SELECT DISTINCT 'reference', concat('r', CAST(l_orderkey AS STRING)) FROM lineitem WHERE l_quantity < 45 UNION ALL SELECT DISTINCT 'source', CAST(l_partkey AS STRING) FROM lineitem WHERE l_quantity > 25""",
    "links_of": "SELECT n_nationkey * 10 AS checked, CASE WHEN n_regionkey = 1 THEN 1 ELSE 0 END AS broken, CASE WHEN n_regionkey = 2 THEN 1 ELSE 0 END AS escaped FROM nation",
}
_WITH = "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in _VIEWS.items())


def _archive(spark: SparkSession, sf_dir: str) -> ground_truth.Tables:
    names = "customer orders part supplier lineitem nation".split()
    frames = {n: table(spark, sf_dir, n) for n in names}
    read = {}
    for name, sql in _VIEWS.items():
        used = {n: frames[n] for n in names if f" {n}" in sql.replace("\n", " ")}
        for n in used:
            sql = sql.replace(f"FROM {n}", f"FROM {{{n}}}")
        read[name] = spark.sql(sql, **used)
    records = read["records"].select("*", F.array("direct_status").alias("direct_statuses"), F.array("direct_error").alias("direct_errors"))
    return {"records": records, "references": read["refs"], "sources": read["srcs"], "pages": read["pages_of"], "links": read["links_of"]}


_COORDINATES = "CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'missing' WHEN NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) THEN 'malformed' WHEN NOT (latitude BETWEEN 31 AND 38 AND longitude BETWEEN 34 AND 43) THEN 'outside_accepted_range' ELSE 'drawable' END"
_DIRECT = "CASE WHEN direct_ok THEN 'success' WHEN direct_status = 403 OR contains(lower(direct_error), 'http_403') THEN 'blocked_403' ELSE 'other_failure' END"
_CLASSED = f"{_WITH}, rec AS (SELECT *, {_COORDINATES} AS coordinates, {_DIRECT} AS direct FROM records)"
_SETS = """, sets AS (
    SELECT 'record' AS kind, CAST(page_id AS VARCHAR) AS id FROM records UNION SELECT 'reference', source_reference_id FROM refs UNION SELECT 'source', CAST(source_id AS VARCHAR) FROM srcs
), met AS (SELECT coalesce(s.kind, p.kind) AS kind, s.id IS NOT NULL AS w, p.id IS NOT NULL AS f FROM sets s FULL JOIN (SELECT DISTINCT kind, id FROM pages_of) p ON s.kind = p.kind AND s.id = p.id)"""


def _one(name: str, of: str, value: str) -> str:
    return f"SELECT '{name}' AS metric, CAST({value} AS BIGINT) AS result FROM {of}"


_METRIC_SQL = [
    _one("incident_records_total", "rec", "count(*)"),
    _one("incident_ids_unique", "rec", "count(DISTINCT record_id)"),
    _one("incident_ids_duplicate", "rec", "count(*) - count(DISTINCT record_id)"),
    _one("incident_pages_generated", "met", "count(*) FILTER (kind = 'record' AND w AND f)"),
    _one("incident_pages_missing", "met", "count(*) FILTER (kind = 'record' AND w AND NOT f)"),
    _one("incident_pages_orphaned", "met", "count(*) FILTER (kind = 'record' AND f AND NOT w)"),
    _one("source_reference_records_total", "refs", "count(*)"),
    _one("source_reference_ids_unique", "refs", "count(DISTINCT source_reference_id)"),
    _one("source_reference_ids_duplicate", "refs", "count(*) - count(DISTINCT source_reference_id)"),
    _one("source_reference_duplicate_relationships", "refs", "count(*) FILTER (duplicate_relationship)"),
    _one("source_reference_url_reuse_occurrences", "refs", "count(*) FILTER (raw_url <> '') - count(DISTINCT raw_url) FILTER (raw_url <> '')"),
    _one("source_reference_malformed_urls", "refs", "count(*) FILTER (malformed)"),
    _one("source_reference_manual_review", "refs", "count(*) FILTER (manual_review)"),
    _one("source_record_files_total", "srcs", "count(*)"),
    _one("source_record_ids_unique", "srcs", "count(DISTINCT source_id)"),
    _one("source_record_ids_duplicate", "srcs", "count(*) - count(DISTINCT source_id)"),
    _one("unique_raw_source_urls", "refs", "count(DISTINCT raw_url) FILTER (raw_url <> '')"),
    _one("unique_normalized_source_urls", "refs", "count(DISTINCT normalized_url) FILTER (normalized_url <> '' AND url_status <> 'malformed')"),
    _one("source_reference_pages_generated", "met", "count(*) FILTER (kind = 'reference' AND w AND f)"),
    _one("source_reference_pages_missing", "met", "count(*) FILTER (kind = 'reference' AND w AND NOT f)"),
    _one("source_reference_pages_orphaned", "met", "count(*) FILTER (kind = 'reference' AND f AND NOT w)"),
    _one("local_source_entity_pages_generated", "met", "count(*) FILTER (kind = 'source' AND w AND f)"),
    *[_one(f"sources_{s.lower()}", "srcs", f"count(*) FILTER (content_status = '{s}')") for s in ("FULL_TEXT_DIRECT", "FULL_TEXT_ARCHIVED", "FULL_TEXT_LOCAL_SNAPSHOT", "PARTIAL_TEXT", "METADATA_ONLY", "BLOCKED", "DEAD", "MALFORMED")],
    _one("sources_link_only", "srcs", "count(*) FILTER (content_status IN ('URL_PRESERVED', 'REFERENCE_ONLY'))"),
    _one("sources_duplicate_content", "(SELECT count(*) AS n FROM srcs WHERE content_hash IS NOT NULL GROUP BY content_hash HAVING count(*) > 1)", "coalesce(sum(n), 0)"),
    _one("sources_requires_manual_review", "srcs", "count(*) FILTER (needs_review OR content_status IN ('MALFORMED', 'NEEDS_MANUAL_REVIEW'))"),
    _one("incidents_with_valid_coordinates", "rec", "count(*) FILTER (coordinates = 'drawable')"),
    _one("incidents_without_coordinates", "rec", "count(*) FILTER (coordinates = 'missing')"),
    _one("incidents_with_malformed_coordinates", "rec", "count(*) FILTER (coordinates = 'malformed')"),
    _one("incidents_outside_coordinate_range", "rec", "count(*) FILTER (coordinates = 'outside_accepted_range')"),
    _one("direct_fetch_success", "rec", "count(*) FILTER (direct = 'success')"),
    _one("direct_fetch_blocked_403", "rec", "count(*) FILTER (direct = 'blocked_403')"),
    _one("direct_fetch_other_failure", "rec", "count(*) FILTER (direct = 'other_failure')"),
    _one("historical_or_local_text_records", "rec", "count(*) FILTER (description <> '' AND origin_status LIKE '%historical%')"),
    _one("records_without_usable_incident_text", "rec", "count(*) FILTER (description = '')"),
    _one("internal_links_checked", "links_of", "sum(checked)"),
    _one("internal_links_broken", "links_of", "sum(broken)"),
    _one("external_links_discovered", "refs", "count(DISTINCT raw_url) FILTER (raw_url <> '')"),
    _one("external_links_checked", "srcs", "count(*) FILTER (checked)"),
    _one("external_links_reachable", "srcs", "count(*) FILTER (checked AND reachability = 'FETCHED')"),
    _one("external_links_blocked", "srcs", "count(*) FILTER (checked AND reachability = 'BLOCKED')"),
    _one("external_links_dead", "srcs", "count(*) FILTER (checked AND reachability = 'DEAD')"),
    _one("external_links_not_checked", "srcs", "count(*) FILTER (NOT checked)"),
]


@query(f"{_CLASSED}{_SETS} {' UNION ALL '.join(_METRIC_SQL)}")
def ground_truth_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ground_truth.ground_truth(_archive(spark, sf_dir)).select("metric", "result")


@query(f"""
    {_CLASSED}, e AS (
        SELECT 'source_entity_primary_status_reconciliation' AS equation, count(*) AS total, (SELECT sum(n) FROM (SELECT count(*) AS n FROM srcs WHERE content_status IS NOT NULL GROUP BY content_status)) AS terms FROM srcs
        UNION ALL SELECT 'coordinate_reconciliation', count(*), (SELECT sum(n) FROM (SELECT count(*) AS n FROM rec GROUP BY coordinates)) FROM rec
        UNION ALL SELECT 'direct_attempt_reconciliation', count(*), (SELECT sum(n) FROM (SELECT count(*) AS n FROM rec GROUP BY direct)) FROM rec
        UNION ALL SELECT 'source_reference_origin_reconciliation', count(*), (SELECT sum(n) FROM (SELECT count(*) AS n FROM refs GROUP BY origin)) FROM refs
    ) SELECT equation, total, CAST(terms AS BIGINT) AS terms, total = terms AS balanced FROM e
""")
def audit_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ground_truth.equations(_archive(spark, sf_dir))


def _release(spark: SparkSession, sf_dir: str) -> ground_truth.Tables:
    """The archive with a release that lacks a little of everything: index and exports are of what lies beside it."""
    t = _archive(spark, sf_dir)
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    count = lambda df, name: df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
    records, references, sources = t["records"], t["references"], t["sources"]
    t["index"] = records.where("latitude is not null").select(F.lit("record").alias("kind"), F.col("record_id").alias("id")).unionByName(sources.select(F.lit("source").alias("kind"), F.col("source_id").alias("id")))
    t["points"] = records.where("latitude between 31 and 38 and longitude between 34 and 40").select("record_id")
    t["exports"] = references.where("origin != 'embedded'").select(F.lit("raw").alias("kind"), F.col("raw_url").alias("url")).unionByName(references.select(F.lit("normalized").alias("kind"), F.col("normalized_url").alias("url")).where("url != ''"))
    t["manifest"] = count(references, "source_reference_records").unionByName(count(sources.where("checked"), "source_entities"))
    t["report"] = count(records, "incident_records_total").unionByName(count(references, "source_reference_records_total"))
    logged = F.concat(F.when(F.col("event_type") == "error", "{").otherwise(""), "props")  # a brace too many
    t["damaged"] = table(spark, sf_dir, "events").where(F.json_object_keys(logged).isNull())
    t["layout"], t["assets"] = names("data", "site", "reports", "logs"), names("map_script", "url_wrapping")
    t["search_fields"], t["search_filters"] = names("date", "location", "victim", "actor"), names("date", "coordinates", "source_status", "search_text")
    return t


def _differ(a: str, b: str) -> str:
    return f"(SELECT count(*) FROM (({a} EXCEPT {b}) UNION ALL ({b} EXCEPT {a})))"


_GATE_SQL = {
    "missing_release_artifacts": "1",
    "missing_build_manifest": "0",
    "missing_source_reference_index": "0",
    "incident_missing_separate_origin_fields": "0",
    "incident_file_count_mismatch": "(SELECT abs(count(*) - 150) FROM rec)",
    "incident_ids_not_unique": "0",
    "incident_page_set_mismatch": "(SELECT count(*) FROM met WHERE kind = 'record' AND w <> f)",
    "source_reference_count_mismatch": "0",
    "source_reference_ids_not_unique": "0",
    "source_reference_page_set_mismatch": "(SELECT count(*) FROM met WHERE kind = 'reference' AND w <> f)",
    "source_entity_count_mismatch": "(SELECT count(*) FROM srcs WHERE NOT checked)",
    "source_ids_not_unique": "0",
    "source_page_set_mismatch": "(SELECT count(*) FROM met WHERE kind = 'source' AND w <> f)",
    "reference_to_missing_incident": "(SELECT count(*) FROM refs WHERE record_id NOT IN (SELECT record_id FROM rec))",
    "reference_to_missing_source_entity": "(SELECT count(*) FROM refs WHERE external_source_id IS NOT NULL AND external_source_id NOT IN (SELECT source_id FROM srcs))",
    "raw_url_export_mismatch": _differ("SELECT raw_url FROM refs WHERE raw_url <> ''", "SELECT raw_url FROM refs WHERE origin <> 'embedded'"),
    "normalized_url_export_mismatch": "0",
    "direct_fetch_success_not_zero": "(SELECT count(*) FROM rec WHERE direct = 'success')",
    "http_403_reconciliation_failed": "(SELECT count(*) FROM rec WHERE direct <> 'blocked_403')",
    "empty_source_counted_full": "(SELECT count(*) FROM srcs WHERE content_status LIKE 'FULL_TEXT%' AND trim(text) = '')",
    "unvalidated_source_counted_full": "(SELECT count(*) FROM srcs WHERE content_status LIKE 'FULL_TEXT%' AND NOT full_text_passed)",
    "metadata_source_counted_full": "(SELECT count(*) FROM srcs WHERE content_status = 'METADATA_ONLY' AND full_text_passed)",
    "source_status_reconciliation_failed": "0",
    "coordinate_reconciliation_failed": "0",
    "utf8_or_json_errors": "(SELECT count(*) FROM events WHERE NOT json_valid(CASE event_type WHEN 'error' THEN '{' ELSE '' END || props))",
    "search_document_count_mismatch": "(SELECT count(*) FROM rec WHERE latitude IS NULL)",
    "search_fields_missing": "8",
    "search_filters_not_implemented": "0",
    "map_point_count_mismatch": "(SELECT count(*) FROM rec WHERE coordinates = 'drawable' AND longitude > 40)",
    "map_assets_missing": "1",
    "long_url_layout_protection_missing": "0",
    "internal_links_broken": "(SELECT sum(broken) + sum(escaped) FROM links_of)",
    "ground_truth_report_missing": "0",
    "ground_truth_release_mismatch": "4",
}
_GATES = f"{_CLASSED}{_SETS}, g AS (" + " UNION ALL ".join(f"SELECT '{name}' AS gate, CAST({sql} AS BIGINT) AS found" for name, sql in _GATE_SQL.items()) + ")"


@query(f"{_GATES} SELECT gate, found, found = 0 AS ok FROM g")
def release_gate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ground_truth.release_gates(_release(spark, sf_dir), 150)


_CRITERIA_SQL = {
    "canonical_counters_recomputed": "'ground_truth_report_missing', 'ground_truth_release_mismatch'",
    "count_differences_explained": "'source_reference_count_mismatch', 'source_entity_count_mismatch'",
    "every_canonical_incident_represented": "'incident_file_count_mismatch', 'incident_ids_not_unique'",
    "every_incident_has_one_page": "'incident_page_set_mismatch'",
    "every_source_reference_represented": "'source_reference_page_set_mismatch', 'source_reference_ids_not_unique'",
    "every_source_entity_has_page": "'source_page_set_mismatch', 'source_ids_not_unique'",
    "every_raw_reference_url_exported": "'raw_url_export_mismatch'",
    "every_normalized_reference_url_exported": "'normalized_url_export_mismatch'",
    "source_relationships_complete": "'reference_to_missing_incident', 'reference_to_missing_source_entity'",
    "http_403_never_counted_success": "'direct_fetch_success_not_zero', 'http_403_reconciliation_failed'",
    "metadata_never_counted_full": "'metadata_source_counted_full'",
    "empty_source_never_counted_archived": "'empty_source_counted_full'",
    "unvalidated_source_never_counted_full": "'unvalidated_source_counted_full'",
    "search_index_and_filters_present": "'search_document_count_mismatch', 'search_fields_missing', 'search_filters_not_implemented'",
    "map_every_drawable_point": "'map_point_count_mismatch'",
    "map_exclusions_explicit": "'coordinate_reconciliation_failed'",
    "zero_broken_internal_links": "'internal_links_broken'",
    "release_has_independent_local_assets": "'map_assets_missing', 'long_url_layout_protection_missing'",
    "release_has_complete_layout": "'missing_release_artifacts', 'missing_build_manifest'",
    "generic_engine_separated_from_connector": "'incident_missing_separate_origin_fields'",
}


@query(f"{_GATES} " + " UNION ALL ".join(f"SELECT '{name}' AS criterion, (SELECT bool_and(found = 0) FROM g WHERE gate IN ({gates})) AS passed" for name, gates in _CRITERIA_SQL.items()) + " UNION ALL SELECT 'validation_has_no_blocking_failures', bool_and(found = 0) FROM g")
def release_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ground_truth.acceptance_matrix(ground_truth.release_gates(_release(spark, sf_dir), 150))
