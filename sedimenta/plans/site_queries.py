"""A site made from documents and pages, with the faults that they bring, under the whole validator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import files
from sedimenta.operators import site_audit
from sedimenta.plans.registry import heavy, query, table
from sedimenta.streaming import runs
from sedimenta.streaming.replay import BrokenOff

_RULES = site_audit.SiteRules("2", "p1", required_fields=("record_id", "lang", "source"), provenance_fields=("lang", "source"), statuses=("successful", "blocked"))


@query(r"""
    WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(length(text), 0) AS n, coalesce(text, '') AS text, sha256(coalesce(text, '')) AS h FROM documents),
      r AS (SELECT *, 'data/incidents/' || id || '.json' AS path, CASE WHEN lang = 'en' THEN '2' ELSE '1' END AS schema_version, CASE WHEN n > 2000 THEN 'ftp://x/' ELSE 'https://x/' END || id AS url FROM d),
      rel AS (SELECT id AS a, id AS b FROM d WHERE n > 300 UNION ALL SELECT 'none', id FROM d WHERE n > 3000 UNION ALL SELECT id, id FROM d WHERE n > 4000),
      i AS (
        SELECT 'unexpected_schema_version' AS code, path, schema_version AS value FROM r WHERE schema_version <> '2'
        UNION ALL SELECT 'invalid_primary_source_url', path, url FROM r WHERE url LIKE 'ftp:%'
        UNION ALL SELECT 'complete_record_missing_requirements', path, concat_ws(',', CASE WHEN lang = '' THEN 'lang' END, CASE WHEN source = '' THEN 'source' END, CASE WHEN n < 400 THEN 'narrative' END) FROM r WHERE lang = '' OR source = '' OR n < 400
        UNION ALL SELECT 'missing_field_provenance', path, 'source' FROM r WHERE source <> '' AND lang <> 'en'
        UNION ALL SELECT 'empty_source_section', path, NULL FROM r WHERE n < 300
        UNION ALL SELECT 'embedded_media_binary', path, NULL FROM r WHERE n > 2500
        UNION ALL SELECT 'missing_local_media_file', path, 'media/' || source || '.svg' FROM r WHERE n <= 2500 AND source NOT IN (SELECT source FROM r WHERE lang = 'en')
        UNION ALL SELECT 'normalized_json_not_published', path, NULL FROM r WHERE n <= 200
        UNION ALL SELECT 'duplicate_public_incident_code', 'data/incidents', h FROM r GROUP BY h HAVING count(DISTINCT id) > 1
        UNION ALL SELECT 'unknown_source_retrieval_status', 'data/sources/' || id || '.json', lang FROM d WHERE lang <> 'en'
        UNION ALL SELECT 'source_text_not_separated', 'data/sources/' || id || '.json', NULL FROM d WHERE text = ''
        UNION ALL SELECT 'duplicate_normalized_source_url', 'data/sources', 'https://s/' || h FROM d GROUP BY h HAVING count(*) > 1
        UNION ALL SELECT 'unrecorded_exact_content_duplicate', 'data/sources', h FROM d GROUP BY h HAVING count(*) > 1 AND max(n) <= 1000
        UNION ALL SELECT 'missing_source_page', 'sources/' || id || '/index.html', NULL FROM d WHERE lang = ''
        UNION ALL SELECT 'source_page_missing_provenance', 'sources/' || id || '/index.html', NULL FROM d WHERE lang NOT IN ('', 'en')
        UNION ALL SELECT 'duplicate_incident_source_relationship', 'data/relationships', a || '|' || b FROM rel GROUP BY a, b HAVING count(*) > 1
        UNION ALL SELECT DISTINCT 'orphan_incident_source_relationship', 'data/relationships', a || '|' || b FROM rel WHERE a = 'none'
        UNION ALL SELECT 'missing_incident_source_relationship', 'data/sources/' || id || '.json', id FROM d WHERE n <= 300)
    SELECT CASE WHEN code IN ('unexpected_schema_version', 'empty_source_section', 'duplicate_public_incident_code') THEN 'warning' ELSE 'critical' END AS severity, code, path, value FROM i
""")
def site_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every issue of a site that has a record, a source and a page for each document."""
    lang, source, text = (F.coalesce(F.col(c), F.lit("")) for c in ("lang", "source", "text"))
    d = heavy(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), lang.alias("lang"), source.alias("source"), F.length(text).alias("n"), F.sha2(text, 256).alias("h"))
    d = files.written(d, "site")  # texts are read once, not by each rule
    n, own, none = F.col("n"), F.col("id"), F.array().cast("array<string>")
    path = F.concat(F.lit("data/incidents/"), own, F.lit(".json"))
    records = d.select(
        own.alias("record_id"),
        path.alias("path"),
        "lang",
        "source",
        F.col("h").alias("public_code"),
        F.when(F.col("lang") == "en", "2").otherwise("1").alias("schema_version"),
        F.lit("p1").alias("parser_version"),
        F.concat(F.when(n > 2000, "ftp://x/").otherwise("https://x/"), own).alias("canonical_url"),
        F.lit("complete").alias("completeness_status"),
        F.when(n < 400, F.array(F.lit("narrative"))).alias("missing_sections"),
        F.when(F.col("lang") == "en", F.array(F.lit("lang"), F.lit("source"))).otherwise(F.array(F.lit("lang"))).alias("provenance"),
        F.lit(True).alias("sources_section_present"),
        F.when(n < 300, none).otherwise(F.array(F.concat(F.lit("https://s/"), "h"))).alias("source_urls"),
        F.array(F.when(n > 2500, F.lit("data:image/png;base64,AA")).otherwise(F.concat(F.lit("media/"), "source", F.lit(".svg")))).alias("media_urls"),
    )
    sources = d.select(
        own.alias("source_id"),
        F.concat(F.lit("https://s/"), "h").alias("normalized_url"),
        F.col("h").alias("content_hash"),
        F.when(F.col("lang").isin("", "en"), "successful").otherwise(F.col("lang")).alias("status"),
        F.when(n > 0, own).alias("text_original"),
        F.lit("").alias("text_translated"),
        F.when(n > 1000, F.col("h")).alias("duplicate_group"),
        F.array(own).alias("record_ids"),
    )
    pair = lambda rows, a: rows.select(a.alias("record_id"), own.alias("source_id"))
    relationships = pair(d.where(n > 300), own).unionByName(pair(d.where(n > 3000), F.lit("none"))).unionByName(pair(d.where(n > 4000), own))
    page = F.when(F.col("lang") == "en", "<p class=source-provenance>").otherwise("<p>")
    held = d.where(n > 200).select(path.alias("path"), F.lit(None).cast("string").alias("content"))
    held = held.unionByName(d.where("lang != ''").select(F.concat(F.lit("sources/"), own, F.lit("/index.html")).alias("path"), page.alias("content")))
    held = held.unionByName(d.where("lang = 'en'").select(F.concat(F.lit("media/"), "source", F.lit(".svg")).alias("path"), F.lit(None).cast("string").alias("content")))
    return site_audit.site_issues({"records": records, "sources": sources, "relationships": relationships, "files": held}, _RULES)


@query(r"""
    WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)[^-\w](?:href|src)\s*=\s*["'']([^"'']+)["'']', 1)) AS raw FROM pages),
      v AS (SELECT 'p/' || page_id || '/index.html' AS path, replace(trim(raw, ' '), '&amp;', '&') AS value FROM l)
    SELECT path, value, CASE WHEN value LIKE '//%' THEN 'malformed' WHEN value LIKE '/%' THEN 'root' WHEN regexp_matches(value, '(?i)^https?://[^/?#]|^(mailto|tel):[^?#]') THEN 'external'
        WHEN regexp_matches(value, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN 'malformed' ELSE 'internal' END AS kind
    FROM v WHERE value <> '' AND NOT value LIKE '#%' AND (NOT value LIKE '?%')
""")
def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every link of the given pages is to a site that has them as its own."""
    pages = heavy(spark, sf_dir, "pages").select(F.concat(F.lit("p/"), "page_id", F.lit("/index.html")).alias("path"), F.col("html").alias("content"))
    return site_audit.page_links(pages).select("path", "value", "kind")


@query("""
    WITH p AS (SELECT page_id, url, CASE WHEN regexp_matches(url, '^https?://[^/?#]') THEN 1 ELSE 0 END AS ok FROM pages),
      n AS (SELECT count(*) AS total, coalesce(sum(ok), 0) AS good, count(DISTINCT page_id) AS ids FROM p)
    SELECT (total - ids) + (total - good) AS critical, total AS warning, 0 AS info, 'files,internal_links,map,media,relationships,sources' AS unchecked, FALSE AS passed FROM n
""")
def site_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site whose records are the given pages: what was found, and that most wasn't looked at, so that it doesn't pass."""
    records = table(spark, sf_dir, "pages").select(F.col("page_id").alias("record_id"), F.col("url").alias("canonical_url"), F.lit("1").alias("schema_version"), F.lit("p1").alias("parser_version"))
    return site_audit.site_verdict({"records": records}, _RULES)


@query("""
    SELECT doc_id AS identity, CASE WHEN n_chars >= 400 OR lang = 'en' THEN 'PARSED' ELSE 'BLOCKED' END AS status, CASE WHEN n_chars >= 400 THEN 1 ELSE 2 END AS attempt FROM documents
""")
def worklist_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all documents that loses its driver in a batch, is paused and resumed, and whose gaps are retried."""
    run = runs.Run(spark, files.shared_folder(spark, "run"), batch_rows=table(spark, sf_dir, "documents").count() // 3 + 1)
    run.create(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("identity"), "lang", F.col("n_chars").alias("size")))
    calls: list[int] = []

    def process(rows: DataFrame, attempt: int) -> DataFrame:
        calls.append(attempt)
        if len(calls) == 2:
            raise BrokenOff("batch")
        if len(calls) == 3:
            run.request("pause")
        good = (F.col("size") >= 400) | ((F.col("lang") == "en") & (F.lit(attempt) > 1))
        return rows.select("identity", F.when(good, "PARSED").otherwise("BLOCKED").alias("status"))

    try:
        run.execute(process)
    except BrokenOff:
        run.execute(process)
    run.request("resume")
    run.execute(process)
    if run.state["status"] == "COMPLETED_WITH_GAPS":
        run.retry()
        run.execute(process)
    return run.outcomes().select("identity", "status", "attempt")
