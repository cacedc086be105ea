"""URL identity, kinds of sources, entities and links, over pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import fixed, urls
from sedimenta.operators import audit, dedupe, refs, schedule
from sedimenta.plans.registry import query, table

# The same pattern text as in Spark; RE2 reads it alike.
PARTS = urls.PARTS
NORMALIZED = f"""
    u AS (SELECT page_id, url AS raw, trim(url) AS v, regexp_extract(trim(url), '{PARTS}', ['scheme', 'host', 'port', 'path', 'query', 'fragment']) AS p FROM pages),
    n AS (
        SELECT page_id, raw, v, lower(p.scheme) AS scheme, regexp_replace(lower(p.host), '\\.$', '') AS host, p.port AS port,
               CASE WHEN p.path = '' THEN '/' ELSE p.path END AS path, p.query AS query
        FROM u
    ),
    j AS (
        SELECT *, scheme || '://' || host
                  || CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE ':' || port END
                  || path || query AS normalized,
               regexp_replace(host, '^www\\.', '') AS domain
        FROM n
    )
"""


@query(f"""
    WITH {NORMALIZED}
    SELECT page_id, raw, normalized, CASE WHEN normalized = v THEN 'unchanged' ELSE 'normalized' END AS status, domain FROM j
""")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = urls.normalize_url("url")
    return table(spark, sf_dir, "pages").select("page_id", link["raw"].alias("raw"), link["normalized"].alias("normalized"), link["status"].alias("status"), link["domain"].alias("domain"))


@query(f"""
    WITH {NORMALIZED}, q AS (
        SELECT *, list_filter(string_split(substr(query, 2), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(fbclid|gclid|mc_cid|mc_eid|utm_[^=]*)(=|$)')) AS kept FROM j
    )
    SELECT page_id, scheme || '://' || domain || path || CASE WHEN len(kept) = 0 THEN '' ELSE '?' || array_to_string(kept, '&') END AS fetch_key FROM q
""")
def url_cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.fetch_key("url").alias("fetch_key"))


@query(f"""
    WITH {NORMALIZED}
    SELECT 'external-' || substr(sha256(normalized), 1, 24) AS entity_id, arg_min(normalized, page_id) AS normalized_url,
           arg_min(CASE WHEN normalized = v THEN 'unchanged' ELSE 'normalized' END, page_id) AS status, arg_min(domain, page_id) AS domain,
           count(*) AS n_references, array_to_string(list(page_id ORDER BY page_id), ',') AS reference_ids,
           (SELECT array_to_string(list(r ORDER BY o), ' ') FROM (SELECT raw AS r, min(page_id) AS o FROM j k WHERE k.normalized = j.normalized GROUP BY raw)) AS raw_urls
    FROM j GROUP BY normalized
""")
def source_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = refs.roll_up_entities(table(spark, sf_dir, "pages"), "url", "page_id", "page_id")
    return found.select("entity_id", "normalized_url", "status", "domain", "n_references", F.array_join("reference_ids", ",").alias("reference_ids"), F.array_join("raw_urls", " ").alias("raw_urls"))


@query(f"""
    WITH {NORMALIZED}
    SELECT page_id, 'source-' || substr(sha256(normalized), 1, 24) AS source_id,
           CAST(CAST('0x' || substr(sha256(normalized), 1, 16) AS UBIGINT) % 32 AS INTEGER) AS shard FROM j
""")
def source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = urls.normalize_source_url("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.source_id("url").alias("source_id"), urls.shard(norm, 32).alias("shard"))


@query(f"WITH {NORMALIZED} SELECT domain AS host, count(*) AS n FROM j GROUP BY domain")
def host_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(urls.host_of("url").alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {NORMALIZED} SELECT domain AS host, count(*) AS n FROM j GROUP BY domain ORDER BY n DESC, host LIMIT 8")
def host_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_counts(spark, sf_dir).orderBy(F.desc("n"), F.asc("host")).limit(8)


_SOCIAL = " ".join(f"WHEN domain = '{d}' OR domain LIKE '%.{d}' THEN '{k}'" for d, k in fixed.SOCIAL_DOMAINS.items())
_ANY = lambda words: "(" + " OR ".join(f"contains(domain, '{w}')" for w in words) + ")"


@query(f"""
    WITH {NORMALIZED}
    SELECT page_id, CASE {_SOCIAL}
        WHEN regexp_matches(lower(path), '\\.pdf$') THEN 'pdf_document'
        WHEN regexp_matches(lower(path), '\\.(jpg|jpeg|png|gif|webp|avif|tif|tiff|svg)$') THEN 'direct_image_url'
        WHEN regexp_matches(lower(path), '\\.(mp4|mov|avi|mkv|webm|m4v)$') THEN 'direct_video_url'
        WHEN regexp_matches(lower(path), '\\.(mp3|wav|ogg|m4a|aac|flac)$') THEN 'direct_audio_url'
        WHEN {_ANY(fixed.GOVERNMENT_TOKENS)} THEN 'government_or_military_statement'
        WHEN {_ANY(fixed.NGO_TOKENS)} THEN 'ngo_report'
        WHEN {_ANY(fixed.BLOG_TOKENS)} THEN 'blog_post'
        WHEN domain = '' THEN 'unknown'
        WHEN {_ANY(fixed.NEWS_TOKENS)} THEN 'news_article'
        ELSE 'other_web_page' END AS source_type
    FROM j
""")
def source_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.source_type("url").alias("source_type"))


@query(f"""
    WITH {NORMALIZED}
    SELECT page_id, CASE WHEN domain IN ({", ".join(f"'{h}'" for h in fixed.ARCHIVE_HOSTS)}) THEN 'archive'
        WHEN domain = 'example.com' OR domain LIKE '%.example.com' THEN 'internal' ELSE 'external' END AS kind FROM j
""")
def link_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.link_kind("url", "example.com").alias("kind"))


@query("""
    WITH t AS (
        SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '[ \\t\\r\\n]+', ' ', 'g')) AS raw_title,
               length(html) AS html_chars, len(regexp_extract_all(html, '(?i)<a[^>]*href="([^"]*)"', 1)) AS links FROM pages
    )
    SELECT page_id, replace(replace(replace(raw_title, '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS title, CAST(links AS BIGINT) AS links, html_chars FROM t
""")
def html_title_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1), r"[ \t\r\n]+", " "))
    for name, plain in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        title = F.replace(title, F.lit(name), F.lit(plain))
    links = F.size(F.regexp_extract_all("html", F.lit(r'(?i)<a[^>]*href="([^"]*)"'), F.lit(1))).cast("bigint")
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"), links.alias("links"), F.length("html").cast("bigint").alias("html_chars"))


_EDGES = "e AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages)"


@query(f"WITH {_EDGES} SELECT href, count(*) AS n, count(DISTINCT page_id) AS pages FROM e GROUP BY href")
def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))
    return each.groupBy("href").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"))


@query(f"""
    WITH {_EDGES}, f AS (SELECT DISTINCT regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
    SELECT href, count(*) AS n FROM e WHERE href LIKE '/%' AND regexp_replace(href, '[?#].*$', '') NOT IN (SELECT path FROM f) GROUP BY href
""")
def dangling_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    each = pages.select(F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href")).where("href like '/%'")
    each = each.withColumn("target", F.regexp_replace("href", r"[?#].*$", ""))
    return audit.dangling(each, pages.select(path.alias("path")), "target", "path").groupBy("href").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH {NORMALIZED}, r AS (SELECT page_id, domain, row_number() OVER (PARTITION BY domain ORDER BY page_id) AS round, count(*) OVER (PARTITION BY domain) AS size FROM j)
    SELECT page_id, 'general:' || domain AS bucket, round, size AS bucket_size, row_number() OVER (ORDER BY round, size, 'general:' || domain) AS position FROM r
""")
def fair_order_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", schedule.route(F.lit(""), urls.host_of("url")).alias("route"))
    ordered = schedule.fair_order(pages, F.col("route"), [F.col("page_id")], by_size=True)
    return schedule.pages(ordered, schedule.turn_columns(by_size=True)).select("page_id", "bucket", "round", "bucket_size", "position")


@query("""
    WITH a AS (SELECT doc_id AS id FROM documents WHERE lang = 'en'), b AS (SELECT doc_id AS id FROM labels)
    SELECT id, 'missing' AS side FROM (SELECT id FROM a EXCEPT SELECT id FROM b) UNION ALL SELECT id, 'unexpected' FROM (SELECT id FROM b EXCEPT SELECT id FROM a)
""")
def set_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents against labelled ones."""
    english = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("doc_id").alias("id"))
    return dedupe.set_difference(english, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")), "id")
