"""Classifiers, merging and joins over columns made from the order tables, each with its rules written out in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators import audit, classify, dedupe, merge, metrics, refs, schedule, search
from sedimenta.plans.registry import query, table


def _read(spark: SparkSession, sf_dir: str, name: str, sql: str) -> DataFrame:
    """A query over one table that Spark's SQL and DuckDB's both read."""
    escaped = sql.replace("{", "{{").replace("}", "}}")
    return spark.sql(escaped.replace(f"FROM {name}", "FROM {t}"), t=table(spark, sf_dir, name))


_FETCH = """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 5 THEN 404 WHEN l_quantity < 10 THEN 410 WHEN l_quantity < 15 THEN 401 WHEN l_quantity < 20 THEN 429 WHEN l_quantity < 25 THEN 451 WHEN l_quantity < 30 THEN 503 WHEN l_quantity < 35 THEN 200 END AS status,
    CASE WHEN l_discount < 0.03 THEN 'ReadTimeout: Timed Out' WHEN l_discount < 0.06 THEN 'ConnectTIMEOUT' WHEN l_discount < 0.08 THEN 'reset' END AS error, CASE WHEN l_returnflag = 'R' THEN 403 END AS circuit FROM lineitem"""


@query(f"""
    WITH t AS ({_FETCH}) SELECT l_orderkey, l_linenumber,
        CASE WHEN status = 404 THEN 'not_found' WHEN status = 410 THEN 'gone' WHEN status = 401 THEN 'login_required' WHEN status IN (403, 429, 451) THEN 'blocked' WHEN regexp_matches(lower(coalesce(error, '')), 'timed? ?out') THEN 'timed_out' ELSE 'unavailable' END AS failure,
        CASE WHEN coalesce(status, 0) = 200 THEN 'SUCCESS' WHEN coalesce(circuit, 0) = 403 THEN 'BLOCKED_HTTP_403' WHEN status IN (404, 410) THEN 'DEAD' ELSE 'OTHER' END AS direct,
        CASE WHEN coalesce(status, 0) = 200 THEN 'mixed_historical_and_direct' WHEN l_linenumber % 2 = 0 THEN 'mixed_historical_and_archived' ELSE 'historical_snapshot' END AS origin FROM t
""")
def fetch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _read(spark, sf_dir, "lineitem", _FETCH)
    ok = F.coalesce(F.col("status") == 200, F.lit(False))
    return t.select("l_orderkey", "l_linenumber", classify.fetch_failure("status", "error").alias("failure"), classify.direct_verification(ok, "status", "circuit").alias("direct"), classify.record_origin(ok, F.col("l_linenumber") % 2 == 0).alias("origin"))


_REACH = """SELECT p_partkey, p_size, p_name, p_retailprice, CASE WHEN p_size < 5 THEN 'successful' WHEN p_size < 8 THEN 'media_metadata_preserved' WHEN p_size < 12 THEN 'recovery_deferred' ELSE 'pending' END AS retrieval,
    CASE WHEN p_type = 'ECONOMY' THEN 451 WHEN p_type = 'STANDARD' THEN 410 WHEN p_type = 'PROMO' THEN 500 END AS first_status, CASE WHEN p_brand IN ('Brand#11', 'Brand#5') THEN 401 ELSE 200 END AS second_status,
    CASE WHEN p_size % 5 = 0 THEN 'Access Denied by host' WHEN p_size % 5 = 1 THEN 'ConnectTimeout' WHEN p_size % 5 = 2 THEN 'Circuit open' ELSE 'odd' END AS evidence FROM part"""


@query(f"""
    WITH t AS ({_REACH}), r AS (SELECT *, CASE WHEN retrieval IN ('successful', 'media_metadata_preserved') THEN 'FETCHED' WHEN coalesce(first_status, 0) = 451 OR second_status = 401 THEN 'BLOCKED' WHEN coalesce(first_status, 0) = 410 THEN 'DEAD'
        WHEN p_size % 5 = 0 THEN 'BLOCKED' WHEN p_size % 5 IN (1, 2) THEN 'RETRYABLE_FAILURE' WHEN retrieval = 'recovery_deferred' THEN 'NEEDS_MANUAL_REVIEW' ELSE 'DISCOVERED' END AS reach FROM t)
    SELECT p_partkey, reach, CASE retrieval WHEN 'successful' THEN 'content_resolved' WHEN 'media_metadata_preserved' THEN 'policy_complete' WHEN 'recovery_deferred' THEN 'recovery_deferred' ELSE 'operational_error' END AS resolution, retrieval = 'media_metadata_preserved' AS policy FROM r
""")
def reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _read(spark, sf_dir, "part", _REACH)
    reach = classify.reachability("retrieval", F.array_compact(F.array("first_status", "second_status")), F.array("evidence"))
    return t.select("p_partkey", reach.alias("reach"), classify.resolution("retrieval").alias("resolution"), classify.policy_complete("retrieval").alias("policy"))


_SOURCE = """SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN 'Please log in to see this page' ELSE concat(p_name, ' is a text of its own that goes on for a while, long enough for an article of more than a hundred characters') END AS text,
    p_retailprice > 950 AS accepted, CASE WHEN p_size > 5 THEN 'full' ELSE 'partial' END AS completeness, CASE WHEN p_type = 'ECONOMY' THEN 'semantic_dom' WHEN p_type = 'PROMO' THEN 'jsonld:articleBody' WHEN p_type = 'STANDARD' THEN 'trafilatura' ELSE 'body' END AS method,
    CASE WHEN p_brand < 'Brand#2' THEN 'news_article' ELSE 'other_web_page' END AS kind, CASE WHEN p_size > 40 THEN 'listed_archive' WHEN p_size > 30 THEN 'historical_local' ELSE 'source_live' END AS provenance,
    CASE WHEN p_size % 8 = 4 THEN 'not a url' ELSE concat('http://h/', CAST(p_partkey AS STRING)) END AS url, CASE WHEN p_size % 3 = 0 THEN 'BLOCKED' WHEN p_size % 3 = 1 THEN 'DEAD' ELSE 'DISCOVERED' END AS reach, p_size > 25 AS described FROM part"""


@query(f"""
    WITH t AS ({_SOURCE}), f AS (SELECT *, CASE WHEN text = '' THEN 'empty_text' WHEN NOT (accepted AND completeness = 'full') THEN 'legacy_quality_not_full' WHEN text LIKE 'Please log in%' THEN 'restricted_or_login_required'
        WHEN method IN ('semantic_dom', 'jsonld:articleBody') THEN 'structured_extractor_validated' WHEN method = 'trafilatura' AND kind = 'news_article' AND length(text) >= 100 THEN 'main_text_extractor_validated' ELSE 'completeness_not_independently_established' END AS reason FROM t)
    SELECT p_partkey, reason, reason LIKE '%validated' AS passed, CASE WHEN text <> '' AND reason NOT LIKE '%validated' THEN 'PARTIAL_TEXT' WHEN text <> '' AND provenance = 'listed_archive' THEN 'FULL_TEXT_ARCHIVED' WHEN text <> '' AND provenance = 'historical_local' THEN 'FULL_TEXT_LOCAL_SNAPSHOT'
        WHEN text <> '' THEN 'FULL_TEXT_DIRECT' WHEN url = 'not a url' THEN 'MALFORMED' WHEN reach IN ('BLOCKED', 'DEAD') THEN reach WHEN described THEN 'METADATA_ONLY' ELSE 'URL_PRESERVED' END AS status FROM f
""")
def content_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _read(spark, sf_dir, "part", _SOURCE)
    t = t.withColumn("f", classify.full_text_check("text", "accepted", "completeness", "method", "kind", "provenance"))
    status = classify.content_status("text", F.col("f.passed"), "url", F.col("reach"), F.col("described"), "provenance", F.lit(""))
    return t.select("p_partkey", "f.reason", "f.passed", status.alias("status"))


_FORMATS = """SELECT p_partkey, CASE WHEN p_size < 5 THEN '%PDF-1.7' WHEN p_size < 10 THEN '  <!DOCTYPE html><p>' WHEN p_size < 15 THEN '{"a": 1}' WHEN p_size < 20 THEN '<rss>' ELSE 'plain words' END AS body,
    CASE WHEN p_type = 'ECONOMY' THEN 'text/html; charset=utf-8' WHEN p_type = 'PROMO' THEN 'application/json' WHEN p_type = 'STANDARD' THEN 'Text/CSV' WHEN p_brand = 'Brand#13' THEN 'text/plain' END AS content_type,
    CASE WHEN p_size % 6 = 0 THEN 'http://h/a.docx' WHEN p_size % 6 = 1 THEN 'http://h/a.XML?x=1' WHEN p_size % 6 = 2 THEN 'http://h/a.tsv' WHEN p_size % 6 = 3 THEN 'http://h/log.md#b' ELSE 'http://h/' END AS url FROM part"""


@query(f"""
    WITH t AS ({_FORMATS}), m AS (SELECT *, lower(trim(split_part(coalesce(content_type, ''), ';', 1))) AS mime, regexp_extract(lower(split_part(split_part(url, '?', 1), '#', 1)), '(\\.[^./]+)$', 1) AS suffix FROM t)
    SELECT p_partkey, CASE WHEN body LIKE '%%PDF-%' THEN 'pdf' WHEN suffix = '.docx' THEN 'office_open_xml' WHEN mime = 'application/json' THEN 'json' WHEN suffix = '.xml' THEN 'xml' WHEN mime LIKE '%html%' OR body LIKE '%<!DOCTYPE html>%' THEN 'html' WHEN mime = 'text/csv' THEN 'csv'
        WHEN suffix = '.tsv' THEN 'tsv' WHEN mime LIKE 'text/%' OR suffix = '.md' THEN 'text' WHEN body LIKE '{{%' THEN 'json' WHEN body LIKE '<%' THEN 'xml' ELSE 'unsupported' END AS format FROM m
""")
def body_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _read(spark, sf_dir, "part", _FORMATS)
    return t.select("p_partkey", classify.body_format(F.col("body").cast("binary"), "content_type", "url").alias("format"))


_STATUS = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END AS conflicts, o_orderpriority = '1-URGENT' AS review, o_totalprice > 100000 AS extracted, CASE WHEN o_totalprice > 200000 THEN 0 ELSE 3 END AS missing, o_orderpriority = '2-HIGH' AS any_ok,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 404 WHEN o_orderpriority = '5-LOW' THEN 403 END AS status, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 403 ELSE 0 END AS circuit FROM orders"""


@query(f"""
    WITH t AS ({_STATUS}) SELECT o_orderkey, CASE WHEN conflicts > 0 THEN 'conflicting_sources' WHEN review THEN 'pending_review' WHEN extracted AND missing = 0 THEN 'complete' WHEN extracted THEN 'partial' WHEN NOT any_ok AND status = 404 THEN 'unavailable'
        WHEN NOT any_ok AND (coalesce(status, 0) = 403 OR circuit = 403) THEN 'blocked' WHEN NOT any_ok THEN 'failed' ELSE 'partial' END AS status,
        concat_ws('+', CASE WHEN o_orderkey % 2 = 0 THEN 'narrative' END, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 > 2 THEN 'sources' END) AS sections FROM t
""")
def completeness_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _read(spark, sf_dir, "orders", _STATUS)
    k = F.col("o_orderkey")
    status = classify.completeness_status(F.col("conflicts"), F.col("review"), F.col("extracted"), F.col("missing"), F.col("any_ok"), F.array("status"), F.array("circuit"))
    sections = classify.missing_sections(F.when(k % 2 == 0, "").otherwise("told"), k % 3 != 0, F.lit(0), k % 5, F.lit(2))
    return t.select("o_orderkey", status.alias("status"), F.array_join(sections, "+").alias("sections"))


@query("""
    WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'raw' || l_partkey ELSE 'other' || l_partkey END AS raw_url, CASE WHEN l_linestatus = 'F' THEN 'n' || l_partkey ELSE '' END AS normalized_url FROM lineitem),
    s AS (SELECT p_partkey AS source_id, 'raw' || p_partkey AS raw, 'n' || CAST(floor(p_partkey / 2) * 2 AS BIGINT) AS norm FROM part), m AS (SELECT norm, min(source_id) AS id FROM s GROUP BY norm)
    SELECT r.l_orderkey, r.l_linenumber, r.raw_url, coalesce(s.source_id, m.id) AS source_id FROM r LEFT JOIN s ON r.raw_url = s.raw LEFT JOIN m ON r.normalized_url = m.norm
""")
def matched_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.when(F.col("l_returnflag") == "R", "raw").otherwise("other"), F.col("l_partkey")).alias("raw_url"), F.when(F.col("l_linestatus") == "F", F.concat(F.lit("n"), F.col("l_partkey"))).otherwise("").alias("normalized_url"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source_id"), F.array(F.concat(F.lit("raw"), F.col("p_partkey"))).alias("raw_urls"), F.concat(F.lit("n"), (F.floor(F.col("p_partkey") / 2) * 2).cast("bigint")).alias("normalized_url"))
    return refs.match_sources(lines, parts).select("l_orderkey", "l_linenumber", "raw_url", "source_id")


@query("""
    WITH m AS (SELECT s_suppkey, 'http://h/' || s_nationkey AS original_url FROM supplier), s AS (SELECT 'http://h/' || c_nationkey AS u, min(c_custkey) AS id FROM customer GROUP BY 1)
    SELECT m.s_suppkey, s.id AS source_id FROM m LEFT JOIN s ON m.original_url = s.u
""")
def media_to_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("HTTP://H/"), F.col("s_nationkey"), F.lit("#x")).alias("original_url"))
    sources = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), F.concat(F.lit("http://h/"), F.col("c_nationkey")).alias("normalized_url"))
    return refs.media_sources(media, sources).select("s_suppkey", "source_id")


@query("SELECT DISTINCT o_custkey, l_partkey, p_name FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey")
def through_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    edges = orders.join(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return refs.through_edges(customers, edges, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "o_custkey", "l_partkey")


@query("""
    WITH w AS (SELECT c_custkey AS id, c_nationkey AS k FROM customer WHERE c_acctbal < 0), g AS (SELECT s_suppkey AS from_id, s_nationkey AS k, s_name AS text FROM supplier WHERE s_acctbal > 0)
    SELECT w.id AS source_id, min(g.from_id) AS cached_from, arg_min(g.text, g.from_id) AS cached_text FROM w JOIN g ON w.k = g.k AND w.id <> g.from_id GROUP BY w.id
""")
def cache_hydration(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), F.col("c_nationkey").alias("fetch_key"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).otherwise("").alias("text"))
    digest = F.when(F.col("s_acctbal") > 0, F.sha2("s_name", 256)).otherwise("of another text")
    cache = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("fetch_key"), F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("text"), digest.alias("content_hash"))
    return refs.hydrate_from_cache(sources, cache)


@query(f"""
    WITH t AS ({_FETCH}), b AS (SELECT l_orderkey, coalesce(bool_or(status = 429), false) AS hit FROM t GROUP BY l_orderkey)
    SELECT t.l_orderkey, t.l_linenumber, b.hit AS batch_blocked, CASE WHEN t.status IS NULL AND b.hit THEN 403 WHEN t.status = 429 THEN 403 ELSE t.status END AS effective_status FROM t JOIN b USING (l_orderkey)
""")
def batch_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _read(spark, sf_dir, "lineitem", _FETCH).withColumn("status", F.when(F.col("status") == 429, 403).otherwise(F.col("status")))
    return dedupe.spread_evidence(t, "l_orderkey", "status").select("l_orderkey", "l_linenumber", "batch_blocked", "effective_status")


@query("""
    WITH h AS (SELECT o_orderkey AS u, o_custkey AS e FROM orders WHERE o_orderstatus = 'F'), n AS (SELECT o_orderkey AS u, o_custkey AS e FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 150000)
    SELECT u AS normalized_url, e FROM h UNION ALL SELECT u, e FROM n WHERE (u, e) NOT IN (SELECT u, e FROM h)
""")
def url_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("url"), F.col("o_custkey").alias("e"), "o_orderstatus", "o_totalprice")
    out = dedupe.url_observations(rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus <> 'F' or o_totalprice > 150000"), "url", "e", F.col("url"))
    return out.select("normalized_url", "e")


@query("SELECT o_custkey, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def first_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.append_unique(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


_PROMOTE = """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE repeat('a', CAST(o_totalprice / 1000 AS INT)) END AS old_text, o_orderpriority <> '2-HIGH' AS old_accepted, CAST(o_custkey % 100 AS INT) AS old_score,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE repeat('b', CAST(o_totalprice / 700 AS INT)) END AS new_text, CAST(o_orderkey % 100 AS INT) AS new_score, CASE WHEN o_orderpriority = '5-LOW' THEN 'public_x_post' ELSE 'news_article' END AS kind FROM orders"""


@query(f"""
    WITH t AS ({_PROMOTE}), d AS (SELECT *, new_text <> '' AND (old_text = '' OR NOT old_accepted OR (new_score > old_score AND length(new_text) >= length(old_text))
        OR (kind = 'news_article' AND length(new_text) >= greatest(400, CAST(floor(length(old_text) * 1.5) AS INT)))) AS promoted FROM t)
    SELECT o_orderkey, promoted, new_text <> '' AND NOT promoted AND new_text <> old_text AS review,
           NOT coalesce(old_text <> '' AND (new_text = '' OR old_score > new_score), false) AND NOT (new_text = '') AS admitted FROM d
""")
def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _read(spark, sf_dir, "orders", _PROMOTE)
    p = merge.promote(F.col("old_text"), F.col("old_accepted"), F.col("old_score"), F.col("new_text"), F.col("new_score"), F.col("kind"))
    admitted = merge.admit_to_cache(F.col("new_text"), F.sha2("new_text", 256), F.lit(True), F.col("new_score"), F.lit("successful"), F.col("old_text") != "", F.col("old_score"), F.lit("successful"))
    return t.withColumn("p", p).select("o_orderkey", "p.promoted", "p.review", admitted.alias("admitted"))


@query("""
    WITH a AS (SELECT l_orderkey, l_linenumber, l_shipdate, CASE l_linenumber WHEN 1 THEN 'live' WHEN 2 THEN 'alternate' ELSE 'archive' END AS route, l_quantity > 40 AS ok FROM lineitem)
    SELECT l_orderkey, count(*) AS attempts, arg_min(route, (l_linenumber, route)) FILTER (ok) AS route, CASE WHEN bool_or(ok) THEN 'successful' ELSE 'recovery_deferred' END AS status FROM a GROUP BY l_orderkey
""")
def retrieval_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    a = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(n == 1, "live").when(n == 2, "alternate").otherwise("archive").alias("route"), "l_quantity")
    return merge.first_accepted(a, "l_orderkey", "l_linenumber", F.col("l_quantity") > 40)


@query("""
    WITH r AS (SELECT user_id, event_id, ts, event_type FROM events WHERE event_type <> 'error')
    SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM r) WHERE n = 1
""")
def last_in_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("run_id", F.when(F.col("event_type") == "error", "old").otherwise("this"))
    return merge.last_in_run(rows, "user_id", "this", "event_id").select("user_id", "event_id")


@query("""
    WITH p AS (SELECT o_orderkey AS source_id, o_custkey AS host, CAST(l AS INT) AS tries, o_orderdate FROM (SELECT *, o_orderkey % 3 AS l FROM orders WHERE o_orderstatus = 'P')), r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY tries, o_orderdate, source_id) AS round FROM p)
    SELECT source_id FROM r ORDER BY round, CAST(host AS VARCHAR) LIMIT 40
""")
def recovery_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("source_id"), F.col("o_custkey").cast("string").alias("host"), (F.col("o_orderkey") % 3).alias("recovery_attempts"), F.col("o_orderdate").alias("first_deferred_at"))
    return schedule.select_recovery(p, F.col("host"), 40).select("source_id")


@query("""
    SELECT p_brand, count(*) AS n, sum(p_size) AS size, arg_max(p_name, p_partkey) AS state FROM part GROUP BY p_brand
""")
def merged_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"), F.max_by("p_name", "p_partkey").alias("state"), F.max("p_partkey").alias("at"))
    return metrics.merge_partials(parts, ["p_brand"], ["n", "size"], "state", "at")


@query("SELECT n_name AS host, o_orderstatus AS status, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL")
def merged_host_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    counts = rows.groupBy("o_custkey", F.col("n_name").alias("host"), F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    one = F.create_map(F.col("host"), F.create_map(F.col("status"), F.col("n"))).alias("host_status")
    return metrics.merge_host_maps(counts.select(one))


@query("SELECT count(*) AS n, sum(octet_length(encode(text))) AS bytes, avg(octet_length(encode(text))) AS mean, median(octet_length(encode(text))) AS median, quantile_disc(octet_length(encode(text)), 0.9) AS p90 FROM documents")
def text_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.size_report(table(spark, sf_dir, "documents"), "text")
    return out.withColumn("p90", F.col("p90").cast("bigint"))


@query("SELECT count(o_custkey) AS total, count(DISTINCT o_custkey) AS distinct_values, count(o_custkey) - count(DISTINCT o_custkey) AS repeated FROM orders")
def reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_summary(table(spark, sf_dir, "orders"), "o_custkey")


@query("""
    WITH d AS (SELECT unnest(['F', 'O', 'P', 'X']) AS value), r AS (SELECT DISTINCT o_orderstatus AS s, 'o' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS id FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY id) AS n FROM r)
    SELECT d.value, (SELECT count(*) FROM orders WHERE o_orderstatus = d.value) AS n, coalesce((SELECT string_agg(id, ',' ORDER BY id) FROM k WHERE k.s = d.value AND k.n <= 20), '') AS examples FROM d
""")
def summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("record_id"), "o_orderstatus")
    out = audit.summary_report(spark, rows, "o_orderstatus", ["F", "O", "P", "X"])
    return out.withColumn("examples", F.array_join("examples", ","))


@query("""
    WITH x AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders), i AS (
        SELECT CASE s WHEN 'F' THEN 'critical' WHEN 'O' THEN 'warning' ELSE 'info' END AS severity FROM x)
    SELECT count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning, count(*) FILTER (severity = 'info') AS info, count(*) FILTER (severity = 'critical') = 0 AS passed FROM i
""")
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_orderstatus")
    return audit.verdict(table(spark, sf_dir, "orders").select(F.when(s == "F", "critical").when(s == "O", "warning").otherwise("info").alias("severity")))


@query("SELECT s_suppkey AS id, sqrt(power(s_nationkey - 10, 2) + power(s_acctbal / 1000 - 4, 2)) AS distance FROM supplier WHERE sqrt(power(s_nationkey - 10, 2) + power(s_acctbal / 1000 - 4, 2)) <= 12 ORDER BY distance, id LIMIT 1")
def nearest_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("double").alias("x"), (F.col("s_acctbal") / 1000).alias("y"))
    return search.nearest_marker(points, 10.0, 4.0)


@query("""
    WITH s AS (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'FULL_TEXT_DIRECT' WHEN 1 THEN 'URL_PRESERVED' WHEN 2 THEN 'MALFORMED' WHEN 3 THEN 'BLOCKED' ELSE 'FULL_TEXT_ARCHIVED' END AS st FROM customer)
    SELECT 'full' AS record_set, count(*) FILTER (st LIKE 'FULL%') AS n FROM s UNION ALL SELECT 'link_only', count(*) FILTER (st = 'URL_PRESERVED') FROM s UNION ALL SELECT 'malformed', count(*) FILTER (st = 'MALFORMED') FROM s UNION ALL SELECT 'BLOCKED', count(*) FILTER (st = 'BLOCKED') FROM s
""")
def record_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_nationkey") % 5
    s = table(spark, sf_dir, "customer").select("c_custkey", F.when(k == 0, "FULL_TEXT_DIRECT").when(k == 1, "URL_PRESERVED").when(k == 2, "MALFORMED").when(k == 3, "BLOCKED").otherwise("FULL_TEXT_ARCHIVED").alias("content_status"))
    count = lambda name, df: df.agg(F.lit(name).alias("record_set"), F.count(F.lit(1)).alias("n"))
    out = count("full", search.record_set(s, "full"))
    for name in ("link_only", "malformed"):
        out = out.unionByName(count(name, search.record_set(s, name)))
    return out.unionByName(count("BLOCKED", search.record_set(s, "content_status", "BLOCKED")))


@query("""
    WITH m AS (SELECT o_custkey AS record_id, 'http://h/' || o_orderstatus || '/' || (o_orderkey % 40) AS url FROM orders)
    SELECT 'media-' || substr(sha256(url), 1, 24) AS media_id, url AS original_url, count(DISTINCT record_id) AS n FROM m GROUP BY url
""")
def media_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("http://h/"), F.col("o_orderstatus"), F.lit("/"), F.col("o_orderkey") % 40)
    records = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record_id"), F.array(url).alias("media_urls"))
    items, edges = refs.media_placeholders(records)
    return items.select("media_id", "original_url").join(edges.groupBy("media_id").agg(F.count(F.lit(1)).alias("n")), "media_id")


@query("""
    SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 'login_required' ELSE 'successful' END AS retrieval_status, CAST(CASE WHEN c_nationkey < 10 THEN 0 ELSE 1 END AS BIGINT) AS variants FROM customer
""")
def login_walls_undone(spark: SparkSession, sf_dir: str) -> DataFrame:
    wall = F.struct(F.lit("Please log in to continue").alias("text"))
    own = F.struct(F.col("c_name").alias("text"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.lit("successful").alias("retrieval_status"), F.when(F.col("c_nationkey") < 10, F.array(wall)).otherwise(F.array(wall, own)).alias("variants"))
    return merge.undo_login_walls(rows, "variants", classify.is_login_wall).withColumn("variants", F.size("variants").cast("bigint"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE o_orderstatus END AS value, CASE WHEN o_orderpriority <> '5-LOW' THEN 'live' ELSE 'saved' END AS provenance,
           o_orderpriority <> '5-LOW' AND o_orderstatus <> '' AND lower(o_orderpriority) <> lower(o_orderstatus) AS conflict FROM orders
""")
def verified_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("")
    v = merge.apply_verified(F.col("o_orderstatus"), F.lit("saved"), new, F.lit("live"))
    return table(spark, sf_dir, "orders").select("o_orderkey", v.alias("v")).select("o_orderkey", "v.value", "v.provenance", F.col("v.conflict").isNotNull().alias("conflict"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')")
def remaining_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.streaming.live import remaining

    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_linestatus") == "F", "PARSED").otherwise("FAILED").alias("status"))
    return remaining(table(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey", retry=True)
