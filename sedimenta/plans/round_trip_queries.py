"""Given tables written to each sink and read back by each source, and fetched bodies of every kind made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta import files
from sedimenta.functions import text as texts
from sedimenta.functions import urls
from sedimenta.operators import audit, classify, extract, record_pages, refs, search
from sedimenta.plans.registry import heavy, query, table
from sedimenta.plans.source_queries import _BLOCKS
from sedimenta.sources import readers, writers
from sedimenta.streaming import live


def _join(left: str, right: str, *more: object):
    return F.concat(F.lit(left), *[F.lit(m) if isinstance(m, str) else m for m in more], F.lit(right))


@query("SELECT s_suppkey AS id, s_name AS name, true AS own_file FROM supplier")
def json_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each supplier."""
    at = files.shared_folder(spark, "json-folder")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    writers.file_for_each(rows, at)
    found = readers.json_folder(spark, at, rows.schema)
    alone = F.count(F.lit(1)).over(Window.partitionBy("file")) == 1
    return found.withColumn("own_file", alone).where(f"{readers.CORRUPT} is null").select("id", "name", "own_file")


@query("SELECT s_suppkey AS record_id, s_name AS title FROM supplier")
def entity_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity files under a snapshot's names; damaged ones are left out."""
    at = files.shared_folder(spark, "entities")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    writers.file_for_each(rows, at)
    files.write_once(spark, f"{at}/part-damaged.json", '{"id": 1, "name": ')
    return readers.normalized_records(spark, at, rows.schema, {"record_id": "id", "title": "name"})


@query("SELECT doc_id, sha256(text) AS text_sha256, true AS numbered FROM documents UNION ALL SELECT NULL, NULL, true")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines of JSON, with a blank and a damaged line in a file of their own; every line has a number of its own."""
    at = files.shared_folder(spark, "json-lines")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows.write.json(at)
    files.write_once(spark, f"{at}/part-zz.json", "\n{damaged\n")
    found = readers.json_lines(spark, at, rows.schema)
    ends = found.groupBy("file").agg(F.count_distinct("line").alias("n"), F.count(F.lit(1)).alias("rows"))
    return found.join(ends, "file").select("doc_id", F.sha2("text", 256).alias("text_sha256"), (F.col("n") == F.col("rows")).alias("numbered"))


@query("SELECT doc_id, sha256(text) AS text_sha256 FROM documents")
def assembled_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that lies in parts is put together on the file system, then read as one."""
    at = files.shared_folder(spark, "parts")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    writers.json_parts(rows, f"{at}/parts")
    readers.assemble_parts(spark, f"{at}/parts", f"{at}/whole.json")
    return spark.read.schema(rows.schema).json(f"{at}/whole.json").select("doc_id", F.sha2("text", 256).alias("text_sha256"))


@query("SELECT sha256(html) AS sha256, count(*) * 2 AS attempts, any_value(octet_length(encode(html))) AS bytes FROM pages GROUP BY html")
def stored_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page fetched twice: each body once under its digest, every attempt a row."""
    at = files.shared_folder(spark, "bodies")
    pages = table(spark, sf_dir, "pages").select("url", F.col("html").cast("binary").alias("body"))
    for _ in range(2):
        writers.store_bodies(pages, f"{at}/bodies", f"{at}/attempts")
    bodies, attempts = spark.read.parquet(f"{at}/bodies"), spark.read.parquet(f"{at}/attempts")
    counts = attempts.groupBy("sha256").agg(F.count(F.lit(1)).alias("attempts"))
    return bodies.select("sha256", F.octet_length("body").cast("bigint").alias("bytes")).join(counts, "sha256")


@query("SELECT conv_id, count(*) AS n, max(turn) AS last_turn FROM conversations GROUP BY conv_id")
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns appended to a log in two lots."""
    at = files.shared_folder(spark, "audit")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    for part in (turns.where("turn % 2 = 0"), turns.where("turn % 2 = 1")):
        writers.append_audit(part, at)
    return spark.read.schema(turns.schema).json(at).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("last_turn"))


@query("""
    WITH r AS (SELECT o_orderkey, 'http://h/' || o_custkey AS raw_url, CASE WHEN o_orderstatus = 'P' THEN 'malformed' ELSE 'normalized' END AS status FROM orders)
    SELECT 'jsonl' AS form, count(*) AS n, count(DISTINCT raw_url) AS urls FROM r UNION ALL SELECT 'csv', count(*), count(DISTINCT raw_url) FROM r
    UNION ALL SELECT 'raw urls', count(DISTINCT raw_url), count(DISTINCT raw_url) FROM r UNION ALL SELECT 'normalized urls', count(DISTINCT raw_url), count(DISTINCT raw_url) FROM r WHERE status <> 'malformed'
""")
def exported_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = files.shared_folder(spark, "exports")
    url = F.concat(F.lit("http://h/"), "o_custkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("source_reference_id"), url.alias("raw_url"), url.alias("normalized_url"), F.when(F.col("o_orderstatus") == "P", "malformed").otherwise("normalized").alias("normalization_status"))
    writers.export_references(rows, at)
    forms = {"jsonl": spark.read.json(f"{at}/references_jsonl"), "csv": spark.read.option("header", True).csv(f"{at}/references_csv")}
    forms |= {f"{k} urls": spark.read.text(f"{at}/{k}_urls").withColumnRenamed("value", "raw_url") for k in ("raw", "normalized")}
    out = None
    for form, read in forms.items():
        one = read.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("raw_url").alias("urls")).withColumn("form", F.lit(form))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT '| lang | n |\n|---|---|\n' || string_agg('| ' || lang || ' | ' || n || ' |', chr(10) ORDER BY lang) || chr(10) AS report FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)")
def written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate as a Markdown table, written once and read back."""
    at = files.shared_folder(spark, "report")
    counts = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang")
    files.write_once(spark, f"{at}/languages.md", writers.markdown_table(counts))
    return spark.read.text(f"{at}/languages.md", wholetext=True).select(F.col("value").alias("report"))


@query("SELECT doc_id, sha256(text) AS text_sha256 FROM documents")
def decoded_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies in UTF-8 that say nothing, and in UTF-16 whose header says so."""
    wide = F.col("doc_id") % 2 == 1
    body = F.when(wide, F.encode("text", "UTF-16")).otherwise(F.encode("text", "UTF-8"))
    kind = F.when(wide, "text/plain; charset=UTF-16").otherwise("text/plain")
    return heavy(spark, sf_dir, "documents").select("doc_id", F.sha2(texts.decoded(body, kind), 256).alias("text_sha256"))


@query("SELECT c_custkey, 'Café ' || c_name || ' — ok' || chr(10) || 'ñandú' AS repaired FROM customer")
def repaired_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line was read in the wrong charset, the second wasn't."""
    broken = F.concat(F.lit("Café ".encode().decode("latin-1")), "c_name", F.lit(" — ok".encode().decode("latin-1")), F.lit("\nñandú"))
    return table(spark, sf_dir, "customer").select("c_custkey", texts.repair_mojibake(broken).alias("repaired"))


@query("SELECT o_orderkey, o_orderpriority || ',' || o_orderstatus AS vals FROM orders")
def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values under a name, at two depths, sorted."""
    doc = _join('{"status": "', '"}]}}', F.col("o_orderstatus"), '", "a": {"b": [{"status": "', F.col("o_orderpriority"))
    found = extract.json_values(table(spark, sf_dir, "orders").select("o_orderkey", doc.alias("doc")), "o_orderkey", "doc", ["status"])
    return found.select("o_orderkey", F.array_join(F.array_sort("values"), ",").alias("vals"))


@query("""
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'json:text' WHEN 1 THEN 'feed_items' WHEN 2 THEN 'delimited_rows' WHEN 3 THEN 'plain_text' ELSE 'semantic_dom' END AS method,
           CASE c_custkey % 5 WHEN 2 THEN 'name | segment' || chr(10) || c_name || ' | ' || c_mktsegment ELSE 'The story that ' || c_name || ' told of the segment ' || c_mktsegment || ' was long enough to keep as it is here.' END AS text FROM customer
""")
def extracted_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON, feeds, tables, plain texts and pages, each with the story of a customer."""
    n = F.col("c_custkey") % 5
    story = _join("The story that ", " was long enough to keep as it is here.", F.col("c_name"), " told of the segment ", F.col("c_mktsegment"))
    body = (
        F.when(n == 0, _join('{"title": "t", "text": "', '"}', story))
        .when(n == 1, _join("<rss><channel><item><title>t</title><description>", "</description></item></channel></rss>", story))
        .when(n == 2, F.concat(F.lit("name,segment\n"), "c_name", F.lit(","), "c_mktsegment"))
        .when(n == 3, story)
        .otherwise(_join("<html><body><nav>menu</nav><article><p>", "</p></article></body></html>", story))
    )
    kind = F.when(n == 0, "json").when(n == 1, "xml").when(n == 2, "csv").when(n == 3, "text").otherwise("html")
    rows = table(spark, sf_dir, "customer").select("c_custkey", body.alias("body"), kind.alias("kind"))
    return extract.extract_bodies(rows, "c_custkey", "body", F.lit("text/plain; charset=utf-8"), F.col("kind")).select("c_custkey", "method", "text")


@query(rf"""
    WITH {_BLOCKS}, a AS (SELECT b.*, max(n) FILTER (linked) OVER (PARTITION BY page_id) AS nav_end, min(n) FILTER (before = 'footer') OVER (PARTITION BY page_id) AS foot, min(n) FILTER (before = 'h1') OVER (PARTITION BY page_id) AS head FROM b),
    u AS (SELECT page_id, n, text, row_number() OVER (PARTITION BY page_id, lower(text) ORDER BY n) AS occurrence FROM a WHERE n >= head AND n < foot)
    SELECT page_id, 'semantic_dom' AS method, sha256(string_agg(text, chr(10) || chr(10) ORDER BY n)) AS text_sha256 FROM u WHERE occurrence = 1 GROUP BY page_id
""")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best candidate of every page: what it marks as its article, blocks that repeat once."""
    pages = heavy(spark, sf_dir, "pages")
    found = extract.extract_bodies(pages, "page_id", "html", F.lit("text/html; charset=utf-8"), F.lit("html"))
    return found.select("page_id", "method", F.sha2("text", 256).alias("text_sha256"))


@query("""
    SELECT o_orderkey, 'ORD' || o_orderkey AS code, strftime(o_orderdate, '%Y-%m-%d') AS day, 2 AS n_sources, 'http://s/' || o_custkey AS first_url, 'https://web.archive.org/x/' || o_orderkey AS archived, 12 AS declared, '/m/' || o_orderkey || '.jpg' AS media FROM orders
""")
def record_page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of single records: labelled fields, declared and listed sources, media."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    html = F.concat(
        F.lit("<html><body><nav>n</nav><article><div><h4>Incident Code</h4><p>ORD"), k, F.lit("</p></div><div><h4>Incident date</h4>"), F.date_format("o_orderdate", "MMMM d, yyyy"),
        F.lit("</div><section><h2>Sources (12)</h2><ul><li><a href='http://s/"), c, F.lit("'>Name</a> <a class=archive href='https://web.archive.org/x/"), k, F.lit("'>archive</a></li><li><a href='http://t/1'>Other</a></li></ul></section><figure><img src='/m/"), k, F.lit(".jpg'><figcaption>c</figcaption></figure></article></body></html>"),
    )
    found = record_pages.parse_pages(heavy(spark, sf_dir, "orders").select("o_orderkey", html.alias("body")), "o_orderkey", "body")
    value = lambda label: F.filter("fields", lambda f: f["label"] == label)[0]["value"]
    from sedimenta.functions.values import parsed_date

    return found.select(
        "o_orderkey", value("Incident Code").alias("code"), parsed_date(value("Incident date")).alias("day"), F.size("sources").alias("n_sources"), F.col("sources")[0]["url"].alias("first_url"),
        F.col("sources")[0]["archive_url"].alias("archived"), F.col("sources_declared").alias("declared"), F.col("media")[0]["url"].alias("media"),
    )


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    html = F.concat(
        F.lit("<article"), F.when(n != 3, _join(" data-accession='", "'", k)).otherwise(""), F.lit("><h1 class='entry-title'>"), "c_name", F.lit("</h1>"),
        F.when(n != 4, _join("<section class='abstract'>About ", "</section>", F.col("c_mktsegment"))).otherwise(""), F.lit("<a class='reference-link' href='http://r/"), n.cast("string"), F.lit("'>r</a><a class='reference-link' href='not a url'>x</a></article>"),
    )
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("http://c/"), k).alias("url"), html.cast("binary").alias("body"))


@query("""
    SELECT CASE WHEN c_nationkey <> 3 THEN CAST(c_custkey AS VARCHAR) END AS record_id, 'http://c/' || c_custkey AS url, c_name AS title, 'http://r/' || c_nationkey || '|not a url' AS links,
           CASE WHEN c_nationkey = 3 THEN 'catalogue_entry_missing' WHEN c_nationkey = 4 THEN 'missing_required_field:abstract' END AS error FROM customer
""")
def catalogue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue connector, chosen by its key, over a table of responses."""
    found = readers.connector("catalogue").parse(_catalogue(spark, sf_dir))
    return found.select("record_id", "url", F.col("fields")["title"].alias("title"), F.array_join("references", "|").alias("links"), "error")


@query("""
    SELECT 'accession' AS field, count(*) FILTER (c_nationkey <> 3) AS n FROM customer UNION ALL SELECT 'title', count(*) FROM customer UNION ALL SELECT 'abstract', count(*) FILTER (c_nationkey <> 4) FROM customer UNION ALL SELECT '(references)', 2 * count(*) FROM customer
""")
def site_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.connector("catalogue").analyze(_catalogue(spark, sf_dir))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'first' ELSE 'second' END AS provider, CASE WHEN o_orderstatus = 'F' THEN 'a' ELSE 'b' END || o_orderkey AS capture FROM orders WHERE o_orderstatus IN ('F', 'O')")
def captures_of_two_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(s == "F", F.concat(F.lit("a"), k)).alias("first"), F.when(s.isin("F", "O"), F.concat(F.lit("b"), k)).alias("second"))
    return readers.capture_by_provider(rows, "o_orderkey", ["first", "second"])


@query("""
    SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'https://publish.twitter.com/oembed?omit_script=1&url=https%3A%2F%2Fx.com%2Fa%2Fstatus%2F' || c_custkey WHEN 1 THEN 'https://www.youtube.com/oembed?format=json&url=https%3A%2F%2Fyoutu.be%2Fv' || c_custkey
           WHEN 2 THEN 'https://t.me/c/' || c_custkey || '?embed=1' END AS endpoint,
           CASE c_nationkey % 4 WHEN 0 THEN 'The whole story that ' || c_name || ' told there.' WHEN 1 THEN 'A video that ' || c_name || ' made there' || chr(10) || 'Channel' ELSE 'A long post of ' || c_name || ' about it all.' END AS text,
           CASE c_nationkey % 4 WHEN 1 THEN 'successful_partial' ELSE 'successful' END AS status FROM customer
""")
def platform_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoints of posts, and what their answers say."""
    n, k, name = F.col("c_nationkey") % 4, F.col("c_custkey").cast("string"), F.col("c_name")
    url = F.when(n == 0, F.concat(F.lit("https://x.com/a/status/"), k)).when(n == 1, F.concat(F.lit("https://youtu.be/v"), k)).when(n == 2, F.concat(F.lit("https://t.me/c/"), k)).otherwise("https://example.org/x")
    platform = F.when(n == 0, "x").when(n == 1, "youtube").when(n == 2, "telegram").otherwise("facebook")
    body = F.when(n == 0, _join('{"html": "<blockquote><p>The whole story that ', ' told there.</p></blockquote>", "author_name": "A"}', name)).when(n == 1, _join('{"title": "A video that ', ' made there", "author_name": "Channel"}', name)).otherwise(_join("<div><p>A long post of ", " about it all.</p></div>", name))
    said = classify.platform_text(platform, body)
    return table(spark, sf_dir, "customer").select("c_custkey", urls.platform_endpoints(url).alias("endpoint"), said["text"].alias("text"), said["status"].alias("status"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'Sources (1,2' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || ') ' || repeat('saved text ', 12) END AS saved_text, CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 1200 + o_orderkey % 100 END AS declared FROM orders")
def saved_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")
    saved = F.when(F.col("o_orderstatus") == "P", "Sources (3) short").otherwise(F.concat(F.lit("Sources (1,2"), n, F.lit(") "), F.repeat(F.lit("saved text "), F.lit(12))))
    orders = table(spark, sf_dir, "orders")
    found = readers.with_snapshot_text(orders.select("o_orderkey"), orders.select("o_orderkey", saved.alias("snapshot_text")), "o_orderkey")
    return found.select("o_orderkey", "saved_text", F.col("declared_sources").alias("declared"))


@query("SELECT o_orderkey AS record_id, o_orderstatus AS title, CAST(o_custkey AS BIGINT) AS owner FROM orders")
def imported_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("rendered")).alias("title"), F.struct(F.col("o_custkey").alias("id")).alias("owner")))
    rows = table(spark, sf_dir, "orders").select(payload.alias("payload"))
    return readers.snapshot_import(rows, "payload", "struct<id: bigint, title: struct<rendered: string>, owner: struct<id: bigint>>", {"record_id": "id", "title": "title.rendered", "owner": "owner.id"}).drop("raw")


@query("""
    WITH d AS (SELECT c_custkey AS source_id, c_nationkey AS host FROM customer WHERE c_acctbal < 5000), r AS (SELECT * FROM d WHERE source_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
    SELECT 'h' || host AS host, count(*) AS pending, sum(CASE WHEN host < 10 THEN 1 ELSE 0 END)::BIGINT AS attempts FROM r GROUP BY host
""")
def recovery_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources deferred twice (which changes nothing), some tried, some resolved."""
    rows = table(spark, sf_dir, "customer").where("c_acctbal < 5000").select(F.col("c_custkey").cast("string").alias("source_id"), F.lit("u").alias("original_url"), F.concat(F.lit("h"), "c_nationkey").alias("host"), F.lit("timeout").alias("reason"), "c_nationkey", "c_mktsegment")
    now = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    queue = live.RecoveryQueue(spark, "all")
    for _ in range(2):
        queue.defer(rows, "all", now)
    queue.note(rows.where("c_nationkey < 10").select("source_id", F.lit("timed_out").alias("status")), now)
    queue.resolve(rows.where("c_mktsegment = 'BUILDING'"))
    return queue.pending.groupBy("host").agg(F.count(F.lit(1)).alias("pending"), F.sum("recovery_attempts").alias("attempts"))


@query("""
    SELECT * FROM (
    SELECT 'critical' AS severity, 'reference_without_record' AS code, count(*) FILTER (o_orderstatus = 'P') AS n FROM orders UNION ALL SELECT 'critical', 'full_text_without_text', count(*) FILTER (c_nationkey = 1) FROM customer UNION ALL SELECT 'critical', 'blocked_as_success', count(*) FILTER (c_nationkey = 2) FROM customer
    UNION ALL SELECT 'warning', 'record_without_reference', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P') UNION ALL SELECT 'info', 'coordinates_not_drawable', count(*) FILTER (c_nationkey = 5) FROM customer
    ) WHERE n > 0
""")
def site_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validator's rules over customers as records and sources, orders as references."""
    n, k = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    records = customers.select(k.alias("record_id"), F.when(n != 5, "35.5").alias("latitude"), F.lit("38.5").alias("longitude"))
    sources = customers.select(k.alias("source_id"), F.lit("FULL_TEXT_DIRECT").alias("content_status"), F.when(n != 1, "a text").alias("text"), F.when(n == 2, 403).otherwise(200).alias("http_status"), F.lit("FETCHED").alias("reachability"))
    references = orders.select(F.col("o_orderkey").alias("source_reference_id"), F.when(F.col("o_orderstatus") == "P", "none").otherwise(F.col("o_custkey").cast("string")).alias("record_id"), F.col("o_custkey").cast("string").alias("source_id"))
    found = audit.issues({"records": records, "sources": sources, "references": references}, audit.record_rules())
    return found.groupBy("severity", "code").agg(F.count(F.lit(1)).alias("n"))


@query(r"""
    WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages), k AS (SELECT DISTINCT href FROM l WHERE length(href) % 2 = 0)
    SELECT '/p/' || page_id AS page, href, CASE WHEN href LIKE '%/' THEN href || 'index.html' ELSE href END AS target FROM l WHERE href NOT IN (SELECT href FROM k)
""")
def broken_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all pages against a site that has every other of their targets."""
    pages = heavy(spark, sf_dir, "pages").select(F.concat(F.lit("/p/"), "page_id").alias("path"), "html")
    known = pages.select(F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), F.lit(1))).alias("path")).where("length(path) % 2 = 0").distinct()
    found = audit.link_audit(pages, known)
    return found.where("problem = 'broken'").select(F.col("path").alias("page"), "href", "target")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, 'record' AS kind, lower(c_name) AS title_folded, lower(c_custkey || ' ' || c_name || ' ' || c_mktsegment) AS search_text, c_mktsegment AS snippet FROM customer
    UNION ALL SELECT 's' || s_suppkey, 'source', lower(s_name), lower('s' || s_suppkey || ' ' || s_name), '' FROM supplier
""")
def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search index over texts of ASCII, whose fold SQL has as well."""
    records = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("title"), F.lit("x").alias("status"), F.col("c_mktsegment").alias("text"))
    sources = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("title"), F.lit("x").alias("status"), F.lit("").alias("text"))
    return search.index_rows(records, sources).select("id", "kind", texts.search_fold("title").alias("title_folded"), "search_text", "snippet")


@query("SELECT o_orderkey, c_name, c_nationkey < 10 AS in_scope FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def enriched_in_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment keeps what has no payload; a semi join keeps what a scope names."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    scope = customers.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    joined = orders.join(scope, "o_custkey", "left_semi").join(customers, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("o_orderkey", "c_name", (F.col("c_nationkey") < 10).alias("in_scope"))


@query("SELECT c_custkey, 'http://a/wp-json/wp/v2/incidents?slug=CS%20' || c_custkey || '|http://a/wp-json/wp/v2/incidents/' || c_nationkey AS urls, 2 AS n FROM customer WHERE c_nationkey <> 7 UNION ALL SELECT c_custkey, 'http://a/wp-json/wp/v2/incidents/' || c_nationkey, 1 FROM customer WHERE c_nationkey = 7")
def endpoint_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("c_nationkey") != 7, F.concat(F.lit("CS "), "c_custkey"))
    found = table(spark, sf_dir, "customer").select("c_custkey", readers.endpoint_urls("http://a", code, F.col("c_nationkey")).alias("u"))
    return found.select("c_custkey", F.array_join(F.transform("u", lambda u: F.replace(u, F.lit("CS+"), F.lit("CS%20"))), "|").alias("urls"), F.size("u").alias("n"))


@query("SELECT o_custkey, bool_and(o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS same FROM orders GROUP BY o_custkey")
def equal_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a customer's orders are those that have lines, by the set difference of both."""
    from sedimenta.operators.dedupe import set_difference

    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    missing = set_difference(orders, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), "k").where("side = 'missing'").select("k", F.lit(False).alias("_in"))
    return orders.join(missing, "k", "left").groupBy("o_custkey").agg(F.bool_and(F.coalesce("_in", F.lit(True))).alias("same"))
