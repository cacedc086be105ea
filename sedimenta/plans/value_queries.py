"""Texts, URLs, dates, numbers and arrays over columns made from the tables, each with its rules written out in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import text, urls, values
from sedimenta.operators import classify, extract, metrics, refs
from sedimenta.plans.registry import query, table
from sedimenta.sources import readers


@query("""
    SELECT o_orderkey, coalesce(nullif(CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END, ''), nullif(CASE WHEN o_orderpriority LIKE '5%' THEN '' ELSE o_orderpriority END, ''), 'none') AS first_value,
           concat_ws('+', CASE WHEN o_orderstatus = 'P' THEN 'status' END, CASE WHEN o_orderpriority LIKE '5%' THEN 'priority' END) AS missing FROM orders
""")
def present_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.when(F.col("o_orderpriority").startswith("5"), "").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", values.first_present(status, priority, F.lit("none")).alias("first_value"), F.array_join(values.missing_names(status=status, priority=priority), "+").alias("missing"))


@query("SELECT p_partkey, array_to_string(list_concat([p_size], CASE WHEN p_size % 2 = 0 THEN [p_size + 3] ELSE [] END, range(p_size + 10, p_size + 13)), ',') AS numbers FROM part")
def sequence_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    listed = F.concat_ws(",", s, F.when(s % 2 == 0, F.concat(s + 3, F.lit(", "), s)), F.concat(s + 10, F.lit("-"), s + 12))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(values.sequence_numbers(listed), ",").alias("numbers"))


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 6 = 5 THEN 'unknown day' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS read_day,
           printf('%02d', CAST(floor(o_totalprice) AS BIGINT) // 3600) || ':' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS clock,
           starts_with(strftime(o_orderdate, '%Y-%m-%d'), '1997-1') AS in_months FROM orders
""")
def dates_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey") % 6, F.col("o_orderdate")
    written = F.when(k == 0, F.date_format(d, "MMMM d, yyyy")).when(k == 1, F.date_format(d, "d MMMM yyyy")).when(k == 2, F.concat(F.lit("on "), F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00"))).when(k == 5, "unknown day").otherwise(F.date_format(d, "yyyy-MM-dd"))
    day = F.date_format(d, "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"), values.parsed_date(written).alias("read_day"), values.clock("o_totalprice").alias("clock"), day.startswith("1997-1").alias("in_months"))


@query("""
    SELECT p_partkey, CAST(CASE p_size % 4 WHEN 0 THEN least(120.0, p_size * 4) WHEN 1 THEN NULL WHEN 2 THEN 30.0 ELSE 0.0 END AS DOUBLE) AS retry_after, CAST(least(power(2.0, p_size - 1), 30.0) AS DOUBLE) AS backoff,
           CASE WHEN p_size < 5 THEN 0 WHEN p_size < 15 THEN 604800 WHEN p_size < 25 THEN 43200 WHEN p_size < 35 THEN 900 ELSE 21600 END AS negative FROM part
""")
def retry_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    header = F.when(s % 4 == 0, (s * 4).cast("string")).when(s % 4 == 1, "soon").when(s % 4 == 2, "Mon, 01 Jan 2024 00:00:30 GMT").otherwise("Sun, 31 Dec 2023 23:59:00 GMT")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    reason = F.when(s < 10, "HTTP not_found").when(s < 15, "no_wayback_capture").when(s < 25, "Forbidden by host").otherwise("odd")
    return table(spark, sf_dir, "part").select("p_partkey", values.retry_after(header, now).alias("retry_after"), values.backoff("p_size", 30.0).alias("backoff"), values.retry_seconds(s < 3, reason, s < 5, s < 35).alias("negative"))


@query("""
    SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN CAST(c_custkey + 0.25 AS DOUBLE) END AS lat, CASE WHEN c_nationkey < 20 THEN CAST(0.5 * c_nationkey AS DOUBLE) END AS lon, CAST((0.5 * c_nationkey + 30 - 34) / 9 * 900 AS DOUBLE) AS x, CAST((38 - (31 + c_nationkey / 10.0)) / 7 * 700 AS DOUBLE) AS y FROM customer
""")
def coordinates_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_nationkey")
    said = F.when(n < 20, F.concat(F.lit("at "), (F.col("c_custkey") + F.lit(0.25)).cast("decimal(20,2)").cast("string"), F.lit(" N, "), (n * 0.5).cast("string"), F.lit(" E"))).otherwise("one 7 only")
    pair = values.coordinate_pair(said)
    point = values.map_point(F.lit(31) + n / 10.0, n * 0.5 + 30, 900.0, 700.0)
    return table(spark, sf_dir, "customer").select("c_custkey", pair["lat"].alias("lat"), pair["lon"].alias("lon"), point["x"].alias("x"), point["y"].alias("y"))


@query("""
    WITH g AS (SELECT o_custkey, list(o_orderstatus ORDER BY o_orderkey) AS s, list(o_orderpriority ORDER BY o_orderkey) AS p FROM orders GROUP BY o_custkey)
    SELECT o_custkey, array_to_string(list_sort(list_distinct(s)), ',') AS sorted, (SELECT count(DISTINCT x) FROM (SELECT unnest(list_concat(s, p)) AS x)) AS n_union, list_contains(s, 'P') AS any_partial, len(list_filter(p, lambda x: x <> '1-URGENT')) = 0 AS all_urgent,
           list_filter(p, lambda x: x LIKE '2%' OR x LIKE '3%')[1] AS first_middle FROM g
""")
def array_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority")))
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(rows.alias("r")).select("o_custkey", F.transform("r", lambda r: r["o_orderstatus"]).alias("s"), F.transform("r", lambda r: r["o_orderpriority"]).alias("p"))
    return g.select(
        "o_custkey",
        F.array_join(values.sorted_unique("s"), ",").alias("sorted"),
        F.size(values.ordered_union("s", "p")).cast("bigint").alias("n_union"),
        F.exists("s", lambda x: x == "P").alias("any_partial"),
        F.forall("p", lambda x: x == "1-URGENT").alias("all_urgent"),
        values.first_match("p", lambda x: x.startswith("2") | x.startswith("3")).alias("first_middle"),
    )


@query("""
    SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'record-' || c_custkey ELSE 'legacy-seq-' || CASE WHEN c_custkey < 10000 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') ELSE substr(CAST(c_custkey AS VARCHAR), 1, 4) END END AS internal_id,
           lower(c_mktsegment) || '-no-' || c_custkey AS slug, CASE WHEN c_nationkey = 1 THEN NULL ELSE c_custkey * 1000 + 7 END AS declared, 'a &amp; &lt;' || c_name || '&gt; &quot;q&quot; &#x27;s&#x27;' AS escaped, left(repeat(c_name, 30), 300) AS snippet, c_name || ' told' AS marked FROM customer
""")
def labels_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n, name = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_name")
    code = F.when(n % 3 == 0, F.concat(F.lit("CS"), k)).otherwise("none")
    url = F.concat(F.lit("http://h/x/"), F.col("c_mktsegment"), F.lit("_No. "), k, F.lit("/?q=1#z"))
    label = F.when(n == 1, "Sources").otherwise(F.concat(F.lit("Sources ("), F.format_number(k * 1000 + 7, 0), F.lit(")")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        urls.internal_id(code, "c_custkey").alias("internal_id"),
        text.slug(url).alias("slug"),
        text.declared_count(label).cast("bigint").alias("declared"),
        text.escape_html(F.concat(F.lit("a & <"), name, F.lit("> \"q\" 's'"))).alias("escaped"),
        text.snippet(F.repeat(name, F.lit(30))).alias("snippet"),
        text.strip_input_marker(F.concat(F.lit("  [INPUT]  "), name, F.lit(" told"))).alias("marked"),
    )


@query("""
    SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN true WHEN 4 THEN false ELSE true END AS same, p_name || chr(10) || chr(10) || p_type AS joined,
           CASE WHEN p_size >= 25 THEN repeat(p_name, 5) END AS captured, p_name || chr(10) || 'two & <three>' AS stripped FROM part
""")
def texts_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, name = F.col("p_size"), F.col("p_name")
    a = F.when(s % 6 == 0, F.concat(F.upper("p_name"), F.lit("  x"))).when(s % 6 == 1, name).when(s % 6 == 2, "1.00000001").when(s % 6 == 3, "STRASSE").when(s % 6 == 4, "1.01").otherwise("")
    b = F.when(s % 6 == 0, F.concat(F.lit(" "), "p_name", F.lit(" X "))).when(s % 6 == 1, "").when(s % 6 == 2, "1").when(s % 6 == 3, "straße").when(s % 6 == 4, "1").otherwise(F.lit(None))
    blocks = F.array(F.concat(name, F.lit("  ")), F.concat(F.lit(" "), F.upper("p_name")), F.lit(" "), F.col("p_type"), F.concat(F.lit("  "), name))
    shell = F.when(s < 25, F.concat(F.lit("Please log in to see "), name)).otherwise(F.repeat(name, F.lit(5)))
    html = F.concat(F.lit("<div><script>var x = '<b>';</script>"), name, F.lit("<br/>two &amp; &lt;three&gt;</div><!-- no -->"))
    return table(spark, sf_dir, "part").select("p_partkey", text.same_value(a, b).alias("same"), text.unique_paragraphs(blocks).alias("joined"), text.capture_text(shell, F.lit("short")).alias("captured"), text.strip_tags(html).alias("stripped"))


@query("SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[ \\t\\r\\n]+', ' ', 'g')) AS folded FROM documents")
def folded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.search_fold("text").alias("folded"))


@query("SELECT doc_id, length(text) AS covered, true AS short_enough FROM documents")
def chunks_are_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a text its chunks cover, each from where the one before it ended or behind the paragraph's end; -1 once one differs."""
    chunks = F.col("chunks")

    def step(at, chunk):
        gap = F.when(F.substring(F.col("text"), at + 1, F.lit(2)) == "\n\n", F.lit(2)).otherwise(F.lit(0))
        here = lambda skip: F.substring(F.col("text"), at + skip + 1, F.length(chunk)) == chunk
        return F.when(at < 0, at).when((at > 0) & here(gap), at + gap + F.length(chunk)).when(here(F.lit(0)), at + F.length(chunk)).otherwise(F.lit(-1))

    rows = table(spark, sf_dir, "documents").select("doc_id", "text", text.text_chunks("text", 1000).alias("chunks"))
    return rows.select("doc_id", F.aggregate(chunks, F.lit(0), step).cast("bigint").alias("covered"), F.forall(chunks, lambda c: F.length(c) <= 1000).alias("short_enough"))


@query("""
    SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'https://site.org/a' WHEN 1 THEN 'https://a-b.example.com/p' WHEN 2 THEN 'http://plain.net/x' ELSE 'not a url' END AS unwrapped, c_nationkey % 4 = 1 AS allowed, c_nationkey % 4 <> 3 AS external,
           CASE WHEN c_nationkey % 2 = 0 THEN 'http://u/' || c_custkey || ',https://v/x' ELSE '' END AS found FROM customer
""")
def urls_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = F.col("c_nationkey") % 4, F.col("c_custkey")
    url = F.when(n == 0, "https://translate.google.com/translate?sl=ar&u=https%3A%2F%2Fsite.org%2Fa").when(n == 1, "https://a--b-example-com.translate.goog/p?_x_tr_sl=ar").when(n == 2, "HTTP://Plain.net:80/x#f").otherwise("not a url")
    told = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("see http://u/"), k, F.lit("), and (https://v/x)."))).otherwise("none here")
    site = F.when(n == 1, "https://www.sub.allowed.org/x").otherwise("https://notallowed.org/x")
    return table(spark, sf_dir, "customer").select("c_custkey", urls.unwrap_proxy(url).alias("unwrapped"), urls.domain_allowed(site, ["allowed.org"]).alias("allowed"), urls.is_external_url(F.when(n == 3, "mailto:a@b").otherwise(url)).alias("external"), F.array_join(urls.urls_in(told), ",").alias("found"))


@query("""
    SELECT c_custkey, c_nationkey < 13 AS archived, CASE WHEN c_nationkey < 13 THEN 'https://archive.ph/Ab' || c_custkey ELSE 'https://h/wip' END AS page, c_nationkey % 2 = 0 OR c_nationkey % 3 = 0 AS has_text, c_nationkey % 3 = 0 AS has_archived FROM customer
""")
def archive_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    url = F.when(n < 13, F.concat(F.lit("https://archive.ph/wip/Ab"), k)).otherwise("https://h/wip")
    variants = F.array(F.struct(F.when(n % 3 == 0, "kept").alias("text"), F.lit("Wayback copy").alias("provenance")))
    own = F.when(n % 2 == 0, "own").otherwise("")
    return table(spark, sf_dir, "customer").select("c_custkey", urls.is_archive_host(url).alias("archived"), urls.archive_path(url).alias("page"), classify.has_text(own, variants).alias("has_text"), classify.has_archived_text(variants).alias("has_archived"))


@query("""
    SELECT o_custkey, strftime(max(o_orderdate), '%Y%m%d') AS timestamp, count(*) AS n FROM orders GROUP BY o_custkey
""")
def newest_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.array(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("200"))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.concat(F.array(F.array(F.lit("timestamp"), F.lit("statuscode"))), F.collect_list(row)).alias("r"))
    answers = rows.select("o_custkey", F.to_json("r").alias("payload"))
    n = readers.capture_rows(answers, "o_custkey", "payload").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return readers.latest_capture(answers, "o_custkey", "payload").select("o_custkey", F.col("capture")["timestamp"].alias("timestamp")).join(n, "o_custkey")


@query("""
    SELECT event_id, '$.k' AS path, json_extract_string(props, '$.k') AS value FROM events
    UNION ALL SELECT event_id, '$.nested[0].token', event_type FROM events UNION ALL SELECT event_id, '$.nested[1]', 'x' FROM events
""")
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "nested": [{"token": "'), F.col("event_type"), F.lit('"}, "x"]}'))
    return extract.json_leaves(table(spark, sf_dir, "events").select("event_id", made.alias("doc")), "event_id", "doc")


@query("SELECT event_id, event_type AS value FROM events WHERE event_type <> 'error'")
def credentials_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_type") == "error", "colour").otherwise("X-Api-Key")
    made = F.concat(F.lit('{"headers": {"'), F.replace(name, F.lit("-"), F.lit("_")), F.lit('": "'), F.col("event_type"), F.lit('"}, "n": 1}'))
    return extract.credential_like(table(spark, sf_dir, "events").select("event_id", made.alias("doc")), "event_id", "doc").select("event_id", "value")


@query("""
    SELECT o_orderkey, 'declared' AS kind, 'http://d/' || o_custkey AS url FROM orders UNION ALL SELECT o_orderkey, 'embedded', 'http://e/' || o_orderkey FROM orders WHERE o_orderstatus = 'P'
""")
def link_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    declared = orders.select("o_orderkey", F.concat(F.lit("http://d/"), "o_custkey").alias("url"))
    told = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit('{"a": ["see http://e/'), "o_orderkey", F.lit('."]}'))).otherwise('{"a": []}')
    return refs.link_evidence(declared, orders.select("o_orderkey", told.alias("doc")), "o_orderkey", "doc").select("o_orderkey", "kind", "url")


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE greatest(0.0, 100 - value - 20) END AS left_over, epoch(TIMESTAMP '2024-02-01') - epoch(ts) >= 86400 * 15 AS stalled, 100.0 * value / 1000 AS speedup FROM events
""")
def time_left_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.col("event_type") != "error"
    rest = metrics.unattributed(F.lit(100.0), F.when(known, F.col("value")), F.when(known, F.lit(20.0)))
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", rest.alias("left_over"), metrics.is_stalled(at, F.lit("2024-02-01 00:00:00").cast("timestamp"), 86400 * 15).alias("stalled"), metrics.speedup(F.col("value"), F.lit(100), F.lit(1000.0)).alias("speedup"))


@query("""
    SELECT source, s AS scenario, n AS records, CAST(n * unit * f AS DOUBLE) AS bytes
    FROM (SELECT source, sum(octet_length(encode(text))) AS unit FROM documents GROUP BY source), (VALUES ('low', 0.5), ('mid', 1.0), ('high', 2.5)) a(s, f), (VALUES (10), (100), (5000)) b(n)
""")
def size_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What so many copies of each source would take."""
    measured = metrics.size_report(table(spark, sf_dir, "documents"), "text", ["source"]).select("source", F.col("bytes").alias("unit"))
    return metrics.projections(measured, "unit", {"low": 0.5, "mid": 1.0, "high": 2.5}, [10, 100, 5000]).drop("unit")


@query("SELECT 'p_name' AS key, sum(length('{\"v\":\"' || p_name || '\"}')) AS bytes FROM part UNION ALL SELECT 'p_size', sum(length('{\"v\":' || p_size || '}')) FROM part")
def payload_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.key_sizes(table(spark, sf_dir, "part").select("p_name", "p_size"))


@query("SELECT o_orderstatus, round_even(least(100.0, 100.0 * sum(o_totalprice) / 20000000), 1) AS share, CAST(0 AS DOUBLE) AS of_nothing FROM orders GROUP BY o_orderstatus")
def clamped_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("s"))
    return g.select("o_orderstatus", values.percent(F.col("s"), F.lit(20000000)).alias("share"), values.percent(F.col("s"), F.lit(0)).alias("of_nothing"))


@query("SELECT c_custkey AS id, c_name AS title, lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS number, 'incidents/' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') || '/' AS path FROM customer WHERE c_nationkey BETWEEN 5 AND 9")
def record_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").where(F.col("c_nationkey").between(5, 9))
    return rows.select(*classify.summary_columns({"id": "c_custkey", "title": "c_name", "sequence": "c_nationkey"})).drop("sequence")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'first ' || o_orderkey WHEN o_orderstatus = 'O' THEN 'one' END AS title FROM orders")
def api_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    answer = F.when(s == "F", F.concat(F.lit(' [{"id": '), k, F.lit(', "title": "first '), k, F.lit('"}, {"id": 0, "title": "second"}]'))).when(s == "O", '{"id": 5, "title": "one"}').otherwise('{"title": "no id"}')
    return table(spark, sf_dir, "orders").select("o_orderkey", readers.api_payload(answer, "struct<id: bigint, title: string>")["title"].alias("title"))


@query("""
    WITH h AS (SELECT sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || '}') AS h FROM orders),
    p AS (SELECT count(*) AS n, sum(CAST('0x' || substr(h, 1, 16) AS UBIGINT)) AS a, sum(CAST('0x' || substr(h, 17, 16) AS UBIGINT)) AS b, sum(CAST('0x' || substr(h, 33, 16) AS UBIGINT)) AS c, sum(CAST('0x' || substr(h, 49, 16) AS UBIGINT)) AS d FROM h)
    SELECT o AS "order", sha256(concat_ws(':', n, a, b, c, d)) AS digest FROM p, (VALUES ('as stored'), ('backwards')) v(o)
""")
def worklist_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    one = refs.worklist_digest(rows).withColumn("order", F.lit("as stored"))
    return one.unionByName(refs.worklist_digest(rows.orderBy(F.desc("o_orderkey")).repartition(5)).withColumn("order", F.lit("backwards")))
