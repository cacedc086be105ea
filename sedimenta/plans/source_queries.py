"""Sources, sinks and SQL functions: what is written from a given table and read back, and what SQL calls by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import files
from sedimenta.functions import tables
from sedimenta.operators import extract, spatial, trigrams
from sedimenta.plans.registry import heavy, query, table
from sedimenta.sources import archives, release

#: The blocks of the given pages: their inline tags are a and b, and what stands aside is in nav and footer. As in HTML, the character
#: references that pages have hold without a semicolon too, which a page that is cut off may lack.
_BLOCKS = r"""
    p AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<head>.*</head>|<!--.*?-->', '', 'g'), '</?b>|</a>', '', 'g'), '<a [^>]*>', chr(1), 'g') AS h FROM pages),
    s AS (SELECT page_id, unnest(regexp_extract_all(h, '<(/?[a-z0-9]+)[^>]*>([^<]*)', 1)) AS before, unnest(regexp_extract_all(h, '<(/?[a-z0-9]+)[^>]*>([^<]*)', 2)) AS raw, unnest(range(1, len(regexp_extract_all(h, '<(/?[a-z0-9]+)[^>]*>([^<]*)')) + 1)) AS k FROM p),
    t AS (SELECT page_id, k, before, contains(raw, chr(1)) AS linked, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(raw, chr(1), ''), '&quot;?', '"', 'g'), '&middot;?', '·', 'g'), '&copy;?', '©', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM s),
    b AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY k) AS n, before, linked, text, len(string_split(text, ' ')) AS words FROM t WHERE text <> '')
"""


@query("SELECT page_id, length(html) AS n_chars, sha256(html) AS html_sha256 FROM pages")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a member of archives of half a megabyte, read back by spans of members."""
    archives.register(spark)
    folder = files.shared_folder(spark, "archives")
    pages = table(spark, sf_dir, "pages").select(F.concat("page_id", F.lit(".html")).alias("member"), "html")
    archives.write_archives(pages, "member", "html", folder, 500_000).write.format("noop").mode("overwrite").save()
    rows = spark.read.format("zip_members").option("path", folder).option("pattern", r"\.html$").option("spanBytes", 100_000).load()
    text = F.decode("content", "UTF-8")
    return rows.select(F.regexp_extract("member", r"^(\d+)", 1).cast("bigint").alias("page_id"), F.length(text).cast("bigint").alias("n_chars"), F.sha2("content", 256).alias("html_sha256"))


@query("SELECT page_id, octet_length(encode(html)) AS size FROM pages")
def zip_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives that come in two lots are a stream; the second run goes on behind the last name of the first."""
    archives.register(spark)
    folder, out, state = (files.shared_folder(spark, f"zip-{x}") for x in ("in", "out", "state"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("member"), "html")
    for lot, half in (("a", F.col("page_id") % 2 == 0), ("b", F.col("page_id") % 2 == 1)):
        archives.write_archives(pages.where(half), "member", "html", folder, 500_000, lot).write.format("noop").mode("overwrite").save()
        rows = spark.readStream.format("zip_members").option("path", folder).load()
        run = rows.select(F.col("member").cast("bigint").alias("page_id"), "size").writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        run.awaitTermination()
    return spark.read.schema("page_id bigint, size bigint").parquet(out)


@query("SELECT event_id, '$.k' AS path, json_extract_string(props, '$.k') AS value FROM events UNION ALL SELECT event_id, '$.in[0].k', event_type FROM events WHERE event_type <> 'error'")
def sql_json_under(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table function, lateral over the rows of a query in Spark SQL."""
    tables.register(spark)
    events = table(spark, sf_dir, "events")
    made = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.when(F.col("event_type") != "error", F.concat(F.lit(', "in": [{"k": "'), "event_type", F.lit('"}], "other": 1}'))).otherwise("}"))
    return spark.sql("SELECT event_id, path, value FROM {docs}, LATERAL json_under(doc, 'k')", docs=events.select("event_id", made.alias("doc")))


@query(f"WITH {_BLOCKS} SELECT page_id, count(*) AS n_blocks, sum(length(text)) AS n_chars, sum(CASE WHEN linked THEN length(text) ELSE 0 END) AS link_chars FROM b GROUP BY page_id")
def sql_page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.register(spark)
    sql = "SELECT page_id, count(*) AS n_blocks, sum(length(text)) AS n_chars, sum(link_chars) AS link_chars FROM {pages}, LATERAL page_blocks(html) GROUP BY page_id"
    return spark.sql(sql, pages=heavy(spark, sf_dir, "pages"))


@query("""
    WITH f AS (SELECT source, doc_id, n_chars > 2000 AS long FROM documents), g AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - row_number() OVER (PARTITION BY source, long ORDER BY doc_id) AS island FROM f),
    r AS (SELECT source, max(n) AS longest FROM (SELECT source, count(*) AS n FROM g WHERE long GROUP BY source, island) GROUP BY source)
    SELECT source, CAST(quantile_disc(n_chars, 0.9) AS DOUBLE) AS p90, coalesce(any_value(longest), 0) AS longest FROM documents LEFT JOIN r USING (source) GROUP BY source
""")
def sql_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates of our own, called by name; Spark doesn't mix them with built-in ones in one grouping."""
    tables.register(spark)
    return spark.sql("SELECT source, nearest_rank(n_chars, 0.9D) AS p90, longest_run(n_chars > 2000, doc_id) AS longest FROM {docs} GROUP BY source", docs=table(spark, sf_dir, "documents"))


@query(rf"""
    WITH {_BLOCKS},
    c AS (SELECT page_id, max(n) FILTER (linked) AS nav_end, max(n) AS last_block FROM b GROUP BY page_id),
    w AS (SELECT b.page_id, n, text, CASE WHEN linked OR before = 'footer' THEN -words WHEN before = 'h1' THEN words ELSE words - 12 END AS weight FROM b),
    q AS (SELECT *, sum(weight) OVER (PARTITION BY page_id ORDER BY n) AS total FROM w),
    m AS (SELECT *, least(0, coalesce(min(total) OVER (PARTITION BY page_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS least FROM q),
    e AS (SELECT page_id, max(total - least) AS best FROM m GROUP BY page_id),
    r AS (SELECT m.page_id, max(n) AS last, arg_max(least, n) AS least FROM m JOIN e ON m.page_id = e.page_id AND total - least = best AND best > 0 GROUP BY m.page_id),
    f AS (SELECT r.page_id, r.last, CASE WHEN r.least = 0 THEN 0 ELSE (SELECT min(n) FROM q WHERE q.page_id = r.page_id AND q.total = r.least) END AS first FROM r)
    SELECT f.page_id, CAST(first AS INT) AS first, CAST(last AS INT) AS last, sum(length(text)) + count(*) - 1 AS n_chars, sha256(string_agg(text, chr(10) ORDER BY n)) AS text_sha256
    FROM f JOIN b ON b.page_id = f.page_id AND n > first AND n <= last GROUP BY f.page_id, first, last
""")
def main_text_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of blocks with the most text of its own, on every page."""
    found = extract.main_texts(heavy(spark, sf_dir, "pages"), "page_id").where("last > first")
    return found.select("page_id", "first", "last", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query("""
    WITH p AS (SELECT c_custkey AS id, c_acctbal / 10 AS x, (c_custkey * 37) % 1000 AS y FROM customer), m AS (SELECT s_suppkey AS id, s_acctbal / 10 AS x, (s_suppkey * 91) % 1000 AS y FROM supplier),
    d AS (SELECT p.id, m.id AS marker_id, sqrt(power(p.x - m.x, 2) + power(p.y - m.y, 2)) AS distance FROM p, m)
    SELECT id, arg_min(marker_id, (distance, marker_id)) AS marker_id, round(min(distance), 6) AS distance FROM d WHERE distance <= 60 GROUP BY id
""")
def nearest_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest supplier of every customer within reach, on a plane of balances and numbers."""
    place = lambda name, k, v, f: table(spark, sf_dir, name).select(F.col(k).alias("id"), (F.col(v) / 10).alias("x"), (F.col(k) * f % 1000).alias("y"))
    return spatial.nearest(place("customer", "c_custkey", "c_acctbal", 37), place("supplier", "s_suppkey", "s_acctbal", 91), 60.0, 4).withColumn("distance", F.round("distance", 6))


#: Frequent, rare, of two lines, of two bytes, in no text.
NEEDLES = ("thention", "ción as", ".\n", "ß", "eau", "no such words here")


@query("SELECT n AS needle, doc_id FROM documents, (VALUES " + ", ".join("('" + n.replace("\n", "' || chr(10) || '") + "')" for n in NEEDLES) + ") v(n) WHERE contains(text, n)")
def trigram_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = trigrams.TrigramIndex.build(heavy(spark, sf_dir, "documents"), "doc_id", "text")
    out = None
    for needle in NEEDLES:
        hits = index.search(needle).select(F.lit(needle).alias("needle"), F.col("key").alias("doc_id"))
        out = hits if out is None else out.unionByName(hits)
    return out


@query("SELECT 'documents' AS name, count(*) AS n, 0 AS problems, 'r2' AS current FROM documents UNION ALL SELECT 'pages', count(*), 0, 'r2' FROM pages UNION ALL SELECT 'labels', count(*), 0, 'r2' FROM labels")
def published_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release of three tables: built, published after another, a third refused by its health check, and read back."""
    store = release.ReleaseStore(spark, files.shared_folder(spark, "releases"))
    tables_of = {name: table(spark, sf_dir, name) for name in ("documents", "pages", "labels")}
    filled = lambda held: [name for name, df in held.items() if df.isEmpty()]
    store.build("r1", {"labels": tables_of["labels"]}, filled)
    store.build("r2", tables_of, filled)
    store.publish("r1", lambda held: True)
    store.publish("r2", lambda held: set(held) == set(tables_of))
    store.build("r3", {"labels": tables_of["labels"]}, filled)
    store.publish("r3", lambda held: "documents" in held)
    problems = store.problems(store.current).agg(F.count(F.lit(1)).cast("int").alias("n"))
    counts = None
    for name in tables_of:
        rows = store.read(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts.withColumn("problems", problems.scalar()).withColumn("current", F.lit(store.current))
