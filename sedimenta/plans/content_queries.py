"""Text, language, quality, duplicates, search and extraction, over documents, labels, conversations and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.bitfilter import KeyFilter
from sedimenta.files import written
from sedimenta.functions import fixed, text
from sedimenta.operators import classify, dedupe, extract, metrics, schedule, search
from sedimenta.plans.registry import heavy, query, table

_CLEAN = r"""
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace({c}, chr(160), ' '), '\r\n|[\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]', chr(10), 'g'),
        '[ \t]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))
"""
_DOCS = "d AS (SELECT *, " + _CLEAN.format(c="text") + " AS clean FROM documents)"


@query(f"WITH {_DOCS} SELECT doc_id, length(clean) AS n_clean, sha256(clean) AS clean_sha256 FROM d")
def clean_text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = text.clean_text("text")
    return heavy(spark, sf_dir, "documents").select("doc_id", F.length(clean).cast("bigint").alias("n_clean"), F.sha2(clean, 256).alias("clean_sha256"))


_SHARE = "length(regexp_replace(text, '[^{r}]', '', 'g')) / nullif(length(regexp_replace(text, '[^\\p{{L}}\\p{{Nl}}\\p{{No}}]', '', 'g')), 0)::DOUBLE"


@query(f"""
    WITH s AS (
        SELECT doc_id, lang, coalesce({_SHARE.format(r=chr(0x600) + "-" + chr(0x6FF) + chr(0x750) + "-" + chr(0x77F))}, 0) AS ar,
               coalesce({_SHARE.format(r=chr(0x590) + "-" + chr(0x5FF))}, 0) AS he, coalesce({_SHARE.format(r=chr(0x400) + "-" + chr(0x4FF))}, 0) AS ru,
               coalesce({_SHARE.format(r="A-Za-z")}, 0) AS la FROM documents
    ), c AS (SELECT doc_id, lang, CASE WHEN ar >= .35 THEN 'ar' WHEN he >= .35 THEN 'he' WHEN ru >= .35 THEN 'ru' WHEN la >= .7 THEN 'en' ELSE 'und' END AS by_script FROM s)
    SELECT doc_id, by_script, CASE WHEN lang IN ('ar', 'de', 'en', 'es', 'fa', 'fr', 'he', 'ku', 'ru', 'tr') THEN lang ELSE by_script END AS with_label FROM c
""")
def language_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy(spark, sf_dir, "documents").select("doc_id", text.detect_language("text").alias("by_script"), text.detect_language("text", "lang").alias("with_label"))


def _quality_sql(source: str, key: str) -> str:
    markers = " OR ".join("contains(low, '" + m.replace("'", "''") + "')" for m in fixed.SHELL_MARKERS)
    return f"""
        WITH d AS (SELECT {key}, {_CLEAN.format(c="coalesce(text, '')")} AS t FROM {source}),
        w AS (SELECT {key}, t, lower(t) AS low, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS words FROM d),
        r AS (
            SELECT {key}, length(t) < 40 AS short, ({markers}) AND length(t) < 1500 AS shell,
                   coalesce(len(words) >= 30 AND len(list_distinct(words)) / nullif(len(words), 0)::DOUBLE < .18, false) AS rep FROM w
        )
        SELECT {key}, NOT (short OR shell OR rep) AS accepted,
               greatest(0, 100 - CASE WHEN short THEN 55 ELSE 0 END - CASE WHEN shell THEN 70 ELSE 0 END - CASE WHEN rep THEN 45 ELSE 0 END) AS score,
               array_to_string(list_filter([CASE WHEN short THEN 'text_too_short' END, CASE WHEN shell THEN 'access_or_platform_shell' END, CASE WHEN rep THEN 'highly_repetitive_text' END], lambda x: x IS NOT NULL), '+') AS reasons
        FROM r
    """


def _quality(df: DataFrame, *keys: str) -> DataFrame:
    q = df.select(*keys, text.content_quality("text").alias("q"))
    return q.select(*keys, "q.accepted", "q.score", F.array_join("q.reasons", "+").alias("reasons"))


@query(_quality_sql("documents", "doc_id"))
def content_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality(heavy(spark, sf_dir, "documents"), "doc_id")


@query(_quality_sql("conversations", "conv_id, turn"))
def turn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality(heavy(spark, sf_dir, "conversations"), "conv_id", "turn")


@query("""
    WITH h AS (SELECT doc_id, sha256(text) AS h FROM documents), g AS (SELECT h, count(*) AS n FROM h GROUP BY h HAVING count(*) > 1)
    SELECT count(*) AS groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS participating_rows, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS redundant_rows FROM g
""")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_counts(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("h")), "h")


@query("""
    WITH h AS (SELECT doc_id, sha256(text) AS h FROM documents), g AS (SELECT *, count(*) OVER (PARTITION BY h) AS n, min(doc_id) OVER (PARTITION BY h) AS c FROM h)
    SELECT doc_id, CASE WHEN n > 1 THEN 'exact-content-' || substr(h, 1, 24) END AS duplicate_group, CASE WHEN n > 1 THEN c END AS canonical, CASE WHEN n > 1 THEN doc_id = c END AS is_canonical FROM g
""")
def dup_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return dedupe.duplicate_groups(rows, "h", "doc_id").select("doc_id", "duplicate_group", "canonical", "is_canonical")


@query()
def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = heavy(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.text_chunks("text", 7000)).alias("position", "chunk"))
    return rows.select("doc_id", "position", F.length("chunk").alias("n_chars"), F.sha2("chunk", 256).alias("sha256"))


@query("""
    WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS round FROM documents)
    SELECT doc_id, source AS bucket, round, row_number() OVER (ORDER BY round, source) AS position FROM r
""")
def fair_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    ordered = schedule.fair_order(rows, F.col("source"), [F.col("doc_id")])
    return schedule.pages(ordered, schedule.turn_columns()).select("doc_id", "bucket", "round", "position")


@query("SELECT source, count(*) AS n, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, CAST(round(avg(octet_length(encode(text))), 6) AS DOUBLE) AS mean, CAST(quantile_disc(octet_length(encode(text)), 0.9) AS BIGINT) AS p90 FROM documents GROUP BY source")
def size_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.size_report(table(spark, sf_dir, "documents"), "text", ["source"])
    return out.select("source", "n", "bytes", F.round("mean", 6).alias("mean"), F.col("p90").cast("bigint").alias("p90"))


@query("""
    WITH j AS (SELECT d.doc_id, d.lang, CAST(l.quality AS VARCHAR) AS quality, CAST(l.toxic AS VARCHAR) AS toxic FROM documents d JOIN labels l USING (doc_id)),
    e AS (SELECT 'lang' AS "group", lang AS status, doc_id FROM j UNION ALL SELECT 'quality', quality, doc_id FROM j UNION ALL SELECT 'toxic', toxic, doc_id FROM j)
    SELECT "group", status, doc_id AS id, count(*) OVER (PARTITION BY "group", status) AS n FROM e
""")
def status_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    found = search.status_index(rows, "doc_id", {"lang": "lang", "quality": "quality", "toxic": "toxic"})
    return found.join(search.status_counts(found), ["group", "status"])


@query("""
    SELECT CASE WHEN grouping(d.lang) = 0 THEN 'lang' WHEN grouping(d.source) = 0 THEN 'source' ELSE 'quality' END AS facet,
           coalesce(d.lang, d.source, CAST(l.quality AS VARCHAR)) AS value, count(*) AS n
    FROM documents d JOIN labels l USING (doc_id) GROUP BY GROUPING SETS ((d.lang), (d.source), (l.quality))
""")
def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return search.facets(rows, ["lang", "source", "quality"])


@query("""
    WITH h AS (SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'the') AND lang = 'en')
    SELECT doc_id, lang, (SELECT count(*) FROM h) AS total FROM h ORDER BY doc_id LIMIT 150
""")
def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.lower("text").alias("search_text"), F.array("lang").alias("statuses"))
    found = search.search(rows, search.matches("the", "search_text", "statuses", "en"), [F.col("doc_id")])
    return found.select("doc_id", "lang", "total")


@query()
def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = heavy(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"), F.col("lang").alias("status"), "text")
    sources = heavy(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), F.col("url").alias("title"), F.lit("page").alias("status"), F.lit("").alias("text"))
    return search.index_rows(records, sources)


_GRAMS = "SELECT DISTINCT {key}, unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(w[i:i + 7], ' '))) AS gram FROM (SELECT {key}, string_split_regex(trim(lower(text), ' ' || chr(9) || chr(10) || chr(13)), '[ \\t\\r\\n]+') AS w FROM {table})"


@query(f"""
    WITH d AS ({_GRAMS.format(key="doc_id", table="documents")}), b AS ({_GRAMS.format(key="item_id", table="benchmark")})
    SELECT d.doc_id, b.item_id, count(*) AS n FROM d JOIN b ON d.gram = b.gram GROUP BY d.doc_id, b.item_id
""")
def contamination_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of the benchmark within longer documents, by the eight-word runs that both have."""

    def grams(name: str, key: str) -> DataFrame:
        words = F.split(F.regexp_replace(F.lower("text"), r"^[ \t\r\n]+|[ \t\r\n]+$", ""), r"[ \t\r\n]+")
        runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - 7), lambda i: F.array_join(F.slice(w, i, F.lit(8)), " "))
        rows = heavy(spark, sf_dir, name).select(key, words.alias("w")).where(F.size("w") >= 8)
        return rows.select(key, F.explode(runs(F.col("w"))).alias("gram"))

    # Of the documents' runs only those that the benchmark may have are moved.
    wanted = written(grams("benchmark", "item_id").distinct(), "benchmark-runs")
    found = KeyFilter(wanted.select("gram").distinct(), "gram").probed(grams("documents", "doc_id"), "gram").where("_hit").select("doc_id", "gram")
    return found.distinct().join(wanted, "gram").groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n"))


@query()
def page_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every page by the best candidate, with its quality."""
    pages = heavy(spark, sf_dir, "pages")
    kind = classify.body_format(F.col("html").cast("binary"), F.lit("text/html"), "url")
    found = extract.extract_bodies(pages, "page_id", "html", F.lit("text/html; charset=utf-8"), kind)
    q = text.content_quality("text", "title")
    return found.select("page_id", "title", "method", "candidate_count", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"), q["accepted"].alias("accepted"), q["score"].alias("score"))


@query("""
    WITH g AS (SELECT conv_id, max(turn) AS t FROM conversations GROUP BY conv_id)
    SELECT c.conv_id, c.turn, c.role, length(c.text) AS n_chars, (SELECT count(*) FROM conversations o WHERE o.conv_id = c.conv_id AND o.role = c.role AND o.text <> c.text) AS n_other FROM conversations c JOIN g ON c.conv_id = g.conv_id AND c.turn = g.t
""")
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.operators.merge import latest

    rows = table(spark, sf_dir, "conversations")
    last = latest(rows, ["conv_id"], ["turn"])
    others = last.select("conv_id", "role", F.col("text").alias("_t")).join(rows.select("conv_id", "role", "text"), ["conv_id", "role"]).where("text != _t").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_other"))
    return last.join(others, "conv_id", "left").select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars"), F.coalesce("n_other", F.lit(0)).alias("n_other"))
