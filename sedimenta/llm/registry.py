"""The queries of the corpus operators, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import bpe, decontam, exact_dedup, fim, interleave, mixing, quality, search, secret_scan, simhash, token_store, warc, wrappers
from sedimenta.llm.common import table
from sedimenta.session import spread


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captures(spread(table(spark, sf_dir, "pages")))


def op3_interleaved_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave.media_features(spread(table(spark, sf_dir, "documents")))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.TokenStore.write(spread(table(spark, sf_dir, "documents")), public_tokenizers.path("word_bpe_49k.json")).verified()


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix().taken(spread(table(spark, sf_dir, "documents")))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spread(table(spark, sf_dir, "documents")))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op7_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extracted(spread(table(spark, sf_dir, "pages")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spread(table(spark, sf_dir, "documents")))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(spread(table(spark, sf_dir, "documents")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(spread(table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.Index.build(spread(table(spark, sf_dir, "documents"))).search(table(spark, sf_dir, "benchmark"), 10)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transformed(spread(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(), 256).alias("restored_sha256"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def page_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a sequence of texts and media: how many there are, and the texts in order."""
    found = interleave.sequences(spread(table(spark, sf_dir, "pages")), "page_id")
    texts = F.filter("elements", lambda e: e["kind"] == "text")
    return found.select("page_id", F.size("elements").alias("n_elements"), F.size(texts).alias("n_texts"), F.sha2(F.array_join(F.transform(texts, lambda e: e["text"]), "\n"), 256).alias("text_sha256"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_warc": op2_warc,
    "op3_interleaved_media": op3_interleaved_media,
    "op4_token_store": op4_token_store,
    "op5_mixing": op5_mixing,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_html_wrappers": op7_html_wrappers,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_ranked_search": op11_ranked_search,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_decontamination": op13_decontamination,
    "page_sequences": page_sequences,
}

ORACLES = {
    "op2_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS sha,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS keep_id
            FROM pages
        ), groups AS (
            SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(sha, CAST(5 * i + 1 AS INT), 5) AS INT)) AS twenty FROM p
        )
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(twenty, lambda v:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 15) % 32 + 1 AS INT), 1)
                   || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 10) % 32 + 1 AS INT), 1)
                   || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 5) % 32 + 1 AS INT), 1)
                   || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v % 32 + 1 AS INT), 1)), '') AS payload_digest,
               CASE WHEN page_id = keep_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = keep_id THEN NULL ELSE keep_id END AS refers_to
        FROM groups
    """,
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM d
        WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
    """,
    "op11_ranked_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents
        ), counts AS (SELECT doc_id, t, count(*) AS tf FROM terms GROUP BY ALL
        ), lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id
        ), corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM lengths
        ), dfs AS (SELECT t, count(*) AS df FROM counts GROUP BY t
        ), asked AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
        ), weights AS (SELECT item_id, t, count(*) AS qtf FROM asked GROUP BY ALL
        ), scores AS (
            SELECT item_id, doc_id, CAST(sum(qtf * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_words)))) AS BIGINT) AS score
            FROM weights JOIN dfs USING (t) JOIN counts USING (t) JOIN lengths USING (doc_id), corpus GROUP BY ALL
        ), ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scores WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 10
    """,
    "op12_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units, sha256('42:' || doc_id) AS h FROM documents
        ), h AS (
            SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
                        WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d
        ), parts AS (
            SELECT *, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(units[greatest(a, b) + 1:], '') AS suffix FROM h
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op13_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS gram
            FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, CAST(len(w) - least(10, len(w)) + 2 AS BIGINT))) AS s FROM b WHERE len(w) > 0)
        ), sizes AS (SELECT DISTINCT size FROM windows
        ), starts AS (SELECT doc_id, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS s FROM d, sizes
        ), found AS (SELECT doc_id, s, size, item_id FROM starts JOIN windows USING (size) WHERE array_to_string(w[s:s + size - 1], ' ') = gram
        ), hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM found) GROUP BY doc_id
        ), items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
}
