"""References, keys, reconciliation, order and merging, over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.values import percent
from sedimenta.operators import audit, classify, dedupe, merge, metrics, refs, schedule, search
from sedimenta.plans.registry import query, table


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER w AS occurrence, row_number() OVER w > 1 AS is_repeat
    FROM lineitem WINDOW w AS (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey, l_linenumber)
""")
def duplicate_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    found = dedupe.repeated_occurrence(rows, ["l_suppkey", "l_partkey"], [F.col("l_orderkey"), F.col("l_linenumber")])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "occurrence", "is_repeat")


@query("""
    SELECT 'lineitem_without_order' AS rule, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'order_without_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'customer_without_order', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'lineitem_without_part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
""")
def reference_fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    checks = [
        ("lineitem_without_order", audit.dangling(t("lineitem"), t("orders"), "l_orderkey", "o_orderkey")),
        ("order_without_customer", audit.dangling(t("orders"), t("customer"), "o_custkey", "c_custkey")),
        ("customer_without_order", audit.dangling(t("customer"), t("orders"), "c_custkey", "o_custkey")),
        ("lineitem_without_part", audit.dangling(t("lineitem"), t("part"), "l_partkey", "p_partkey")),
    ]
    parts = [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, rows in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""
    WITH t AS (SELECT (SELECT count(*) FROM lineitem) AS total, CAST((SELECT sum(n) FROM (SELECT count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderstatus)) AS BIGINT) AS terms)
    SELECT 'lines_by_status' AS "check", total, terms, total = terms AS balanced FROM t
""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    known = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return audit.reconciled("lines_by_status", lines.agg(F.count(F.lit(1)).alias("n")), audit.counts_by(known, "o_orderstatus"))


@query("""
    SELECT unnest(['orders', 'customers_with_orders', 'repeat_orders', 'urgent', 'open', 'over_200k']) AS metric,
           unnest([count(*), count(DISTINCT o_custkey), count(*) - count(DISTINCT o_custkey), count(*) FILTER (o_orderpriority LIKE '1-%'), count(*) FILTER (o_orderstatus = 'O'), count(*) FILTER (o_totalprice > 200000)])::DOUBLE AS value
    FROM orders
""")
def audit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, who = F.count(F.lit(1)), F.count_distinct("o_custkey")
    return audit.metrics(
        table(spark, sf_dir, "orders"),
        {"orders": n, "customers_with_orders": who, "repeat_orders": n - who, "urgent": F.count_if(F.col("o_orderpriority").like("1-%")), "open": F.count_if(F.col("o_orderstatus") == "O"), "over_200k": F.count_if(F.col("o_totalprice") > 200000)},
    )


@query("""
    WITH d AS (SELECT unnest(['F', 'O', 'P', 'X']) AS value)
    SELECT d.value, count(o.o_orderkey) AS n FROM d LEFT JOIN orders o ON o.o_orderstatus = d.value GROUP BY d.value
""")
def fixed_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.fixed_domain_counts(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O", "P", "X"])


@query("WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position FROM orders) SELECT o_orderkey, position, CAST(ceil(position / 100.0) AS BIGINT) AS page FROM r")
def pagination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return schedule.pages(rows, [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "position", "page")


@query("SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER w AS previous, lead(o_orderkey) OVER w AS next FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def prev_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return search.neighbours(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], "o_orderkey").drop("o_orderdate")


@query("""
    WITH o AS (SELECT o_custkey, o_orderkey, epoch(o_orderdate) AS first, epoch(o_orderdate) + 86400 * 30 AS last FROM orders)
    SELECT a.o_custkey, a.o_orderkey AS left_job, b.o_orderkey AS right_job FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.first <= b.last AND a.last >= b.first
""")
def job_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp").cast("double")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", at.alias("first"), (at + 86400 * 30).alias("last"))
    return metrics.job_overlaps(rows, "o_custkey", "o_orderkey", "first", "last")


_POINTS = "p AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 30 + (c_acctbal + 1000) / 1000 END AS lat, CASE WHEN c_custkey % 19 = 0 THEN 4239.00416 ELSE 33 + c_nationkey / 2.0 END AS lon FROM customer)"
_CLASS = "CASE WHEN lat IS NULL OR lon IS NULL THEN 'missing' WHEN NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) THEN 'malformed' WHEN NOT (lat BETWEEN 31 AND 38 AND lon BETWEEN 34 AND 43) THEN 'outside_accepted_range' ELSE 'drawable' END"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat = F.when(F.col("c_custkey") % 17 != 0, F.lit(30) + (F.col("c_acctbal") + 1000) / 1000)
    lon = F.when(F.col("c_custkey") % 19 == 0, 4239.00416).otherwise(F.lit(33) + F.col("c_nationkey") / 2.0)
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), lat.alias("lat"), lon.alias("lon"))


@query(f"""
    WITH {_POINTS}, c AS (SELECT {_CLASS} AS k FROM p)
    SELECT count(*) AS total, count(*) FILTER (k = 'drawable') AS drawable, count(*) FILTER (k = 'missing') AS missing, count(*) FILTER (k = 'malformed') AS malformed,
           count(*) FILTER (k = 'outside_accepted_range') AS outside_accepted_range, round_even(100.0 * count(*) FILTER (k = 'drawable') / count(*), 4) AS coverage_pct FROM c
""")
def map_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.map_coverage(_points(spark, sf_dir), "lat", "lon")


@query(f"""
    WITH {_POINTS}, r AS (
        SELECT id, list_concat(CASE WHEN lat IS NULL THEN ['missing_latitude'] WHEN NOT lat BETWEEN -90 AND 90 THEN ['invalid_latitude'] ELSE [] END,
                               CASE WHEN lon IS NULL THEN ['missing_longitude'] WHEN NOT lon BETWEEN -180 AND 180 THEN ['invalid_longitude'] ELSE [] END) AS f, lat, lon FROM p
    ), e AS (SELECT unnest(CASE WHEN len(f) = 0 AND NOT (lat BETWEEN 31 AND 38 AND lon BETWEEN 34 AND 43) THEN ['outside_expected_region'] ELSE f END) AS reason FROM r)
    SELECT reason, count(*) AS n FROM e GROUP BY reason
""")
def coordinate_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.coordinate_faults(_points(spark, sf_dir), "lat", "lon")


@query("""
    WITH v AS (
        SELECT o_custkey AS record_id, 'priority' AS field, o_orderpriority AS value, CASE o_orderkey % 3 WHEN 0 THEN 'api' WHEN 1 THEN 'live' ELSE 'archive' END AS origin, CASE o_orderkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS pr, o_orderkey AS seen FROM orders
    ), b AS (SELECT record_id, field, arg_max(value, pr * 1000000000000 + seen) AS value, arg_max(origin, pr * 1000000000000 + seen) AS origin, count(*) AS n_values FROM v GROUP BY ALL)
    SELECT b.record_id, b.field, b.value, b.origin, b.n_values, (SELECT count(*) FROM v WHERE v.record_id = b.record_id AND lower(v.value) <> lower(b.value)) AS n_conflicts FROM b
""")
def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 3
    origin = F.when(k == 0, "api").when(k == 1, "live").otherwise("archive")
    values = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record_id"), F.lit("priority").alias("field"), F.col("o_orderpriority").alias("value"), origin.alias("origin"), F.col("o_orderkey").alias("captured_at"))
    chosen, conflicts = merge.merge_fields(values)
    n = conflicts.groupBy("record_id", "field").agg(F.count(F.lit(1)).alias("n_conflicts"))
    return chosen.join(n, ["record_id", "field"], "left").select("record_id", "field", "value", "origin", "n_values", F.coalesce("n_conflicts", F.lit(0)).alias("n_conflicts"))


@query("""
    WITH s AS (SELECT s_suppkey AS id, s_name AS tag FROM supplier), t AS (SELECT c_custkey AS id, c_name AS tag FROM customer)
    SELECT coalesce(s.id, t.id) AS id, coalesce(s.tag, t.tag) AS label, array_to_string(list_filter([s.tag, t.tag], lambda x: x IS NOT NULL), '|') AS tags FROM s FULL JOIN t ON s.id = t.id
""")
def merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"), F.array("s_name").alias("tags"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label"), F.array("c_name").alias("tags"))
    out = merge.merge_state(a, b, "id", ["label"], ["tags"])
    return out.select("id", "label", F.array_join("tags", "|").alias("tags"))


@query("""
    WITH r AS (SELECT l_orderkey AS record_id, 'u' || l_partkey AS raw_url, l_linenumber * 10000000 + l_partkey AS ord FROM lineitem),
    h AS (SELECT * FROM r WHERE ord < 30000000), p AS (SELECT * FROM r WHERE ord BETWEEN 20000000 AND 49999999), m AS (SELECT * FROM r WHERE ord >= 40000000),
    a0 AS (SELECT record_id, 'historical' AS origin, row_number() OVER (PARTITION BY record_id ORDER BY ord) AS occurrence, raw_url FROM h),
    a AS (SELECT *, row_number() OVER (PARTITION BY record_id, raw_url ORDER BY occurrence) > 1 AS is_repeat FROM a0),
    b0 AS (SELECT record_id, raw_url, min(ord) AS ord FROM p WHERE (record_id, raw_url) NOT IN (SELECT record_id, raw_url FROM a) GROUP BY ALL),
    b AS (SELECT record_id, 'provenance' AS origin, row_number() OVER (PARTITION BY record_id ORDER BY ord) AS occurrence, raw_url, false AS is_repeat FROM b0),
    c0 AS (SELECT record_id, raw_url, min(ord) AS ord FROM m WHERE (record_id, raw_url) NOT IN (SELECT record_id, raw_url FROM a UNION ALL SELECT record_id, raw_url FROM b) GROUP BY ALL),
    c AS (SELECT record_id, 'embedded' AS origin, row_number() OVER (PARTITION BY record_id ORDER BY ord) AS occurrence, raw_url, false AS is_repeat FROM c0),
    x AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
    SELECT *, 'reference-' || substr(sha256(record_id || chr(10) || origin || chr(10) || occurrence || chr(10) || raw_url), 1, 24) AS source_reference_id FROM x
""")
def staged_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.concat(F.lit("u"), F.col("l_partkey")).alias("raw_url"), (F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")).alias("ord"))
    return refs.collect_references(rows.where("ord < 30000000"), rows.where("ord between 20000000 and 49999999"), rows.where("ord >= 40000000"))


@query("""
    SELECT o.o_orderkey, count(l.l_orderkey) AS n, array_to_string(list(l.l_partkey ORDER BY l.l_linenumber, l.l_partkey) FILTER (l.l_partkey IS NOT NULL), ',') AS parts FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey
""")
def nested_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    out = refs.nest_references(table(spark, sf_dir, "orders").select("o_orderkey"), lines, "o_orderkey", ["l_partkey"], "l_linenumber")
    parts = F.array_join(F.transform("references", lambda r: r["l_partkey"].cast("string")), ",")
    return out.select("o_orderkey", F.size("references").cast("bigint").alias("n"), F.when(F.size("references") > 0, parts).alias("parts"))


@query("SELECT o_orderkey FROM orders o WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def select_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus != 'F'").withColumnRenamed("o_custkey", "key")
    done = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("key"))
    return schedule.select_work(orders, done, "key", F.col("o_orderstatus") == "P", F.col("o_orderkey")).select("o_orderkey")


@query("""
    WITH k AS (SELECT DISTINCT l_orderkey AS s FROM lineitem WHERE l_orderkey > 0), g AS (SELECT s, coalesce(lag(s) OVER (ORDER BY s), 0) AS b FROM k)
    SELECT b + 1 AS first_missing, s - 1 AS last_missing FROM g WHERE s - b > 1
""")
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.contiguity(table(spark, sf_dir, "lineitem").where("l_orderkey > 0"), "l_orderkey")


@query("""
    WITH o AS (SELECT l_orderkey AS k, min(l_linestatus) AS s FROM lineitem GROUP BY l_orderkey)
    SELECT u.o_orderkey AS key, u.o_orderstatus AS status, o.s AS outcome FROM orders u LEFT JOIN o ON u.o_orderkey = o.k WHERE o.k IS NULL OR u.o_orderstatus IS DISTINCT FROM o.s
""")
def outcome_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    outcomes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.min("l_linestatus").alias("status"))
    return audit.mismatched(live, outcomes, "key", "status")


@query("""
    WITH s AS (SELECT p_partkey, p_size, CASE p_size % 6 WHEN 0 THEN 200 WHEN 1 THEN 403 WHEN 2 THEN 404 WHEN 3 THEN 503 WHEN 4 THEN 418 END AS status, CASE WHEN p_size % 6 = 5 THEN 'TimeoutError: timed out' END AS error FROM part)
    SELECT CASE WHEN status BETWEEN 200 AND 299 THEN 'FETCHED' WHEN status IN (401, 403, 429, 451) THEN 'BLOCKED' WHEN status IN (404, 410) THEN 'DEAD' WHEN status >= 500 OR contains(lower(coalesce(error, '')), 'timed out') THEN 'RETRYABLE_FAILURE' ELSE 'FINAL_FAILURE' END AS result, count(*) AS n,
           round_even(100.0 * count(*) / (SELECT count(*) FROM part), 1) AS pct FROM s GROUP BY 1
""")
def http_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size") % 6
    rows = table(spark, sf_dir, "part").select(F.when(k == 0, 200).when(k == 1, 403).when(k == 2, 404).when(k == 3, 503).when(k == 4, 418).alias("status"), F.when(k == 5, "TimeoutError: timed out").alias("error"))
    counts = rows.groupBy(classify.http_result("status", "error").alias("result")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), rows.agg(F.count(F.lit(1)).alias("t")).scalar()))
