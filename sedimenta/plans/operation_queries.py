"""Operational metrics over the event log. `now` is the log's last moment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.operators import metrics
from sedimenta.operators.scan import with_percentiles
from sedimenta.plans.registry import query, table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))


@query("SELECT event_type, round(quantile_cont(value, 0.5), 3) AS value_p50, round(quantile_cont(value, 0.9), 3) AS value_p90 FROM events GROUP BY event_type")
def timing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.linear_percentiles(table(spark, sf_dir, "events"), ["value"], ["event_type"])


@query("SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_disc(value, 0.9), 6) AS p90 FROM events GROUP BY event_type")
def nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.timing_report(table(spark, sf_dir, "events"), "value", ["event_type"])
    return out.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "p90")])


@query("""
    WITH m AS (SELECT max(ts) AS now, epoch(max(ts)) - epoch(min(ts)) AS active FROM events),
    c AS (SELECT any_value(active) AS active, count(*) FILTER (ts >= now - INTERVAL 30 SECOND) AS count_30, count(*) FILTER (ts >= now - INTERVAL 60 SECOND) AS count_60, count(*) FILTER (ts >= now - INTERVAL 300 SECOND) AS count_300 FROM events, m),
    r AS (SELECT *, 60.0 * count_30 / greatest(.001, least(30, active)) AS rate_30, 60.0 * count_60 / greatest(.001, least(60, active)) AS rate_60, 60.0 * count_300 / greatest(.001, least(300, active)) AS rate_300 FROM c),
    f AS (SELECT *, CASE WHEN count_60 >= 3 THEN rate_60 WHEN count_300 > 0 THEN rate_300 ELSE rate_30 END AS forecast FROM r)
    SELECT count_30, count_60, count_300, round(rate_30, 6) AS rate_30, round(rate_60, 6) AS rate_60, round(rate_300, 6) AS rate_300, round(forecast, 6) AS forecast_rate, round(CASE WHEN forecast > 0 THEN 60.0 * 1000 / forecast END, 6) AS eta_seconds FROM f
""")
def rolling_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    span = events.agg(F.max("at").alias("now"), (F.max("at").cast("double") - F.min("at").cast("double")).alias("active"))
    rates = metrics.rolling_rates(events, "at", span.select("now").scalar(), span.select("active").scalar())
    out = metrics.with_eta(rates, F.lit(1000), F.lit(True))
    return out.select("count_30", "count_60", "count_300", *[F.round(c, 6).alias(c) for c in ("rate_30", "rate_60", "rate_300", "forecast_rate", "eta_seconds")])


@query("""
    SELECT event_id, (SELECT count(*) FROM events o WHERE o.user_id = e.user_id AND o.ts BETWEEN e.ts - INTERVAL 3600 SECOND AND e.ts) AS last_3600s FROM events e
""")
def rolling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rolling_count(_events(spark, sf_dir), "user_id", "at", 3600).select("event_id", "last_3600s")


_CLASSES = {"successful": ["purchase"], "deferred": ["view", "click"], "failed": ["error", "logout"]}


@query("""
    SELECT user_id AS host, count(*) AS total, count(*) FILTER (event_type = 'purchase') AS successful, count(*) FILTER (event_type IN ('view', 'click')) AS deferred, count(*) FILTER (event_type IN ('error', 'logout')) AS failed,
           round(quantile_cont(value, 0.5) FILTER (value >= 0), 6) AS value_p50 FROM events GROUP BY user_id ORDER BY total DESC, host LIMIT 8
""")
def host_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("user_id", "host")
    return metrics.host_rollup(events, "host", "event_type", _CLASSES, ["value"]).withColumn("value_p50", F.round("value_p50", 6))


@query("""
    WITH h AS (SELECT user_id AS host, count(*) AS total, quantile_cont(value, 0.5) AS q, quantile_disc(value, 0.9) AS p90 FROM events GROUP BY user_id)
    SELECT host, round(q, 6) AS waiting, 'queue' AS reason FROM h ORDER BY q DESC, p90 DESC, total DESC, host DESC LIMIT 1
""")
def bottleneck(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumnRenamed("user_id", "host")
    hosts = with_percentiles(rows.groupBy("host").agg(F.count(F.lit(1)).alias("total")), rows, ["host"], {"q": (F.col("value"), 0.5, "linear"), "p90": (F.col("value"), 0.9, "rank")}).withColumn("p", F.lit(0.0))
    return metrics.bottleneck(hosts, "q", "p", "p90").withColumn("waiting", F.round("waiting", 6))


@query("""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n FROM events)
    SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM r WHERE n <= 500 GROUP BY event_type
""")
def recent_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.recent(table(spark, sf_dir, "events"), "event_type", "ts", "event_id")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.window("at", "1 day")
    return _events(spark, sf_dir).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""
    WITH g AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS s FROM events),
    n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS start, count(*) AS n FROM n GROUP BY user_id, k
""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("user_id").orderBy("ts")
    before = F.lag("ts").over(by)
    rows = table(spark, sf_dir, "events").withColumn("s", F.when(before.isNull() | (F.col("ts") > before + F.expr("INTERVAL 6 HOURS")), 1).otherwise(0))
    rows = rows.withColumn("k", F.sum("s").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy("user_id", "k").agg(F.min("ts").alias("start"), F.count(F.lit(1)).alias("n")).drop("k")


@query("""
    WITH a AS (SELECT user_id AS host, event_id, value > 50 AS failed FROM events), r AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY host ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS k FROM a)
    SELECT host, count(*) AS failures, min(event_id) AS since, max(event_id) AS until, count(*) >= 3 AS opens FROM r WHERE failed GROUP BY host, k
""")
def circuit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("host"), "event_id", (F.col("value") > 50).alias("failed"))
    return metrics.circuit_runs(rows, "host", "event_id", F.col("failed"), 3)


@query("""
    WITH c AS (SELECT user_id, event_type AS new, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS old FROM events),
    d AS (SELECT new AS status, 1 AS delta FROM c WHERE new IS DISTINCT FROM old UNION ALL SELECT old, -1 FROM c WHERE new IS DISTINCT FROM old AND old IS NOT NULL)
    SELECT status, CAST(sum(delta) AS BIGINT) AS n FROM d GROUP BY status
""")
def counter_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counter_deltas(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.operators.merge import latest

    return latest(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])


@query("SELECT CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY 1")
def props_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("""
    WITH t AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events),
    s AS (SELECT *, max(event_id - n * 2.0) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS peak FROM t)
    SELECT event_id, CAST(round(greatest(event_id, peak + n * 2.0), 6) AS DOUBLE) AS start FROM s
""")
def paced_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.operators.schedule import gcra

    rows = table(spark, sf_dir, "events").select("user_id", "event_id")
    return gcra(rows, "user_id", "event_id", 0.5, 1).select("event_id", F.round(F.col("start").cast("double"), 6).alias("start"))
