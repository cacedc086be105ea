"""Streams over the event log, each run to its end, broken off and started again on the way, and held against batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import files
from sedimenta.plans.registry import query, table
from sedimenta.sources.keyed import KeyValueTable
from sedimenta.streaming import live
from sedimenta.streaming.replay import replay

DAY_MS = 86_400_000
#: Of a stream of few keys: a task orders the rows of a key that a run brings.
ROWS_PER_RUN = 2_000_000


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")


def _end(log: DataFrame) -> DataFrame:
    """A row of no user, two days behind the last one."""
    last = log.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    return last.select(*[F.col("ts") if c == "ts" else F.lit("none" if c == "event_type" else -1).cast(t).alias(c) for c, t in log.dtypes])


def _items(read, item: str = "user_id", by: str = "event_type") -> DataFrame:
    return read().select(F.col(by).cast("string").alias("id"), F.col(item).cast("string").alias("item"), F.concat("event_type", F.lit("-"), F.col("event_id")).alias("status"), "ts", F.col("event_id").alias("seq"))


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_result_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most two files a batch, so that the run is many batches."""
    log = _log(spark, sf_dir).repartition(4)
    found = replay(log, "ts", lambda read: live.result_counts(read(), "user_id", "event_type"), "update", ["user_id", "event_type"], files_per_batch=2)
    return found.select("user_id", "event_type", "n")


@query("SELECT event_type, count(value) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replay(_log(spark, sf_dir), "ts", lambda read: live.running_totals(read(), "event_type", "value"), "update", ["event_type"])
    return found.select("event_type", "n", F.round("total", 4).alias("total"))


@query("""
    SELECT w AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS w FROM events) GROUP BY ALL
""")
def stream_sliding_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last twelve hours, every six."""
    found = replay(_log(spark, sf_dir), "ts", lambda read: live.windowed_counts(live.with_watermark(read(), "ts", "2 days"), "ts", "12 hours", "6 hours", ["event_type"]), "update", ["start", "event_type"])
    return found.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""
    WITH g AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS end, count(*) AS n FROM n GROUP BY user_id, k
""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    found = replay(log, "ts", lambda read: live.sessions(live.with_watermark(read(), "ts", "1 hour"), "ts", "user_id", "6 hours"), closing=_end(log))
    return found.where("user_id >= 0").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("""
    SELECT l.event_id AS click_id, r.event_id AS purchase_id, l.user_id FROM events l JOIN events r ON l.user_id = r.user_id AND r.ts BETWEEN l.ts AND l.ts + INTERVAL 12 HOUR WHERE l.event_type = 'click' AND r.event_type = 'purchase'
""")
def stream_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(read) -> DataFrame:
        of = lambda kind, name: read().where(F.col("event_type") == kind).select("user_id", "ts", F.col("event_id").alias(name))
        return live.joined_streams(of("click", "click_id"), of("purchase", "purchase_id"), "user_id", "ts", "12 hours", "1 day")

    return replay(_log(spark, sf_dir), "ts", joined).select("click_id", "purchase_id", "user_id")


@query("""
    WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS host, event_id, epoch_us(ts) // 1000 AS ms, value > 50 AS failed, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS n FROM events),
    s AS (
        SELECT host, event_id, n, CASE WHEN failed THEN 1 ELSE 0 END AS failures, CAST(-1 AS BIGINT) AS opened, 'allow' AS decision FROM e WHERE n = 1
        UNION ALL
        SELECT e.host, e.event_id, e.n,
               CASE WHEN s.opened >= 0 AND e.ms - s.opened < 86400000 THEN s.failures WHEN e.failed THEN s.failures + 1 ELSE 0 END,
               CASE WHEN s.opened >= 0 AND e.ms - s.opened < 86400000 THEN s.opened WHEN NOT e.failed THEN -1 WHEN s.opened >= 0 OR s.failures >= 2 THEN e.ms ELSE s.opened END,
               CASE WHEN s.opened >= 0 AND e.ms - s.opened < 86400000 THEN 'skip' WHEN s.opened >= 0 THEN 'probe' ELSE 'allow' END
        FROM s JOIN e ON e.host = s.host AND e.n = s.n + 1
    )
    SELECT host, event_id, decision, CASE WHEN opened >= 0 THEN 'open' ELSE 'closed' END AS state, failures FROM s
""")
def stream_circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three failures on end open a user's circuit for a day."""

    def decided(read) -> DataFrame:
        return live.circuits(read().select(F.col("user_id").cast("string").alias("host"), "ts", (F.col("value") > 50).alias("failed"), F.col("event_id").alias("seq")), 3, 86_400.0)

    return replay(_log(spark, sf_dir), "ts", decided).select("host", F.col("seq").alias("event_id"), "decision", "state", "failures")


@query("""
    WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS host, event_id, epoch_us(ts) // 1000 AS ms, value > 50 AS failed, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS n FROM events),
    s AS (
        SELECT host, event_id, n, false AS was_known, CASE WHEN failed THEN ms + 43200000 ELSE -1 END AS until FROM e WHERE n = 1
        UNION ALL
        SELECT e.host, e.event_id, e.n, e.ms < s.until, CASE WHEN NOT e.failed THEN -1 WHEN e.ms < s.until THEN s.until ELSE e.ms + 43200000 END FROM s JOIN e ON e.host = s.host AND e.n = s.n + 1
    )
    SELECT host, event_id, was_known FROM s
""")
def stream_negative_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's failure is remembered for twelve hours, or until a success."""

    def known(read) -> DataFrame:
        return live.negative_cache(read().select(F.col("user_id").cast("string").alias("host"), "ts", (F.col("value") > 50).alias("failed"), F.lit("high").alias("reason"), F.col("event_id").alias("seq")), DAY_MS // 2)

    return replay(_log(spark, sf_dir), "ts", known).select("host", F.col("seq").alias("event_id"), "was_known")


@query("""
    WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms, CASE WHEN value >= 99 THEN 'completed' ELSE event_type END AS status FROM events),
    o AS (SELECT *, coalesce(sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM e),
    l AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS old FROM o WHERE ended = 0),
    c AS (SELECT user_id, ms, status, lead(ms) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS later FROM l WHERE status IS DISTINCT FROM old),
    beats AS (SELECT user_id, status, unnest(range(ms + 21600000, coalesce(later, (SELECT max(ms) + 172800001 FROM e)), 21600000)) AS ms FROM c WHERE status <> 'completed')
    SELECT CAST(user_id AS VARCHAR) AS id, make_timestamp_ms(ms) AS ts, 'change' AS kind, status FROM c UNION ALL SELECT CAST(user_id AS VARCHAR), make_timestamp_ms(ms), 'heartbeat', status FROM beats
""")
def stream_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A heartbeat for every six hours without a change, by the clock of events; users stay silent for days."""
    log = _log(spark, sf_dir)

    def feed(read) -> DataFrame:
        status = F.when(F.col("value") >= 99, "completed").otherwise(F.col("event_type"))
        return live.change_feed(read().select(F.col("user_id").cast("string").alias("id"), "ts", status.alias("status"), F.col("event_id").alias("seq")), DAY_MS // 4)

    return replay(log, "ts", feed, closing=_end(log)).where("id <> '-1'").select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), "kind", "status")


@query("""
    WITH RECURSIVE e AS (SELECT event_type AS id, CAST(user_id AS VARCHAR) AS item, event_type || '-' || event_id AS status, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts) // 1000, event_id) AS n FROM events),
    s AS (
        SELECT id, n, ms, item, status, ms AS since, 0 AS flush, [item] AS held FROM e WHERE n = 1
        UNION ALL
        SELECT e.id, e.n, e.ms, e.item, e.status,
               CASE WHEN len(s.held) >= 32 OR e.ms >= s.since + 43200000 THEN e.ms ELSE s.since END,
               CASE WHEN len(s.held) >= 32 OR e.ms >= s.since + 43200000 THEN s.flush + 1 ELSE s.flush END,
               CASE WHEN len(s.held) >= 32 OR e.ms >= s.since + 43200000 THEN [e.item] WHEN list_contains(s.held, e.item) THEN s.held ELSE list_append(s.held, e.item) END
        FROM s JOIN e ON e.id = s.id AND e.n = s.n + 1
    ), f AS (SELECT id, flush, min(since) AS since, max(ms) AS until, max(len(held)) AS n_items FROM s GROUP BY id, flush
    ), i AS (SELECT id, flush, item, arg_max(status, n) AS status FROM s GROUP BY id, flush, item)
    SELECT id, flush, CASE WHEN n_items >= 32 THEN 'size' ELSE 'interval' END AS reason, make_timestamp_ms(CASE WHEN n_items >= 32 THEN until ELSE since + 43200000 END) AS flushed_at, item, status FROM i JOIN f USING (id, flush)
""")
def stream_flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of users by type of event, written once 32 users wait or the first has waited for twelve hours."""
    log = _log(spark, sf_dir)
    found = replay(log, "ts", lambda read: live.coalesced(_items(read), 32, DAY_MS // 2), closing=_end(log), rows_per_run=ROWS_PER_RUN).where("id <> 'none'")
    return found.select("id", "flush", "reason", F.col("flushed_at").cast("timestamp_ntz").alias("flushed_at"), "item", "status")


_LATEST = "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id"
_ENTRY = "user_id bigint, event_id bigint, event_type string, value double"


@query(_LATEST)
def stream_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches go into a keyed table; the one that is broken off was committed there, and changes nothing when it is done again."""
    store = KeyValueTable(spark, files.shared_folder(spark, "keyed"), _ENTRY, "user_id", "event_id", buckets=8, most_deltas=2)
    replay(_log(spark, sf_dir), "ts", lambda read: read().select("user_id", "event_id", "event_type", "value"), runs=4, sink=live.upsert_sink(store, "events"))
    return store.read()


@query(_LATEST)
def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four upserts, the newest rows first; old rows that come late don't replace what is there."""
    store = KeyValueTable(spark, files.shared_folder(spark, "keyed"), _ENTRY, "user_id", "event_id", buckets=8, most_deltas=2)
    log = _log(spark, sf_dir)
    for k in (3, 1, 0, 2):
        store.upsert(log.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k))
    return store.read()
