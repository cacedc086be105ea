"""Live operation on streams: counters, rates, the latest state of each item, change feeds, host circuits and recovery.

Event times are timestamps with a zone; a column without one is read as UTC.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sedimenta.session import checkpointed
from sedimenta.sources.keyed import KeyValueTable
from sedimenta.streaming.replay import ROCKSDB  # noqa: F401


def event_stream(spark: SparkSession, folder: str, like: DataFrame, files_per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder, so many at a time: that bounds what is in flight."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def with_watermark(events: DataFrame, at: str, late: str) -> DataFrame:
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)


def result_counts(events: DataFrame, host: str, kind: str) -> DataFrame:
    """Rows by host and class of result."""
    return events.groupBy(host, kind).agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(events: DataFrame, at: str, width: str, slide: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Rows in tumbling or sliding windows."""
    w = F.window(at, width, slide) if slide else F.window(at, width)
    return events.groupBy(w, *(by or [])).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *(by or []), "n")


def sessions(events: DataFrame, at: str, by: str, gap: str) -> DataFrame:
    """Runs of a key's events without a longer gap."""
    out = events.groupBy(F.session_window(at, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def joined_streams(left: DataFrame, right: DataFrame, key: str, at: str, within: str, late: str) -> DataFrame:
    """Events of both streams that share a key, the right one at or up to `within` after the left one; late bounds the state.

    Both have key and at; the other columns' names must differ.
    """
    a = with_watermark(left, at, late).withColumnRenamed(key, "_k").withColumnRenamed(at, "left_at")
    b = with_watermark(right, at, late).withColumnRenamed(at, "right_at")
    near = (F.col("right_at") >= F.col("left_at")) & (F.col("right_at") <= F.col("left_at") + F.expr(f"INTERVAL {within}"))
    return a.join(b, (F.col("_k") == F.col(key)) & near).drop("_k")


def running_totals(events: DataFrame, by: str, value: str) -> DataFrame:
    return events.groupBy(by).agg(F.count(value).alias("n"), F.sum(value).alias("total"))


def upsert_sink(table: KeyValueTable, name: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: each batch's latest row of a key goes into the table. A batch that is done again changes nothing."""
    return lambda batch, number: table.upsert(batch, (name, number))


def _in_order(rows: Iterator[Row]) -> list[Row]:
    """A key's rows of one batch by ms and seq. How many there are is bounded by what a batch may take (replay's rows_per_run)."""
    return sorted(rows, key=lambda r: (r.ms is None, r.ms, r.seq is None, r.seq))


class _Processor(StatefulProcessor):
    def close(self) -> None:
        pass


def _timed(events: DataFrame, at: str, *columns: str) -> DataFrame:
    """Columns of rows with a watermark, ms and us: their time since 1970 as numbers, which sessions in any zone agree on."""
    return with_watermark(events, at, "0 seconds").select(*columns, at, F.unix_millis(at).alias("ms"), F.unix_micros(at).alias("us"))


class ChangeFeed(_Processor):
    """A key's row when its signature changes, a heartbeat for each interval of quiet, and nothing after a terminal status.

    Rows tell their time; between batches a timer does, so a key that is never heard of again has heartbeats as well.
    """

    TERMINAL = ("completed", "completed_with_gaps", "completed_with_errors", "failed", "cancelled")
    ROW = Row("id", "ms", "kind", "status")

    def __init__(self, heartbeat_ms: int = 12_000):
        self.heartbeat = heartbeat_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "signature string, told bigint, terminal boolean")

    def _beats(self, key, signature: str, told: int, until: int) -> list[tuple]:
        """Heartbeats that are due up to a time."""
        return [(key[0], t, "heartbeat", signature) for t in range(told + self.heartbeat, until + 1, self.heartbeat)]

    def _keep(self, signature: str, told: int, terminal: bool, timer: int | None) -> None:
        """timer: the one that is set; a state's own time tells it, so timers needn't be listed."""
        due = None if terminal else told + self.heartbeat
        self.last.update((signature, told, terminal))
        if timer != due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        signature, told, terminal = self.last.get() or (None, None, False)
        timer = None if told is None or terminal else told + self.heartbeat
        for row in _in_order(rows):
            if terminal:
                break
            if told is not None:
                for beat in self._beats(key, signature, told, row.ms - 1):
                    told = beat[1]
                    yield self.ROW(*beat)
            if row.status != signature:
                signature, told, terminal = row.status, row.ms, row.status in self.TERMINAL
                yield self.ROW(key[0], told, "change", signature)
        self._keep(signature, told, terminal, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        signature, told, terminal = self.last.get()
        for beat in self._beats(key, signature, told, timerValues.getCurrentWatermarkInMs()):
            told = beat[1]
            yield self.ROW(*beat)
        self._keep(signature, told, terminal, None)  # Spark takes away the timer that is up


def change_feed(events: DataFrame, heartbeat_ms: int = 12_000) -> DataFrame:
    """id, ts, kind (change or heartbeat) and status; events has id, ts, status and seq, which orders rows of one time."""
    out = _timed(events, "ts", "id", "status", "seq").groupBy("id").transformWithState(ChangeFeed(heartbeat_ms), "id string, ms bigint, kind string, status string", "append", "EventTime")
    return out.select("id", F.timestamp_millis("ms").alias("ts"), "kind", "status")


class Coalescer(_Processor):
    """A key's changes in flushes: once so many different items wait, or the first has waited for an interval.

    The last change of an item wins. State holds the items that wait, fewer than a flush.
    """

    ROW = Row("id", "flush", "ms", "reason", "item", "status", "item_ms")

    def __init__(self, most: int, interval_ms: int):
        self.most, self.interval = most, interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "item string", "status string, ms bigint")
        self.since = handle.getValueState("since", "ms bigint, flushes int")

    def _flushed(self, key, held: dict, number: int, at: int, reason: str) -> Iterator[Row]:
        return (self.ROW(key[0], number, at, reason, item, status, ms) for item, (status, ms) in held.items())

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        first, number = self.since.get() or (-1, 0)
        held = {k[0]: tuple(v) for k, v in self.waiting.iterator()} if first >= 0 else {}
        timer = first + self.interval if held else None
        for row in _in_order(rows):
            if held and row.ms >= first + self.interval:
                yield from self._flushed(key, held, number, first + self.interval, "interval")
                held, number = {}, number + 1
            if not held:
                first = row.ms
            held[row.item] = (row.status, row.ms)
            if len(held) >= self.most:
                yield from self._flushed(key, held, number, row.ms, "size")
                held, number = {}, number + 1
        self.waiting.clear()
        for item, value in held.items():
            self.waiting.updateValue((item,), value)
        self.since.update((first, number))
        due = first + self.interval if held else None
        if timer != due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first, number = self.since.get()
        held = {k[0]: tuple(v) for k, v in self.waiting.iterator()}
        self.waiting.clear()
        self.since.update((-1, number + 1))
        yield from self._flushed(key, held, number, first + self.interval, "interval")


def coalesced(events: DataFrame, most: int = 32, interval_ms: int = 1000) -> DataFrame:
    """id, flush (numbered from 0), flushed_at, reason (size or interval), item, status and ts of every item flushed.

    events has id, item, status, ts and seq, which orders rows of one time.
    """
    rows = _timed(events, "ts", "id", "item", "status", "seq").groupBy("id")
    out = rows.transformWithState(Coalescer(most, interval_ms), "id string, flush int, ms bigint, reason string, item string, status string, item_ms bigint", "append", "EventTime")
    return out.select("id", "flush", F.timestamp_millis("ms").alias("flushed_at"), "reason", "item", "status", F.timestamp_millis("item_ms").alias("ts"))


class Circuit(_Processor):
    """A host's circuit: so many failures on end open it; after the cool-down one probe decides."""

    ROW = Row("host", "us", "seq", "decision", "state", "failures")

    def __init__(self, threshold: int = 3, cooldown_seconds: float = 60.0):
        self.threshold, self.cooldown = threshold, round(cooldown_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("circuit", "failures int, opened_at bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        failures, opened_at = self.state.get() or (0, -1)
        for row in _in_order(rows):
            if opened_at >= 0 and row.ms - opened_at < self.cooldown:
                yield self.ROW(key[0], row.us, row.seq, "skip", "open", failures)
                continue
            probe = opened_at >= 0
            if row.failed:
                failures += 1
                if probe or failures >= self.threshold:
                    opened_at = row.ms
            else:
                failures, opened_at = 0, -1
            yield self.ROW(key[0], row.us, row.seq, "probe" if probe else "allow", "open" if opened_at >= 0 else "closed", failures)
        self.state.update((failures, opened_at))


def circuits(attempts: DataFrame, threshold: int = 3, cooldown_seconds: float = 60.0) -> DataFrame:
    """What each attempt met; attempts has host, ts, failed and, where times may be equal, seq (a number)."""
    rows = attempts if "seq" in attempts.columns else attempts.withColumn("seq", F.lit(0))
    rows = rows.select("host", "failed", F.col("seq").cast("bigint").alias("seq"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    out = rows.groupBy("host").transformWithState(Circuit(threshold, cooldown_seconds), "host string, us bigint, seq bigint, decision string, state string, failures int", "append", "None")
    return out.select("host", F.timestamp_micros("us").alias("ts"), "seq", "decision", "state", "failures")


class NegativeCache(_Processor):
    """Misses that are remembered for a time, by the events' own clock; a timer forgets those of keys that aren't asked for again."""

    ROW = Row("host", "us", "seq", "was_known", "reason")

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.miss = handle.getValueState("miss", "reason string, until bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        reason, until = self.miss.get() or (None, -1)
        timer = until
        for row in _in_order(rows):
            known = row.ms < until
            yield self.ROW(key[0], row.us, row.seq, known, reason if known else None)
            if row.failed and not known:
                reason, until = row.reason, row.ms + self.ttl_ms
            elif not row.failed:
                reason, until = None, -1
        if until == timer:
            return
        if timer >= 0:
            self.handle.deleteTimer(timer)
        if until < 0:
            self.miss.clear()
        else:
            self.miss.update((reason, until))
            self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.miss.clear()
        return iter([])


def negative_cache(attempts: DataFrame, ttl_ms: int) -> DataFrame:
    """Whether each attempt met a remembered miss; attempts has host, ts, failed, reason and seq, which orders rows of one time."""
    rows = _timed(attempts.withColumn("seq", F.col("seq").cast("bigint")), "ts", "host", "failed", "reason", "seq").groupBy("host")
    out = rows.transformWithState(NegativeCache(ttl_ms), "host string, us bigint, seq bigint, was_known boolean, reason string", "append", "EventTime")
    return out.select("host", F.timestamp_micros("us").alias("ts"), "seq", "was_known", "reason")


class RecoveryQueue:
    """Deferred sources of one scope: what is pending, what was tried, and what came of it. State is written after each step."""

    SCHEMA = "source_id string, original_url string, host string, first_deferred_at timestamp, last_attempt_at timestamp, recovery_attempts int, last_status string, reason string"

    def __init__(self, spark: SparkSession, scope: str, pending: DataFrame | None = None):
        self.spark, self.scope = spark, scope
        self.pending = spark.createDataFrame([], self.SCHEMA) if pending is None else pending
        self.resolved = spark.createDataFrame([], self.SCHEMA)

    def defer(self, rows: DataFrame, scope: str, now: Column) -> None:
        """Adds source_id, original_url, host and reason; a source that is pending keeps its first time and attempts."""
        if scope != self.scope:
            raise ValueError(f"the queue is for {self.scope}, not {scope}")
        new = rows.join(self.pending.select("source_id"), "source_id", "left_anti")
        new = new.select("source_id", "original_url", "host", now.alias("first_deferred_at"), F.lit(None).cast("timestamp").alias("last_attempt_at"), F.lit(0).alias("recovery_attempts"), F.lit("recovery_deferred").alias("last_status"), "reason")
        self.pending = checkpointed(self.pending.unionByName(new))

    def note(self, attempts: DataFrame, now: Column) -> None:
        """Counts an attempt for each source_id, with its status."""
        a = attempts.select(F.col("source_id").alias("_s"), F.col("status").alias("_status"))
        out = self.pending.join(a, F.col("source_id") == F.col("_s"), "left")
        hit = F.col("_s").isNotNull()
        out = out.withColumn("recovery_attempts", F.col("recovery_attempts") + hit.cast("int")).withColumn("last_attempt_at", F.when(hit, now).otherwise(F.col("last_attempt_at"))).withColumn("last_status", F.when(hit, F.col("_status")).otherwise(F.col("last_status"))).drop("_s", "_status")
        self.pending = checkpointed(out)

    def resolve(self, ids: DataFrame) -> None:
        self.resolved = checkpointed(self.resolved.unionByName(self.pending.join(ids.select("source_id"), "source_id", "left_semi")))
        self.pending = checkpointed(self.pending.join(ids.select("source_id"), "source_id", "left_anti"))

    def select(self, limit: int) -> DataFrame:
        from sedimenta.operators.schedule import select_recovery

        return select_recovery(self.pending, F.col("host"), limit)

    def summary(self) -> DataFrame:
        """Pending sources by host, most first."""
        return self.pending.groupBy("host").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc("host"))


#: A run's states, and where each may go. Fixed values.
TRANSITIONS = {
    "CREATED": ("ANALYZING", "QUEUED", "CANCELLED"),
    "ANALYZING": ("PILOT_RUNNING", "READY", "FAILED", "CANCELLED"),
    "PILOT_RUNNING": ("PILOT_REVIEW", "PAUSED", "FAILED", "CANCELLED"),
    "PILOT_REVIEW": ("READY", "QUEUED", "CANCELLED"),
    "READY": ("QUEUED", "CANCELLED"),
    "QUEUED": ("RUNNING", "PAUSED", "CANCELLED"),
    "RUNNING": ("PAUSED", "RETRYING", "VALIDATING", "COMPLETED", "COMPLETED_WITH_GAPS", "FAILED", "CANCELLED"),
    "PAUSED": ("QUEUED", "RUNNING", "CANCELLED"),
    "RETRYING": ("RUNNING", "COMPLETED", "COMPLETED_WITH_GAPS", "FAILED", "CANCELLED"),
    "VALIDATING": ("BUILDING_RELEASE", "COMPLETED", "COMPLETED_WITH_GAPS", "FAILED"),
    "BUILDING_RELEASE": ("RELEASE_VALIDATION", "FAILED"),
    "RELEASE_VALIDATION": ("PUBLISHED", "FAILED"),
}


def move(state: str, to: str) -> str:
    if to not in TRANSITIONS.get(state, ()):
        raise ValueError(f"a run can't go from {state} to {to}")
    return to


def remaining(targets: DataFrame, done: DataFrame, key: str, retry: bool = False, kept: tuple[str, ...] = ("NORMALIZED", "PARSED")) -> DataFrame:
    """Targets that a resumed run still has to do; a retry redoes those whose status isn't a kept one."""
    finished = done.where(F.col("status").isin(*kept)) if retry else done
    return targets.join(finished.select(key), key, "left_anti")
