"""Streams that are run to their end over a stored log, stopped and started again on the way, and read back.

The log is dealt to slices by time, each slice is a run of the stream: it takes what has come, stops, and the next run goes on
from the checkpoint. One run is broken off after a batch was written and before it was committed, so that the batch is done
again. Each batch overwrites its own folder; what is read back is every batch once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from sedimenta import files
from sedimenta.operators.merge import latest

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Takes a function that gives a new stream of the log's rows, and gives the stream that is run.
Stream = Callable[[Callable[[], DataFrame]], DataFrame]


class BrokenOff(Exception):
    """Stands for a driver that is lost between the writing of a batch and its commit."""


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """State in RocksDB, in so many partitions (a checkpoint keeps them): as many as there are cores."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def slices(log: DataFrame, at: str, n: int) -> list[Column]:
    """Conditions that deal a log to n spans of time of one length."""
    low, high = log.agg(F.min(F.unix_micros(F.col(at).cast("timestamp"))), F.max(F.unix_micros(F.col(at).cast("timestamp")))).first()
    if low is None:
        return [F.lit(True)]
    edges = [(low + (high - low) * k // n) // 1000 * 1000 for k in range(1, n)]  # whole milliseconds, as watermarks are
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    bounds = [None, *edges, None]
    return [(F.lit(True) if a is None else micros >= a) & (F.lit(True) if b is None else micros < b) for a, b in zip(bounds, bounds[1:], strict=False)]


def replay(
    log: DataFrame,
    at: str,
    stream: Stream,
    mode: str = "append",
    keys: list[str] | None = None,
    runs: int = 2,
    files_per_batch: int | None = None,
    breaks_in: int | None = 1,
    closing: DataFrame | None = None,
    sink: Callable[[DataFrame, int], None] | None = None,
    rows_per_run: int | None = None,
) -> DataFrame | None:
    """All rows that the stream gives over the log, with their batch; in update mode the last of each of keys.

    Rows of a run come in one batch, or files_per_batch files at a time; time never goes back between runs. closing: a row behind
    the log's end, which moves the watermark past what waits for it. rows_per_run: how many rows a run takes in the mean at most, for
    streams of few keys, whose processors order a key's rows of one batch; a longer log has more runs. sink: what takes the batches instead; nothing is read back then.
    """
    spark = log.sparkSession
    source, out, checkpoint = (files.shared_folder(spark, f"stream-{x}") for x in ("in", "out", "state"))
    empty = log.limit(0)
    empty.write.parquet(source)
    broken: list[int] = []
    shape: list = []

    def read() -> DataFrame:
        reader = spark.readStream.schema(log.schema)
        return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(source)

    def take(batch: DataFrame, number: int) -> None:
        shape[:] = [batch.schema]
        if sink is None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        else:
            sink(batch, number)
        if run == breaks_in and not broken:
            broken.append(number)
            raise BrokenOff(f"batch {number}")

    def once() -> None:
        with state_settings(spark):
            query = stream(read).writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(take).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            query.stop()

    if rows_per_run:
        runs = max(runs, -(-log.count() // rows_per_run))
    spans = slices(log, at, runs)
    parts = [log.where(c) for c in spans]
    if rows_per_run and len(spans) > 2:  # dealt in one pass, or each run would read the whole log
        dealt = files.shared_folder(spark, "stream-dealt")
        span = F.when(F.lit(False), 0)
        for k, c in enumerate(spans):
            span = span.when(c, k)
        log.withColumn("_span", F.coalesce(span, F.lit(-1))).write.partitionBy("_span").parquet(dealt)
        parts = [spark.read.schema(log.schema).parquet(f"{dealt}/_span={k}") if files.exists(spark, f"{dealt}/_span={k}") else empty for k in range(len(spans))]
    for run, part in enumerate([*parts, *([closing] if closing is not None else [])]):
        part.write.mode("append").parquet(source)
        try:
            once()
        except StreamingQueryException:
            if not broken or run != breaks_in:
                raise
            once()
    if sink is not None:
        return None
    found = spark.read.schema(shape[0].add("batch", IntegerType())).option("basePath", out).parquet(f"{out}/batch=*")
    return latest(found, keys, ["batch"]) if keys else found
