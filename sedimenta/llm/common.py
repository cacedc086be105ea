"""What the corpus operators share: the tables, the shared folder, and bounded Arrow batches."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch: with texts of some 100 KB a batch stays near 25 MB.
BATCH_ROWS = 256
#: Bytes of texts that are worked on as one block, where numbering words within a block saves work.
BLOCK_BYTES = 5_000_000
#: The six white-space bytes that the contracts name, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, as a single text may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for the jobs within: of one, where each row is megabytes."""
    bounded_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        bounded_batches(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where none is named, a local session gets a temporary one; a cluster can't share that."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='sedimenta-')}")
        found = context.getCheckpointDir()
    return found.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; it goes when the application ends."""
    path = f"{shared_dir(spark)}/sedimenta-{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def written(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean_up() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
                remove(spark, path)
        except Exception:  # the gateway may be gone already; the folder is only left over then
            return


def blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined up to a number of bytes."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def joined_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to a number of rows, for narrow tables."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null counts as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
