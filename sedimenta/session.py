"""Session defaults used by the tests, the bench and ad-hoc runs; a cluster's own settings win."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import files

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | None = None, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    cpus = cpus or os.cpu_count() or 1
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", memory)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.shuffle.partitions", shuffle_partitions).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: what reads it twice reads the same rows in the same partitions.

    The folder is in spark.checkpoint.dir; a temporary one only where none is named, as in tests.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(files.shared_folder(spark, "checkpoints"))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """A table dealt evenly where it has fewer partitions than there are cores, or one with over twice its share of rows; any other as it is.

    A row group is one task, however costly its rows and in however many spans its file is read: all but one of them are empty.
    Rows are counted only where files are read in spans, without reading a column. Tables of many row groups aren't shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts < cores:
        return df.repartition(cores)
    if len(df.inputFiles()) >= parts:
        return df
    most, rows = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.sum("count")).first()
    return df if most is None or most * cores <= 2 * rows else df.repartition(parts)


#: Rows that a task takes in the mean at most, where it sorts them.
ROWS_A_TASK = 500_000


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """df with the rows of a key in one partition; a table of more rows has more partitions, which aren't joined up again.

    Rows are counted first, without the columns that the count doesn't need.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK)), *keys)
