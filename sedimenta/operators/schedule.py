"""Fair orders of work: round r takes each bucket's r-th row, so a rare host isn't behind a frequent one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.scan import paced
from sedimenta.session import checkpointed


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str, ranges: int | None = None) -> DataFrame:
    """df with each row's number, from 1, within its group.

    A group may hold a third of all rows, or there may be no groups at all: rows are dealt to ranges of group and order,
    numbered within each, and then moved by their group's rows in the ranges before. Only counts meet in one place.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in by]
    ranged = checkpointed(df.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_range").alias("_r"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))
    meet = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        meet &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    out = ranged.withColumn("_own", own).join(before, meet).withColumn(name, F.col("_before") + F.col("_own"))
    return out.drop("_range", "_r", "_before", "_own", *[f"_by{i}" for i in range(len(by))])


def fair_order(df: DataFrame, bucket: Column, order: list[Column], by_size: bool = False) -> DataFrame:
    """df with bucket and round (and bucket_size): ordered by turn_columns(), rows alternate between buckets.

    Buckets take turns by name, or by (initial size, name) with by_size. Sorting is left to the reader: a total order over
    a corpus is a range sort, never a single task.
    """
    out = df.withColumn("bucket", F.coalesce(F.nullif(bucket, F.lit("")), F.lit("_unknown")))
    out = numbered(out, ["bucket"], order, "round")
    if by_size:
        sizes = out.groupBy("bucket").agg(F.count(F.lit(1)).alias("bucket_size"))
        out = out.join(sizes, "bucket")
    return out


def turn_columns(by_size: bool = False) -> list[Column]:
    return [F.col("round"), *([F.col("bucket_size")] if by_size else []), F.col("bucket")]


def route(kind: Column, host: Column) -> Column:
    """Two platforms have routes of their own; others are routed by host."""
    return F.when(kind == "public_facebook_post", "social:facebook_embed").when(kind == "public_x_post", "social:x_oembed").otherwise(F.concat(F.lit("general:"), host))


def select_work(candidates: DataFrame, completed: DataFrame, key: str, partial: Column, order: Column, start_after: object = None, limit: int | None = None) -> DataFrame:
    """What is not completed yet, partly done rows first."""
    out = candidates.join(completed.select(key), key, "left_anti")
    if start_after is not None:
        out = out.where(order > F.lit(start_after))
    out = out.orderBy(partial.desc(), order)
    return out if limit is None else out.limit(limit)


def select_recovery(pending: DataFrame, host: Column, limit: int) -> DataFrame:
    """The rows least tried and longest deferred, then fair between hosts."""
    order = [F.col("recovery_attempts"), F.col("first_deferred_at"), F.col("source_id")]
    return fair_order(pending, host, order).orderBy(*turn_columns()).limit(limit)


def pages(df: DataFrame, order: list[Column], size: int = 100, ranges: int | None = None) -> DataFrame:
    """df with position (from 1, in order) and page."""
    out = numbered(df, [], order, "position", ranges)
    return out.withColumn("page", F.ceil(F.col("position") / size))


def gcra(df: DataFrame, key: str, arrival: str, rate: float, burst: int) -> DataFrame:
    """df with start: when each request of a key may begin under a rate with a burst (the generic cell rate algorithm)."""
    return paced(df, [key], [F.col(arrival)], F.col(arrival), 1.0 / rate, burst)
