"""Exact duplicates are labelled, never merged; plus set operations and evidence that spreads within a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.values import is_missing
from sedimenta.operators.schedule import numbered


def duplicate_groups(df: DataFrame, content_hash: str, key: str, prefix: str = "exact-content") -> DataFrame:
    """df with duplicate_group, duplicate_size, canonical (the smallest key) and is_canonical; null where a hash is alone or missing.

    Sizes come from a partial aggregation and a join, so a hash that a third of the rows share is no single task's.
    """
    known = df.where(~is_missing(content_hash))
    groups = known.groupBy(F.col(content_hash).alias("_h")).agg(F.count(F.lit(1)).alias("duplicate_size"), F.min(key).alias("canonical")).where("duplicate_size > 1")
    out = df.join(groups, F.col(content_hash) == F.col("_h"), "left")
    name = F.when(F.col("_h").isNotNull(), F.concat(F.lit(f"{prefix}-"), F.substring("_h", 1, 24)))
    return out.withColumn("duplicate_group", name).withColumn("is_canonical", F.col(key) == F.col("canonical")).drop("_h")


def duplicate_counts(df: DataFrame, content_hash: str) -> DataFrame:
    """groups, rows in them, and rows beyond each group's first."""
    sizes = df.where(~is_missing(content_hash)).groupBy(content_hash).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return sizes.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("participating_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("redundant_rows"),
    )


def repeated_occurrence(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """df with occurrence (1, 2, ... in order) and is_repeat, within equal keys."""
    return numbered(df, keys, order, "occurrence").withColumn("is_repeat", F.col("occurrence") > 1)


def append_unique(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def spread_evidence(df: DataFrame, batch: str, status: str) -> DataFrame:
    """df with batch_blocked: some row of the batch was answered 403; skipped rows take that as theirs."""
    blocked = df.groupBy(batch).agg(F.bool_or(F.coalesce(F.col(status) == 403, F.lit(False))).alias("batch_blocked"))
    out = df.join(blocked, batch)
    return out.withColumn("effective_status", F.when(F.col(status).isNull() & F.col("batch_blocked"), 403).otherwise(F.col(status)))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key and side (missing in b, or in a)."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(y.join(x, key, "left_anti").withColumn("side", F.lit("unexpected")))


def same_set(a: DataFrame, b: DataFrame, key: str) -> bool:
    return set_difference(a, b, key).isEmpty()


def url_observations(historical: DataFrame, normalized: DataFrame, url: str, external_id: str, norm: Column) -> DataFrame:
    """All historical rows, and the normalised ones that don't mirror one of them (same URL and id); repeats count."""
    h = historical.withColumn("_url", norm)
    n = normalized.withColumn("_url", norm)
    mirrored = h.select(F.col("_url").alias("_u"), F.col(external_id).alias("_e")).distinct()
    extra = n.join(mirrored, (F.col("_url") == F.col("_u")) & F.col(external_id).eqNullSafe(F.col("_e")), "left_anti")
    return h.unionByName(extra, allowMissingColumns=True).withColumnRenamed("_url", f"normalized_{url}")
