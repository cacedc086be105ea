"""Merging what several origins say about a record, with provenance kept and conflicts listed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions import fixed
from sedimenta.functions.text import same_value
from sedimenta.functions.values import case, is_missing


def priority_of(origin: Column) -> Column:
    return case(*[(origin == name, rank) for name, rank in fixed.PRIORITY_OF_ORIGIN.items()], otherwise=-1)


def merge_fields(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The value of each field, and the conflicts.

    values has record_id, field, value, origin and captured_at. The origin of highest priority wins, the latest of equals;
    missing values say nothing. Every other value that isn't the same is a conflict, and nothing is lost.
    """
    known = values.where(~is_missing("value")).withColumn("priority", priority_of(F.col("origin")))
    rank = F.struct("priority", "captured_at", "origin", "value")
    best = known.groupBy("record_id", "field").agg(F.max(rank).alias("b"), F.count(F.lit(1)).alias("n_values"))
    chosen = best.select("record_id", "field", F.col("b.value").alias("value"), F.col("b.origin").alias("origin"), F.col("b.captured_at").alias("captured_at"), "n_values")
    others = known.join(chosen.select("record_id", "field", F.col("value").alias("preferred_value"), F.col("origin").alias("preferred_source")), ["record_id", "field"])
    conflicts = others.where(~same_value("value", "preferred_value"))
    conflicts = conflicts.select("record_id", "field", "preferred_value", "preferred_source", F.col("value").alias("other_value"), F.col("origin").alias("other_source"), "captured_at")
    return chosen, conflicts


def apply_verified(old: Column, old_source: Column, new: Column, new_source: Column) -> Column:
    """value, provenance and conflict of one field when a verified value comes: it replaces the old one, also its provenance."""
    present = ~is_missing(new)
    differs = present & ~is_missing(old) & ~same_value(old, new)
    conflict = F.when(differs, F.struct(new.alias("preferred_value"), new_source.alias("preferred_source"), old.alias("other_value"), old_source.alias("other_source")))
    return F.struct(F.when(present, new).otherwise(old).alias("value"), F.when(present, new_source).otherwise(old_source).alias("provenance"), conflict.alias("conflict"))


def merge_state(previous: DataFrame, current: DataFrame, key: str, scalars: list[str], arrays: list[str]) -> DataFrame:
    """Full outer: a present scalar of the previous state stays, arrays are ordered unions."""
    p, c = previous.alias("p"), current.alias("c")
    out = p.join(c, F.col(f"p.{key}") == F.col(f"c.{key}"), "full_outer")
    keep = lambda s: F.coalesce(F.when(~is_missing(F.col(f"p.{s}")), F.col(f"p.{s}")), F.col(f"c.{s}")).alias(s)
    empty = F.array().cast("array<string>")
    union = lambda a: F.array_distinct(F.concat(F.coalesce(F.col(f"p.{a}"), empty), F.coalesce(F.col(f"c.{a}"), empty))).alias(a)
    return out.select(F.coalesce(F.col(f"p.{key}"), F.col(f"c.{key}")).alias(key), *[keep(s) for s in scalars], *[union(a) for a in arrays])


def promote(old_text: Column, old_accepted: Column, old_score: Column, new_text: Column, new_score: Column, kind: Column) -> Column:
    """promoted and review: whether a new text takes a preserved one's place, and whether a refused variant needs a look."""
    old_length, new_length = F.length(F.coalesce(old_text, F.lit(""))), F.length(F.coalesce(new_text, F.lit("")))
    has_new = ~is_missing(new_text)
    longer = ~kind.startswith("public_") & (new_length >= F.greatest(F.lit(400), F.floor(old_length * 1.5)))
    take = has_new & (is_missing(old_text) | ~F.coalesce(old_accepted, F.lit(False)) | ((new_score > old_score) & (new_length >= old_length)) | longer)
    return F.struct(take.alias("promoted"), (has_new & ~take & ~(new_text == old_text)).alias("review"))


def admit_to_cache(text: Column, content_hash: Column, resolved: Column, score: Column, status: Column, old_has_text: Column, old_score: Column, old_status: Column) -> Column:
    """Whether an entry may be written over the cached one (or none, as nulls)."""
    has_text = ~is_missing(text) & (F.sha2(text, 256) == content_hash) & resolved
    held = F.coalesce(old_has_text, F.lit(False))
    worse = held & (~has_text | (F.coalesce(old_score, F.lit(0)) > F.coalesce(score, F.lit(0))) | ((old_status == "successful") & (status == "successful_partial")))
    return ~(resolved & ~has_text) & ~F.coalesce(worse, F.lit(False))


def first_accepted(attempts: DataFrame, key: str, order: str, accepted: Column) -> DataFrame:
    """The first attempt of each key that was accepted; keys without one are deferred."""
    out = attempts.groupBy(key).agg(
        F.min(F.when(accepted, F.struct(order, "route"))).alias("hit"),
        F.count(F.lit(1)).alias("attempts"),
    )
    return out.select(key, "attempts", F.col("hit.route").alias("route"), F.when(F.col("hit").isNull(), "recovery_deferred").otherwise("successful").alias("status"))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, whole, by one aggregation with partial results."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_l")).select(*keys, *[F.col(f"_l.{c}").alias(c) for c in rest])


def upsert(state: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """state with changes; the latest row of a key wins."""
    return latest(state.unionByName(changes), keys, order)


def undo_login_walls(sources: DataFrame, variants: str, is_wall) -> DataFrame:
    """Variants that are login pages go; a source that has none left goes back to unresolved."""
    kept = F.filter(F.col(variants), lambda v: ~is_wall(v["text"]))
    out = sources.withColumn("_kept", kept)
    corrected = (F.size("_kept") < F.size(variants)) & (F.size("_kept") == 0)
    return out.withColumn("retrieval_status", F.when(corrected, "login_required").otherwise(F.col("retrieval_status"))).withColumn(variants, F.col("_kept")).drop("_kept")


def last_in_run(attempts: DataFrame, key: str, run: str, order: str) -> DataFrame:
    """Each key's latest attempt within a run."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    return attempts.where(F.col("run_id") == run).withColumn("_n", n).where("_n = 1").drop("_n")
