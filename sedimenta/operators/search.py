"""The search index, its queries and facets. Texts and queries go through one fold, so that what matches is what is meant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.text import search_text, snippet
from sedimenta.functions.values import ColumnLike, col
from sedimenta.operators.scan import neighbours

__all__ = ["neighbours"]


def index_rows(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents of both kinds: id, kind, title, status, search_text and snippet.

    Both have id, title, status and text.
    """
    rows = records.withColumn("kind", F.lit("record")).unionByName(sources.withColumn("kind", F.lit("source")), allowMissingColumns=True)
    return rows.select("id", "kind", "title", "status", search_text("id", "title", "text").alias("search_text"), snippet("text").alias("snippet"))


def matches(query: str, text: ColumnLike, statuses: ColumnLike | None = None, status: str = "", coordinate: ColumnLike | None = None, coordinate_is: str = "", date: ColumnLike | None = None, date_prefix: str = "") -> Column:
    """All filters that are set must hold. query is folded by the caller, with the fold of the index."""
    out = F.contains(col(text), F.lit(query)) if query else F.lit(True)
    if status and statuses is not None:
        out &= F.array_contains(col(statuses), status)
    if coordinate_is and coordinate is not None:
        out &= col(coordinate) == coordinate_is
    if date_prefix and date is not None:
        out &= F.coalesce(col(date), F.lit("")).startswith(date_prefix)
    return out


def search(index: DataFrame, condition: Column, order: list[Column], cap: int = 150) -> DataFrame:
    """The first hits in order, each with the number of all hits."""
    hits = index.where(condition)
    total = hits.agg(F.count(F.lit(1)).alias("total"))
    return hits.orderBy(*order).limit(cap).withColumn("total", total.scalar())


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of each value of several columns, in one pass."""
    view = df.select(*columns)
    name = F.expr("CASE " + " ".join(f"WHEN grouping({c}) = 0 THEN '{c}'" for c in columns) + " END")
    out = view.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"), name.alias("facet"))
    return out.select("facet", F.coalesce(*[F.col(c).cast("string") for c in columns]).alias("value"), "n")


def status_index(df: DataFrame, key: str, groups: dict[str, str]) -> DataFrame:
    """group, status and id of each row and status column: a status that most rows have is many rows, not one.

    Written with partitionBy("group", "status") it is looked up by folder; status_counts() has the sizes.
    """
    each = F.explode(F.array(*[F.struct(F.lit(g).alias("group"), F.col(c).cast("string").alias("status")) for g, c in groups.items()]))
    return df.select(F.col(key).alias("id"), each.alias("e")).where("e.status is not null").select("e.group", "e.status", "id")


def status_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("group", "status").agg(F.count(F.lit(1)).alias("n"))


def nearest_marker(points: DataFrame, x: float, y: float, reach: float = 12.0) -> DataFrame:
    """The marker nearest to a position, within reach."""
    d = F.sqrt(F.pow(F.col("x") - x, 2) + F.pow(F.col("y") - y, 2))
    near = points.withColumn("distance", d).where(F.col("distance") <= reach)
    return near.agg(F.min_by("id", F.struct("distance", "id")).alias("id"), F.min("distance").alias("distance")).where("id is not null")


def record_set(df: DataFrame, group: str, status: str = "") -> DataFrame:
    """Rows of a named set: a content status, or a union of some."""
    unions = {
        "full": F.col("content_status").startswith("FULL_TEXT"),
        "link_only": F.col("content_status").isin("URL_PRESERVED", "REFERENCE_ONLY"),
        "manual_review": F.col("content_status") == "NEEDS_MANUAL_REVIEW",
        "malformed": F.col("content_status") == "MALFORMED",
        "duplicate": F.coalesce(F.col("duplicate_size") > 1, F.lit(False)) if "duplicate_size" in df.columns else F.lit(False),
    }
    return df.where(unions[group] if group in unions else F.col(group) == status)
