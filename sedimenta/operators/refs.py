"""References between records and sources: occurrences stay apart, sources are found by raw and then by normalised URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.urls import hash_id, normalize_url, urls_in
from sedimenta.operators.extract import json_leaves
from sedimenta.session import by_key, checkpointed


def match_sources(references: DataFrame, sources: DataFrame) -> DataFrame:
    """references with source_id: that of the first source with the raw URL, else of the first with the normalised one.

    references has raw_url and normalized_url; sources has source_id, raw_urls (an array) and normalized_url.
    """
    raw = sources.select("source_id", F.explode("raw_urls").alias("_raw")).groupBy("_raw").agg(F.min("source_id").alias("_by_raw"))
    norm = sources.where("normalized_url != ''").groupBy(F.col("normalized_url").alias("_norm")).agg(F.min("source_id").alias("_by_norm"))
    out = references.join(raw, F.col("raw_url") == F.col("_raw"), "left").join(norm, F.col("normalized_url") == F.col("_norm"), "left")
    return out.withColumn("source_id", F.coalesce("_by_raw", "_by_norm")).drop("_raw", "_by_raw", "_norm", "_by_norm")


def reference_id(record: Column, origin: Column, occurrence: Column, raw_url: Column) -> Column:
    return hash_id("reference", F.concat_ws("\n", record, origin, occurrence.cast("string"), F.coalesce(raw_url, F.lit(""))))


def collect_references(historical: DataFrame, provenance: DataFrame, embedded: DataFrame) -> DataFrame:
    """All references in three stages; a later stage adds only pairs of record and URL that no stage before it has.

    Each input has record_id, raw_url and ord, its order within the stage. The first keeps every occurrence (by position)
    and flags repeats; the others number theirs for each record.
    """
    pair, columns = ["record_id", "raw_url"], ["record_id", "raw_url", "ord"]
    first = historical.select(*columns, F.lit(1).alias("stage"))
    stated = lambda df, n: df.where("raw_url is not null and raw_url != '' and record_id is not null").select(*columns, F.lit(n).alias("stage"))
    # A record's rows are dealt to one task once, and more rows to more tasks: what a task sorts doesn't grow with the table.
    rows = by_key(first.unionByName(stated(provenance, 2)).unionByName(stated(embedded, 3)), "record_id")
    # The earliest stage that has a pair, and its first place there; the first stage keeps all.
    place = F.row_number().over(Window.partitionBy(*pair).orderBy("stage", "ord"))
    every = rows.withColumn("_place", place).where("stage = 1 or _place = 1").drop("_place")
    every = every.withColumn("occurrence", F.row_number().over(Window.partitionBy("record_id", "stage").orderBy("ord", "raw_url")))
    # By occurrence, as rows may tie in ord; a later stage has each pair once.
    repeat = F.row_number().over(Window.partitionBy(*pair, "stage").orderBy("occurrence")) > 1
    origin = F.element_at(F.array(F.lit("historical"), F.lit("provenance"), F.lit("embedded")), F.col("stage"))
    out = every.select("record_id", origin.alias("origin"), "occurrence", "raw_url", repeat.alias("is_repeat"))
    return out.withColumn("source_reference_id", reference_id(F.col("record_id"), F.col("origin"), F.col("occurrence"), F.col("raw_url")))


#: Items that an entity or record holds as an array; more are found in the table of pairs only.
MOST_IN_ARRAY = 10_000


def entity_references(references: DataFrame, url: str, ref_id: str, order: str) -> DataFrame:
    """entity_id, ref, ord and the URL's parts (raw, norm, status, domain) of every reference: the whole table of pairs."""
    link = normalize_url(url)
    rows = references.select(F.col(ref_id).alias("ref"), F.col(order).alias("ord"), link.alias("l")).select("ref", "ord", F.col("l.raw").alias("raw"), F.col("l.normalized").alias("norm"), F.col("l.status").alias("status"), F.col("l.domain").alias("domain"))
    return rows.withColumn("entity_id", hash_id("external", F.when(F.col("norm") != "", F.col("norm")).otherwise(F.col("raw"))))


def roll_up_entities(references: DataFrame, url: str, ref_id: str, order: str, most: int = MOST_IN_ARRAY) -> DataFrame:
    """One entity for each normalised URL, malformed ones by their text: first URL, raw variants and references in order.

    An entity with more than most references has no arrays (null); entity_references() has all of them, and n_references
    counts them. Each URL is taken apart once.
    """
    rows = checkpointed(entity_references(references, url, ref_id, order))
    by_raw = rows.groupBy("entity_id", "raw").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n"), F.min_by(F.struct("norm", "status", "domain"), "ord").alias("f"))
    firsts = by_raw.groupBy("entity_id").agg(F.min_by("f", "ord").alias("f"), F.sum("n").alias("n_references"))
    small = firsts.where(F.col("n_references") <= most).select("entity_id")
    listed = lambda df, c: df.join(small, "entity_id", "left_semi").groupBy("entity_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", c))), lambda v: v[c]).alias("_l"))
    out = firsts.join(listed(rows, "ref").withColumnRenamed("_l", "reference_ids"), "entity_id", "left").join(listed(by_raw, "raw").withColumnRenamed("_l", "raw_urls"), "entity_id", "left")
    return out.select("entity_id", F.col("f.norm").alias("normalized_url"), F.col("f.status").alias("status"), F.col("f.domain").alias("domain"), "n_references", "reference_ids", "raw_urls")


def nest_references(records: DataFrame, references: DataFrame, key: str, fields: list[str], order: str, most: int = MOST_IN_ARRAY) -> DataFrame:
    """records with references, an ordered array of structs: empty for records without any, null for those with more than most."""
    many = references.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(F.col(key).alias("_many"))
    few = references.join(many, F.col(key) == F.col("_many"), "left_anti")
    nested = few.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *fields))).alias("_refs"))
    out = records.join(nested, key, "left").join(many, F.col(key) == F.col("_many"), "left")
    kept = F.transform("_refs", lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    none = F.filter(F.array(F.struct(*[F.lit(None).cast(references.schema[f].dataType).alias(f) for f in fields])), lambda _: F.lit(False))
    return out.withColumn("references", F.when(F.col("_many").isNull(), F.coalesce(kept, none))).drop("_refs", "_many")


def through_edges(left: DataFrame, edges: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """left joined to right through a table of pairs, each pair once."""
    return left.join(edges.select(left_key, right_key).distinct(), left_key).join(right, right_key)


def media_placeholders(records: DataFrame, media: str = "media_urls") -> tuple[DataFrame, DataFrame]:
    """A row for each different media URL, and the edges from records; ids are those of the normalised URL.

    records has record_id and an array of media URLs.
    """
    each = records.select("record_id", F.posexplode(media).alias("pos", "url")).where("url != ''")
    norm = normalize_url("url")["normalized"]
    each = each.withColumn("media_id", hash_id("media", norm))
    items = each.groupBy("media_id").agg(F.min("url").alias("original_url"), F.array_sort(F.collect_set("record_id")).alias("record_ids"))
    return items.withColumn("preservation_status", F.lit("external_only")), each.select("record_id", "media_id").distinct()


def media_sources(media: DataFrame, sources: DataFrame) -> DataFrame:
    """media with the source that has its normalised URL."""
    known = sources.groupBy(F.col("normalized_url").alias("_u")).agg(F.min("source_id").alias("source_id"))
    return media.join(known, normalize_url("original_url")["normalized"] == F.col("_u"), "left").drop("_u")


def hydrate_from_cache(sources: DataFrame, cache: DataFrame) -> DataFrame:
    """Sources without a text, with that of another job's source under the same fetch key whose hash holds.

    sources has source_id, fetch_key and text; cache has fetch_key, source_id, text and content_hash.
    """
    good = cache.where("text is not null and text != ''").where(F.sha2("text", 256) == F.col("content_hash"))
    good = good.select(F.col("fetch_key").alias("_k"), F.col("source_id").alias("cached_from"), F.col("text").alias("cached_text"))
    wanted = sources.where("text is null or text = ''")
    # The two smallest sources of each key, the second for the case that the first is the source itself; texts come last, one each.
    ids = good.select("_k", "cached_from")
    least = ids.groupBy("_k").agg(F.min("cached_from").alias("_first"))
    second = ids.join(least, "_k").where("cached_from > _first").groupBy(F.col("_k").alias("_k2")).agg(F.min("cached_from").alias("_second"))
    pair = least.join(second, F.col("_k") == F.col("_k2"), "left").drop("_k2")
    own = wanted.select("source_id", "fetch_key").distinct().join(pair, F.col("fetch_key") == F.col("_k"))
    chosen = own.withColumn("cached_from", F.when(F.col("source_id") == F.col("_first"), F.col("_second")).otherwise(F.col("_first"))).where("cached_from is not null")
    chosen = chosen.groupBy("source_id").agg(F.min(F.struct("cached_from", "_k")).alias("c")).select("source_id", "c.cached_from", "c._k")
    texts = good.groupBy("_k", "cached_from").agg(F.min("cached_text").alias("cached_text"))
    return chosen.join(texts, ["_k", "cached_from"]).select("source_id", "cached_from", "cached_text")


def link_evidence(declared: DataFrame, documents: DataFrame, key: str, column: str) -> DataFrame:
    """key, url, path and kind of every link: those declared, and those found in the texts of JSON documents with their path.

    declared has key and url.
    """
    found = json_leaves(documents, key, column).select(key, F.explode(urls_in("value")).alias("url"), "path").withColumn("kind", F.lit("embedded"))
    own = declared.select(key, "url", F.lit(None).cast("string").alias("path"), F.lit("declared").alias("kind"))
    return own.unionByName(found)


def worklist_digest(targets: DataFrame) -> DataFrame:
    """One digest for a set of rows, whatever their order: rows' SHA-256 are added in four parts, so no task holds them all."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(targets.columns)])), 256).alias("h")
    part = lambda i: F.sum(F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(38,0)")).cast("string")
    return targets.select(row).agg(F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[F.coalesce(part(i), F.lit("0")) for i in range(4)]), 256).alias("digest"))
