"""Substring search through an inverted index of trigrams: lists of texts for each, intersected, then the texts themselves.

A trigram is three bytes of the UTF-8 of a text. Texts are taken in shards of some SHARD_BYTES; a shard's postings are a row for each of its
trigrams, in order, with the ascending numbers of the texts that hold it, as differences. They are written where the texts are, without a
shuffle; a search reads the rows of the needle's trigrams alone (in-order files have statistics by page), intersects the lists of each
shard from the shortest on, and reads texts only of shards that have candidates. Each candidate is verified.

Needles under three bytes have no trigram: all texts are read for them. Null texts hold nothing, an empty needle is in every text that
isn't null. Rows that repeat are texts of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import files

SHARD_BYTES = 8_000_000
#: Shards with candidates up to which their names go into the filter of the scan; beyond, nearly all are read anyway.
NAMED_SHARDS = 1_000


def grams_of(data: np.ndarray) -> np.ndarray:
    wide = data.astype(np.int32)
    return wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:] if len(wide) > 2 else np.zeros(0, np.int32)


def postings(texts: pa.Array, numbers: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The trigrams of some texts, ascending, and for each the (ascending) numbers of the texts that hold it, as the bytes of their differences."""
    texts = pc.fill_null(texts, "")
    _, offsets, values = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(values, np.uint8)[at[0] : at[-1]] if values is not None else np.zeros(0, np.uint8)
    grams = grams_of(data).astype(np.int64)
    starts = at.astype(np.int64) - at[0]
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    inside = owner[: len(grams)] == owner[2:]  # not across two texts
    keys = np.unique(grams[inside] << 32 | owner[: len(grams)][inside])
    gram, text = keys >> 32, numbers[keys & 0xFFFFFFFF].astype(np.int32)
    cuts = np.flatnonzero(np.diff(gram, prepend=-1))
    return gram[cuts], [np.diff(part, prepend=np.int32(0)).tobytes() for part in np.split(text, cuts[1:])] if len(cuts) else []


def intersect(lists: list[list[bytes]]) -> np.ndarray:
    """What is in all lists, from the shortest on; a list may come in parts."""
    found = None
    for parts in sorted(lists, key=lambda parts: sum(map(len, parts))):
        own = np.concatenate([np.cumsum(np.frombuffer(p, np.int32)) for p in parts])
        found = own if found is None else found[np.isin(found, own, assume_unique=True)]
        if not len(found):
            break
    return found if found is not None else np.zeros(0, np.int64)


class TrigramIndex:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @classmethod
    def build(cls, texts: DataFrame, key: str, text: str, folder: str | None = None) -> TrigramIndex:
        spark = texts.sparkSession
        index = cls(spark, folder or files.shared_folder(spark, "trigrams"))
        kind = texts.schema[key].dataType.simpleString()

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows with the name of their shard and their number in it."""
            task, shard, n, size = TaskContext.get().partitionId(), 0, 0, 0
            for batch in batches:
                names, numbers = [], []
                lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
                for length in lengths:
                    if size and size + length > SHARD_BYTES:
                        shard, n, size = shard + 1, 0, 0
                    names.append(f"{task:07d}-{shard:05d}")
                    numbers.append(n)
                    n, size = n + 1, size + length
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int32()), batch.column(0), batch.column(1)], ["shard", "row", "key", "text"])

        def inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows come in order of their shards; a shard is done when another begins, or the part of it that lies in this task."""
            held, numbers, name = [], [], None

            def rows() -> pa.RecordBatch:
                grams, lists = postings(pa.concat_arrays(held), np.concatenate(numbers))
                return pa.RecordBatch.from_arrays([pa.array(grams, pa.int32()), pa.array([name] * len(grams), pa.string()), pa.array(lists, pa.binary())], ["gram", "shard", "texts"])

            for batch in batches:
                shards = batch.column(0).to_pylist()
                at = 0
                while at < len(shards):
                    to = at
                    while to < len(shards) and shards[to] == shards[at]:
                        to += 1
                    if name is not None and shards[at] != name:
                        yield rows()
                        held, numbers = [], []
                    name = shards[at]
                    held.append(batch.column(2).slice(at, to - at))
                    numbers.append(batch.column(1).slice(at, to - at).to_numpy())
                    at = to
            if held:
                yield rows()

        named = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(placed, f"shard string, row int, key {kind}, text string")
        # A row group is about a shard, so that a scan for some shards leaves the others unread.
        named.write.option("parquet.block.size", SHARD_BYTES).parquet(f"{index.folder}/texts")
        stored = spark.read.parquet(f"{index.folder}/texts").select("shard", "row", "text")
        stored.mapInArrow(inverted, "gram int, shard string, texts binary").write.option("compression", "zstd").parquet(f"{index.folder}/postings")
        return index

    @property
    def texts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/texts")

    def candidates(self, needle: str) -> DataFrame | None:
        """shard and rows (numbers there) of the texts that hold all of a needle's trigrams, a row for each shard; None if it has none."""
        grams = sorted({int(g) for g in grams_of(np.frombuffer(needle.encode("utf-8"), np.uint8))})
        if not grams:
            return None

        def met(table: pa.Table) -> pa.Table:
            parts: dict[int, list[bytes]] = {}  # a shard that was cut between tasks has more than one list of a trigram
            for gram, part in zip(table["gram"].to_pylist(), table["texts"].to_pylist(), strict=True):
                parts.setdefault(gram, []).append(part)
            found = intersect(list(parts.values())) if len(parts) == len(grams) else np.zeros(0, np.int64)
            if not len(found):
                return pa.table({"shard": pa.array([], pa.string()), "rows": pa.array([], pa.list_(pa.int32()))})
            return pa.table({"shard": pa.array([table["shard"][0].as_py()]), "rows": pa.array([found], pa.list_(pa.int32()))})

        rows = self.spark.read.parquet(f"{self.folder}/postings").where(F.col("gram").isin(grams))
        return rows.groupBy("shard").applyInArrow(met, "shard string, rows array<int>")

    def search(self, needle: str) -> DataFrame:
        """key and text of every text that contains the needle."""
        found = self.candidates(needle)
        rows = self.texts
        if found is not None:
            found = files.written(found, "trigram-candidates")
            shards = [r.shard for r in found.select("shard").limit(NAMED_SHARDS + 1).collect()]
            if len(shards) <= NAMED_SHARDS:
                rows = rows.where(F.col("shard").isin(shards))
            rows = rows.join(found, "shard").where(F.array_contains("rows", F.col("row")))
        return rows.where(F.contains("text", F.lit(needle))).select("key", "text")
