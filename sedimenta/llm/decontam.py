"""Benchmark decontamination by a distributed positional inverted index.

build() writes the positions of every word of the corpus, once: a shard of documents is a row with its different words, and
for each of them the ascending positions in the shard, as differences. Documents are numbered through with a gap between
them, so that no phrase runs from one into the next. Items come in blocks of bounded size. In each shard, a window of an item
(WINDOW consecutive words; all of them if there are fewer) takes the list of the word that is rarest there, moved by the
word's place in the window, and intersects it with the other words' moved lists from the rarest to the commonest. Lists are
slices of one sorted array of (word, position), so an intersection is a binary search. What is left are exact phrases; with a slop,
each word may stand so many places from where it would stand in a copy (proximity).

A document lies in one shard, so its spans are united there; nothing but the items is sent or shuffled, unless they take several blocks.

Defined results: null and empty texts have no words and no hits. An item without words has no window. Rows that repeat are
documents of their own; items that share an id count once for a document. A null item_id counts as an item, but adds nothing to a digest
of ids. Empty tables give an empty result (documents) or no hits (items); other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from sedimenta.llm.common import batches_of, blocks, bounded_batches, new_folder, written
from sedimenta.llm.postings import QUERY_BYTES, SHARD_BYTES, numbered, places, query_blocks, shard_name, shard_row, slices, words

#: Words of a window.
WINDOW = 10
#: Candidates (window, place) that are intersected at once.
CANDIDATES = 2_000_000

SHARD = "shard string, doc_ids {0}, lengths binary, terms array<binary>, slices binary, positions binary"


class Windows:
    """The windows of a block of items: their words as numbers in the block's vocabulary, -1 behind those of short items."""

    def __init__(self, texts: list[str | None], width: int = WINDOW):
        found, counts = words(pa.array(texts, pa.string()))
        terms, numbers = numbered(found)
        self.vocabulary = terms.to_pylist()
        first = np.cumsum(counts) - counts
        each = np.maximum(counts - width + 1, np.minimum(counts, 1))
        self.item = np.repeat(np.arange(len(counts)), each)
        self.start = np.arange(len(self.item)) - np.repeat(np.cumsum(each) - each, each)
        self.length = np.minimum(counts, width)[self.item]
        place = np.arange(width)
        at = (first[self.item] + self.start)[:, None] + place
        inside = place < self.length[:, None]
        self.words = np.where(inside, np.append(numbers, -1)[np.minimum(at, len(numbers))], -1)


class Shard:
    """The postings of one shard, as the bytes of its row."""

    def __init__(self, lengths: bytes, terms: pa.Array, cuts: bytes, positions: bytes):
        self.terms, self.cuts = terms, np.frombuffer(cuts, np.int32).astype(np.int64)
        self.positions = np.cumsum(np.frombuffer(positions, np.int32), dtype=np.int64)
        self.lengths = np.frombuffer(lengths, np.int32).astype(np.int64)
        self.base = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.size = int(self.lengths.sum()) + len(self.lengths)

    def found(self, asked: pa.Array, windows: Windows, slop: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows that stand in the shard, with their documents and the places (in the shard) of their first words."""
        at = np.append(places(asked, self.terms), -1)  # the last stands for no word
        n = np.append(np.diff(self.cuts), 0)[at]
        lists = n[windows.words]
        own = windows.words >= 0
        live = np.flatnonzero(((lists > 0) | ~own).all(axis=1))
        if not len(live):
            return
        keys = np.repeat(np.arange(len(self.terms)), np.diff(self.cuts)) * self.size + self.positions
        order = np.argsort(np.where(own[live], lists[live], np.iinfo(np.int64).max), axis=1, kind="stable")
        rarest = order[:, 0]
        heads = at[windows.words[live, rarest]]
        each = (self.cuts[heads + 1] - self.cuts[heads]) * (2 * slop + 1)
        ends = np.cumsum(each)
        low = 0
        while low < len(live):  # so many windows that their candidates stay few, one at least
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CANDIDATES, side="right")))
            yield self._intersected(windows, live, order, rarest, heads, at, keys, np.arange(low, high), slop)
            low = high

    def _intersected(self, windows, live, order, rarest, heads, at, keys, chosen, slop) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = self.cuts[heads[chosen]]
        n = self.cuts[heads[chosen] + 1] - first
        win = np.repeat(chosen, n)
        posting = self.positions[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
        doc = np.searchsorted(self.base, posting, side="right") - 1
        moves = np.arange(-slop, slop + 1)
        win, doc = np.repeat(win, len(moves)), np.repeat(doc, len(moves))
        start = (posting[:, None] - rarest[np.repeat(chosen, n)][:, None] + moves).ravel()
        for rank in range(1, windows.words.shape[1]):
            place = order[win, rank]
            word = windows.words[live[win], place]
            asked = np.flatnonzero(word >= 0)
            if not len(asked):
                break
            number = at[word[asked]] * self.size
            due = start[asked] + place[asked]
            least = number + np.maximum(due - slop, self.base[doc[asked]])
            most = number + np.minimum(due + slop, self.base[doc[asked]] + self.lengths[doc[asked]] - 1)
            k = np.searchsorted(keys, least)
            kept = np.ones(len(win), bool)
            kept[asked] = (least <= most) & (keys[np.minimum(k, len(keys) - 1)] <= most) & (k < len(keys))
            win, doc, start = win[kept], doc[kept], start[kept]
        return live[win], doc, start


class PositionalIndex:
    """Postings with positions of one corpus."""

    #: Bytes of item texts in a block.
    query_bytes = QUERY_BYTES

    def __init__(self, shards: DataFrame):
        self.shards = shards

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None) -> PositionalIndex:
        """docs has doc_id and text."""
        spark = docs.sparkSession
        bounded_batches(spark)
        path = path or new_folder(spark, "positions")
        schema = SHARD.format(f"array<{docs.schema['doc_id'].dataType.simpleString()}>")

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for k, block in enumerate(blocks(batches, SHARD_BYTES)):
                found, counts = words(block.column(1))
                terms, numbers = numbered(found)
                at = np.arange(len(numbers)) + np.repeat(np.arange(len(counts)), counts)
                keys = np.sort(numbers << 32 | at)
                number, at = keys >> 32, keys & 0xFFFFFFFF
                yield shard_row(shard=shard_name(k), doc_ids=block.column(0), lengths=counts.astype(np.int32), terms=terms, slices=slices(number, len(terms)), positions=np.diff(at, prepend=0).astype(np.int32))

        docs.select("doc_id", "text").mapInArrow(build, schema).write.option("compression", "zstd").parquet(path)
        return cls(spark.read.schema(schema).parquet(path))

    def _mapped(self, rows: list, work, schema: str) -> DataFrame:
        """work(row number's shard, its row, windows, item ids) over all shards, for a block of items."""
        windows = Windows([r.text for r in rows])
        sent = self.shards.sparkSession.sparkContext.broadcast((windows, [r.item_id for r in rows]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows, item_ids = sent.value
            asked = pa.array(windows.vocabulary, pa.binary())
            for batch in batches:
                for row in range(batch.num_rows):
                    cell = {c: batch.column(c)[row] for c in batch.schema.names}
                    shard = Shard(cell["lengths"].as_py(), cell["terms"].values, cell["slices"].as_py(), cell["positions"].as_py())
                    yield work(cell, shard, asked, windows, item_ids)

        with batches_of(self.shards.sparkSession, 1):
            return written(self.shards.mapInArrow(run, schema), "decontamination")

    def matches(self, items: DataFrame, slop: int = 0) -> DataFrame:
        """item_id, window (its first word in the item), doc_id and at (its first word in the document) of every match.

        At is where an exact copy would begin; with a slop it is the first such place of a window and document.
        """
        kinds = [to_arrow_type(k) for k in (items.schema["item_id"].dataType, self._doc_type())]

        def work(cell, shard, asked, windows, item_ids) -> pa.RecordBatch:
            win, doc, start = _joined(list(shard.found(asked, windows, slop)))
            if slop:
                least = np.lexsort((start, doc, win))
                win, doc, start = win[least], doc[least], start[least]
                new = np.append(True, (win[1:] != win[:-1]) | (doc[1:] != doc[:-1]))[: len(win)]
                win, doc, start = win[new], doc[new], start[new]
            return pa.RecordBatch.from_arrays(
                [pa.array([item_ids[i] for i in windows.item[win]], kinds[0]), pa.array(windows.start[win], pa.int64()), cell["doc_ids"].values.take(pa.array(doc)), pa.array(start - shard.base[doc], pa.int64())],
                ["item_id", "window", "doc_id", "at"],
            )

        schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, window bigint, doc_id {self._doc_type().simpleString()}, at bigint"
        out = None
        for rows in query_blocks(items, ["item_id", "text"], "text", self.query_bytes):
            found = self._mapped(rows, work, schema)
            out = found if out is None else out.unionByName(found)
        return out

    def _doc_type(self) -> DataType:
        return self.shards.schema["doc_ids"].dataType.elementType

    def documents(self, items: DataFrame) -> DataFrame:
        """doc_id, n_words, spans (of words inside exact matches, united) and items (ids, ascending) of every document."""
        item_type = to_arrow_type(items.schema["item_id"].dataType)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

        def work(cell, shard, asked, windows, item_ids) -> pa.RecordBatch:
            n, (win, doc, start) = len(shard.lengths), _joined(list(shard.found(asked, windows)))
            edges = np.bincount(start, minlength=shard.size + 1) - np.bincount(start + windows.length[win], minlength=shard.size + 1)
            covered = np.append(0, (np.cumsum(edges) > 0).astype(np.int8))
            turns = np.diff(covered)
            first, last = np.flatnonzero(turns > 0), np.flatnonzero(turns < 0)
            of = np.searchsorted(shard.base, first, side="right") - 1
            spans = pa.StructArray.from_arrays([pa.array(first - shard.base[of], pa.int64()), pa.array(last - shard.base[of], pa.int64())], fields=list(span))
            rank = np.array([order[i] for i in item_ids] or [0])
            pairs = np.unique(doc * len(known) + rank[windows.item[win]]) if len(win) else np.zeros(0, np.int64)
            held = pa.array(known, item_type).take(pa.array(pairs % max(1, len(known))))
            cut = lambda docs: pa.array(np.searchsorted(docs, np.arange(n + 1)), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([cell["shard"].as_py()] * n, pa.string()), pa.array(np.arange(n), pa.int64()), cell["doc_ids"].values, pa.array(shard.lengths), pa.ListArray.from_arrays(cut(of), spans), pa.ListArray.from_arrays(cut(pairs // max(1, len(known))), held)],
                ["shard", "row", "doc_id", "n_words", "spans", "items"],
            )

        out, n_blocks = None, 0
        for rows in query_blocks(items, ["item_id", "text"], "text", self.query_bytes):
            known = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i if i is not None else 0))
            order = {i: k for k, i in enumerate(known)}
            found = self._mapped(rows, work, f"shard string, row bigint, doc_id {self._doc_type().simpleString()}, n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<{items.schema['item_id'].dataType.simpleString()}>")
            out, n_blocks = found if out is None else out.unionByName(found), n_blocks + 1
        if n_blocks > 1:  # what the blocks found in a document, together
            cells = [F.first(c).alias(c) for c in ("doc_id", "n_words")] + [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items")]
            out = out.groupBy("shard", "row").agg(*cells).withColumns({"spans": _united("spans"), "items": F.array_sort(F.array_distinct("items"))})
        return out.select("doc_id", "n_words", "spans", "items")


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))


def _united(spans: str) -> Column:
    """Spans that overlap or touch, as one, in order."""
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), none, add)


def contamination(found: DataFrame) -> DataFrame:
    """documents() as counts: doc_id, n_words, n_hit (words inside a match), n_items, items_sha256 and contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The counts of every document, by an index that is built over all of them."""
    return contamination(PositionalIndex.build(docs).documents(items))
