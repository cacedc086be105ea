"""Ranked lexical search: shards of documents with postings of precomputed integer impacts, scored one term at a time.

build() counts the corpus (documents with a word, and words), then writes each shard once: for every word the documents of
the shard that hold it, and the impact that it has in each, an integer of its count and the document's length. search()
sends the queries in blocks of bounded size; a task adds each term's impacts, times the term's weight, to a dense array with a
place for each document of the shard, selects the best with argpartition (equal scores by document), and merges what it
selects from its shards. What tasks have selected meets in two levels.

The weight of a term depends on how many documents hold it. These counts are taken for the block's terms alone, from the
shards' lists of words and slices; nothing that grows with the corpus is shuffled or sent to the driver.

Defined results: null and empty texts have no words; a document without words is never found and isn't counted. Rows that
repeat are documents of their own; a query row that repeats counts once, and queries that share an id but not a text are
ranked apart. A null doc_id ranks behind all others. An empty table on either side gives an empty result. Other columns are
left alone. Texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sedimenta.llm.common import batches_of, blocks, bounded_batches, new_folder, written
from sedimenta.llm.postings import QUERY_BYTES, SHARD_BYTES, numbered, places, query_blocks, shard_name, shard_row, slices, words

#: Groups in which what the tasks have selected meets first.
FIRST_MERGE = 64
#: Stands for a null doc_id within shards: behind all others.
NO_ID = np.iinfo(np.int64).max

SHARD = "shard string, doc_ids binary, terms array<binary>, slices binary, docs binary, impacts binary"


def weight(n_docs: int, df: int) -> int:
    """A term's weight, by the number of documents with a word and those that hold the term."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """Impacts of counts in documents of these lengths. All in 64 bits, divisions rounded down."""
    m = 25 + 75 * length * n_docs // n_words
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first, equal ones by ascending id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        least = scores[np.argpartition(scores, len(scores) - k)[len(scores) - k]]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        wanted = k - len(above)
        if len(equal) > wanted:
            equal = equal[np.argpartition(ids[equal], wanted - 1)[:wanted]]
        at = np.concatenate([above, equal])
    return at[np.lexsort((ids[at], -scores[at]))]


class Index:
    """Shards of one corpus, with what scores depend on: the documents that have a word, and the words of all."""

    #: Bytes of query texts in a block.
    query_bytes = QUERY_BYTES

    def __init__(self, shards: DataFrame, n_docs: int, n_words: int):
        self.shards, self.n_docs, self.n_words = shards, n_docs, n_words

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None) -> Index:
        """docs has doc_id and text."""
        spark = docs.sparkSession
        bounded_batches(spark)
        path = path or new_folder(spark, "search-index")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = all_words = 0
            for block in blocks(batches, SHARD_BYTES):
                _, counts = words(block.column(0))
                n, all_words = n + int(np.count_nonzero(counts)), all_words + int(counts.sum())
            yield pa.RecordBatch.from_pydict({"n": [n], "w": [all_words]})

        counted = docs.select("text").mapInArrow(count, "n bigint, w bigint").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
        n_docs, n_words = counted.n or 0, counted.w or 0

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for k, block in enumerate(blocks(batches, SHARD_BYTES)):
                found, counts = words(block.column(1))
                terms, numbers = numbered(found)
                keys, tf = np.unique(numbers * len(counts) + np.repeat(np.arange(len(counts)), counts), return_counts=True)
                if len(keys):
                    number, doc = np.divmod(keys, len(counts))
                    own = impacts(tf.astype(np.int64), counts[doc], n_docs, n_words)
                    ids = block.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
                    yield shard_row(shard=shard_name(k), doc_ids=ids, terms=terms, slices=slices(number, len(terms)), docs=doc.astype(np.int32), impacts=own.astype(np.int32))

        docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(build, SHARD).write.option("compression", "zstd").parquet(path)
        return cls(spark.read.schema(SHARD).parquet(path), n_docs, n_words)

    def document_counts(self, terms: list[bytes]) -> dict[bytes, int]:
        """In how many documents each of a block's terms stands."""
        wanted = self.shards.sparkSession.sparkContext.broadcast(terms)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = pa.array(wanted.value, pa.binary())
            total = np.zeros(len(asked), np.int64)
            for batch in batches:
                for own, cuts in zip(batch.column(0), batch.column(1), strict=True):
                    at = places(asked, own.values)
                    n = np.diff(np.frombuffer(cuts.as_py(), np.int32))
                    total += np.where(at >= 0, n[at], 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["term", "df"])

        rows = self.shards.select("terms", "slices").mapInArrow(count, "term bigint, df bigint")
        with batches_of(self.shards.sparkSession, 1):
            return {terms[r.term]: r.df for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}

    def search(self, items: DataFrame, k: int = 10) -> DataFrame:
        """item_id, rank, doc_id and score of each item's k best documents with a score above 0; items has item_id and text."""
        out, first = None, 0
        for rows in query_blocks(items, ["item_id", "text"], "text", self.query_bytes):
            found = self._block(rows, items.schema["item_id"].dataType.simpleString(), k, first)
            first += len(rows)
            out = found if out is None else out.unionByName(found)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for by in (["item_no", "item_id", "salt"], ["item_no", "item_id"]):
            out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
        return out.select("item_id", "rank", "doc_id", "score")

    def _block(self, rows: list, kind: str, k: int, first: int) -> DataFrame:
        found, counts = words(pa.array([r.text for r in rows], pa.string()))
        terms, numbers = numbered(found)
        vocabulary = terms.to_pylist()
        df = self.document_counts(vocabulary)
        weights = [weight(self.n_docs, df[t]) if t in df else 0 for t in vocabulary]
        ends = np.cumsum(counts)
        queries = [[(t, n * weights[t]) for t, n in sorted(Counter(numbers[e - c : e].tolist()).items()) if weights[t]] for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
        sent = self.shards.sparkSession.sparkContext.broadcast((vocabulary, queries, [r.item_id for r in rows]))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, queries, item_ids = sent.value
            asked = pa.array(vocabulary, pa.binary())
            held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
            for batch in batches:
                for row in range(batch.num_rows):
                    at = places(asked, batch.column("terms")[row].values)
                    ids = np.frombuffer(batch.column("doc_ids")[row].as_py(), np.int64)
                    cuts, docs, own = (np.frombuffer(batch.column(c)[row].as_py(), np.int32) for c in ("slices", "docs", "impacts"))
                    lists = {t: (docs[cuts[at[t]] : cuts[at[t] + 1]], own[cuts[at[t]] : cuts[at[t] + 1]].astype(np.int64)) for t in np.flatnonzero(at >= 0).tolist()}
                    for i, query in enumerate(queries):
                        scores = np.zeros(len(ids), np.int64)
                        for t, w in query:
                            if t in lists:
                                scores[lists[t][0]] += w * lists[t][1]
                        hit = np.flatnonzero(scores)
                        if len(hit):
                            top = hit[best(scores[hit], ids[hit], k)]
                            s, d = np.concatenate([held[i][0], scores[top]]), np.concatenate([held[i][1], ids[top]])
                            kept = best(s, d, k)
                            held[i] = s[kept], d[kept]
            at = np.repeat(np.arange(len(held)), [len(s) for s, _ in held])
            s, d = (np.concatenate([h[x] for h in held]) if held else np.zeros(0, np.int64) for x in (0, 1))
            salt = np.full(len(at), TaskContext.get().partitionId() % FIRST_MERGE)
            yield pa.RecordBatch.from_arrays([pa.array(first + at), pa.array([item_ids[i] for i in at], schema.field("item_id").type), pa.array(salt), pa.array(d, mask=d == NO_ID), pa.array(s)], schema=schema)

        fields = StructType.fromDDL(f"item_no bigint, item_id {kind}, salt bigint, doc_id bigint, score bigint")
        schema = to_arrow_schema(fields)
        with batches_of(self.shards.sparkSession, 1):
            return written(self.shards.mapInArrow(score, fields), "selected")
