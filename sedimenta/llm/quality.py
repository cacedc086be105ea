"""A supervised subword-embedding classifier of document quality.

Words and their character n-grams (with word boundaries marked) hash to buckets that have learned vectors; word bigrams
count only as repeats of the word before, one bucket for all words. A document is the mean of the vectors of all its
features, and a softmax over two classes reads it. Training is stochastic gradient descent in numpy, on a bounded sample
of labelled rows (TRAIN_ROWS for each class, those with the smallest hash of doc_id and text); scoring reads every whole
text. As the read-out is linear in the mean, scoring adds one number for each word.

Defined results: a null text counts as empty; every document has an end feature, so an empty text scores what that feature
learned. doc_ids without a usable label, or a table without labels, teach nothing; without both classes every score is
the labels' share of class 1, or 0.5 without any label. Repeated labels of a doc_id count as their majority (1 in a tie).
Rows that repeat are scored each on its own; texts of any length are read whole; an empty table gives an empty result; other
columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import blocks, bounded_batches, written

WORD_BUCKETS = 1 << 14
GRAM_BUCKETS = 1 << 15
GRAM_SIZES = (2, 3, 4)
DIMENSION = 10
#: Labelled rows of each class that training takes at most, and the epochs and rate of its descent.
TRAIN_ROWS = 1500
EPOCHS = 8
RATE = 0.5
#: Different words that are hashed at once.
SLICE_WORDS = 20_000
#: A document is accepted from this score on.
ACCEPT = 0.7
HELD_OUT_REMAINDER = 2
END = WORD_BUCKETS + GRAM_BUCKETS
REPEAT = END + 1
FEATURES = END + 2
#: A repeat weighs as many features, as a word brings some fifteen n-grams.
REPEAT_WEIGHT = 4

_ODD = np.uint64(0x9E3779B97F4A7C15)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT_REMAINDER


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words, each word's own and its n-grams', beside the word's place in the list.

    All words are hashed at once, as one array of code points; n-grams that would reach over a boundary are left out.
    """
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    codes = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    starts = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(words)), n)
    powers = np.full(int(n.max()), _ODD, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    whole = np.add.reduceat(codes * powers[np.arange(len(codes)) - starts[owner]], starts)
    owners, buckets = [np.arange(len(words))], [_bucket(whole, WORD_BUCKETS)]
    for size in GRAM_SIZES:
        m = max(0, len(codes) - size + 1)
        h = np.full(m, size, dtype=np.uint64)
        for k in range(size):
            h = h * _ODD + codes[k : k + m]
        inside = owner[:m] == owner[size - 1 : size - 1 + m]
        owners.append(owner[:m][inside])
        buckets.append(WORD_BUCKETS + _bucket(h[inside], GRAM_BUCKETS))
    return np.concatenate(owners), np.concatenate(buckets)


@dataclass(frozen=True)
class Words:
    """The words of a block of texts: the different ones, and for each word in order its number and its text's."""

    different: list[str]
    number: np.ndarray
    text: np.ndarray
    texts: int

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        flat = lists.flatten().dictionary_encode()
        different, number = flat.dictionary.to_pylist(), flat.indices.to_numpy()
        text = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        held = np.array([bool(w) for w in different], dtype=bool)[number] if different else np.zeros(0, dtype=bool)
        return cls(different, number[held], text[held], len(texts))

    def repeats(self) -> np.ndarray:
        """How often, in each text, a word equals the word before."""
        again = (self.number[1:] == self.number[:-1]) & (self.text[1:] == self.text[:-1])
        return np.bincount(self.text[1:][again], minlength=self.texts)


def document_features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The buckets of each whole text, and each one's share."""
    words, out = Words.of(texts), []
    ends = np.searchsorted(words.text, np.arange(words.texts + 1))
    for k, repeated in enumerate(words.repeats()):
        own, times = np.unique(words.number[ends[k] : ends[k + 1]], return_counts=True)
        owner, bucket = features([words.different[i] for i in own])
        counts = np.bincount(bucket, weights=times[owner], minlength=FEATURES)
        counts[END], counts[REPEAT] = 1, REPEAT_WEIGHT * repeated
        at = np.flatnonzero(counts)
        out.append((at.astype(np.uint16), (counts[at] / counts.sum()).astype(np.float32)))
    return out


@dataclass(frozen=True)
class Model:
    """What scoring needs: how far each bucket's vector speaks for class 1, or a constant score."""

    evidence: np.ndarray | None
    constant: float = 0.5

    def score(self, texts: pa.Array) -> np.ndarray:
        """The score of each text of a block."""
        if self.evidence is None:
            return np.full(len(texts), self.constant)
        words = Words.of(texts)
        speaks, n = np.zeros(len(words.different)), np.zeros(len(words.different))
        for at in range(0, len(words.different), SLICE_WORDS):
            part = words.different[at : at + SLICE_WORDS]
            owner, bucket = features(part)
            speaks[at : at + len(part)] = np.bincount(owner, weights=self.evidence[bucket], minlength=len(part))
            n[at : at + len(part)] = np.bincount(owner, minlength=len(part))
        again = REPEAT_WEIGHT * words.repeats()
        total = np.bincount(words.text, weights=speaks[words.number], minlength=words.texts) + self.evidence[END] + again * self.evidence[REPEAT]
        count = np.bincount(words.text, weights=n[words.number], minlength=words.texts) + 1 + again
        return 1 / (1 + np.exp(-np.clip(total / count, -60, 60)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Stochastic gradient descent on (buckets, shares, class)."""
    if not rows:
        return Model(None)
    share = float(np.mean([y for _, _, y in rows]))
    if share in (0.0, 1.0):
        return Model(None, share)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (FEATURES, DIMENSION)).astype(np.float32)
    output = np.zeros((2, DIMENSION), dtype=np.float32)
    weight = [0.5 / (1 - share), 0.5 / share]  # as if the classes were equally frequent
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            hidden = x @ vectors[at]
            z = output @ hidden
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            step = np.float32(RATE * (1 - done / steps) * weight[y])
            back = p @ output
            output -= step * np.outer(p, hidden)
            # Shares are small where a text is long: the step on a vector is scaled to the text, not to its length.
            vectors[at] -= (step * x / x.max())[:, None] * back
            done += 1
    return Model((vectors @ (output[1] - output[0])).astype(np.float64))


def training_sample(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features and class of the sampled labelled rows; 2 x train_rows at most reach the driver, each of bounded size."""
    bounded_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("y = 0").orderBy(*order).limit(train_rows).unionByName(known.where("y = 1").orderBy(*order).limit(train_rows))
    chosen = chosen.withColumnRenamed("doc_id", "_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "y")
    # A doc_id may have any number of rows, so each class is limited once more.
    rows = written(rows.withColumn("_h", F.xxhash64("doc_id", "text")), "labelled")
    last = {y: rows.where(F.col("y") == y).select("_h").orderBy("_h").limit(train_rows).agg(F.max("_h")).first()[0] for y in (0, 1)}
    parts = [rows.where((F.col("y") == y) & (F.col("_h") <= F.lit(last[y]))).orderBy("_h").limit(train_rows) for y in (0, 1)]
    rows = parts[0].unionByName(parts[1]).drop("_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = document_features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a.tobytes() for a, _ in found], pa.binary()), pa.array([x.tobytes() for _, x in found], pa.binary()), batch.column(2)],
                ["doc_id", "at", "x", "y"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"doc_id {kind}, at binary, x binary, y int").collect()
    got.sort(key=lambda r: (r.doc_id, bytes(r["at"]), bytes(r["x"])))
    return [(np.frombuffer(bytes(r["at"]), np.uint16).astype(np.int64), np.frombuffer(bytes(r["x"]), np.float32), r["y"]) for r in got]


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    return train(training_sample(docs, labels, train_rows))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(batch.column(2)))], ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", is_held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that the classifier accepts, with all their columns; only the texts go to Python."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(pa.array(texts, pa.string(), from_pandas=True)))

    return docs.where(score(F.col("text")) >= ACCEPT)
