"""A content-addressed store of token ids.

A rolling hash over each document's ids cuts them into chunks, so shared passages give equal chunks wherever they stand.
Each different chunk is stored once under its SHA-256; a document's recipe lists its chunks in order, and the root of a
Merkle tree over them vouches for the whole. The files are Parquet tables in one folder:

    staged    the encoder's output, dropped once the others are written
    chunks    digest, width (bytes of an id: 2 or 4, little-endian), ids (binary)
    recipes   doc_id, range, within (ids of the documents before it in its range), n_tokens, root, chunks (digest and ids of each)
    ranges    range, range_start (ids of all documents in the ranges before)

Recipes ascend by doc_id within each file and from file to file in name order. Chunks are found by digest and have no order.

Reading back takes the stored bytes only: every chunk is hashed again and must match its name, every recipe's root is
computed again from the chunks found, and a document's CRC-32 is combined from those of its chunks, as CRC-32 is linear.
So no ids are shuffled again. ids() rebuilds the ids themselves.

Defined results: a null text counts as empty and gives the end id only. Rows that repeat a doc_id, and rows without one
(first), are documents of their own, in an order that is stable for one store. Texts of any length are encoded whole; an empty table gives an empty store and an empty result; other
columns are left alone. A missing or damaged chunk raises an error.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.bitfilter import KeyFilter
from sedimenta.llm.common import blocks, bounded_batches, new_folder, remove

#: The rolling hash covers this many ids; chunks have MIN_IDS to MAX_IDS ids, some MIN_IDS + 2 ** CUT_BITS on average.
WINDOW_IDS = 16
MIN_IDS = 64
MAX_IDS = 2048
CUT_BITS = 8
#: Words whose ids a worker keeps; beyond, it keeps those of the block at hand.
CACHED_WORDS = 500_000
#: Words that reach the library in one text, and the word between them.
JOINT_WORDS = 2000
MARK = "\x01"
#: Marks that are parted from the letters before them, and how many at most.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
MOST_MARKS = 8
#: Beyond these letters none is parted; one among them has a lower case that ends in a mark, which joins what follows.
NOT_LATIN = "[^\\x00-\\x{24f}]|\\x{130}"

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def rolling(ids: np.ndarray) -> np.ndarray:
    """At each id, a hash of the WINDOW_IDS ids that end there (of fewer at the start), modulo 2 ** 64."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    sums = np.cumsum(mixed * _powers(_ODD, len(ids)), dtype=np.uint64)
    own = sums.copy()
    own[WINDOW_IDS:] -= sums[:-WINDOW_IDS]
    return own * _powers(_INVERSE, len(ids))


def cuts(ids: np.ndarray) -> list[int]:
    """Where the chunks end: after an id whose rolling hash has CUT_BITS leading zeros, within the bounds."""
    out, at, n = [], 0, len(ids)
    if n > MIN_IDS:
        for end in (np.flatnonzero(rolling(ids) >> np.uint64(64 - CUT_BITS) == 0) + 1).tolist():
            while end - at > MAX_IDS:
                at += MAX_IDS
                out.append(at)
            if end - at >= MIN_IDS:
                at = end
                out.append(at)
        while n - at > MAX_IDS:
            at += MAX_IDS
            out.append(at)
    if at < n:
        out.append(n)
    return out


def merkle_root(digests: list[bytes]) -> bytes:
    """Leaves and inner nodes are told apart by a first byte; an odd node goes up as it is."""
    level = [hashlib.sha256(b"\0" + d).digest() for d in digests] or [hashlib.sha256(b"\0").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(level) - len(level) % 2 :]
    return level[0]


class CrcJoin:
    """CRC-32 of joined texts from those of their parts: appending n bytes to a text is a linear map over the 32 bits.

    A text's CRC is the exclusive or of its parts' CRCs, each moved by the bytes that follow the part.
    """

    def __init__(self) -> None:
        # What a zero bit appended makes of each single bit; as tables by byte, for 2 ** k zero bytes.
        one = np.array([0xEDB88320] + [1 << (b - 1) for b in range(1, 32)], dtype=np.uint32)
        for _ in range(3):
            one = self._of_bits(one, one)
        self.columns, self.tables = [one], [self._by_byte(one)]

    @staticmethod
    def _of_bits(columns: np.ndarray, v: np.ndarray) -> np.ndarray:
        bits = (v[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
        return np.bitwise_xor.reduce(np.where(bits.astype(bool), columns, np.uint32(0)), axis=1)

    @classmethod
    def _by_byte(cls, columns: np.ndarray) -> np.ndarray:
        return np.stack([cls._of_bits(columns, np.arange(256, dtype=np.uint32) << np.uint32(8 * i)) for i in range(4)])

    def moved(self, crcs: np.ndarray, zero_bytes: np.ndarray) -> np.ndarray:
        out, k = crcs.astype(np.uint32), 0
        left = zero_bytes.astype(np.int64)
        while left.any():
            if len(self.tables) <= k:
                self.columns.append(self._of_bits(self.columns[-1], self.columns[-1]))
                self.tables.append(self._by_byte(self.columns[-1]))
            at, t = np.flatnonzero(left & 1), self.tables[k]
            v = out[at]
            out[at] = t[0][v & 255] ^ t[1][(v >> 8) & 255] ^ t[2][(v >> 16) & 255] ^ t[3][v >> 24]
            left, k = left >> 1, k + 1
        return out

    def joined(self, crcs: np.ndarray, part_bytes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One CRC for each text; offsets say where its parts begin, and where the last text's end. No text lacks parts."""
        ends = np.cumsum(part_bytes)
        whole = ends[offsets[1:] - 1]
        after = np.repeat(whole, np.diff(offsets)) - ends
        return np.bitwise_xor.reduceat(self.moved(crcs, after), offsets[:-1])


class WordEncoder:
    """Ids of whole texts from the tokenizers library, for vocabularies that drop white space and never join across it.

    Words between white space are numbered within a block of texts, so each is looked up once for a block, and encoded by
    the library once for as long as its ids are kept. A word of Latin letters with ASCII marks behind it is parted into the
    two, as such vocabularies part letters from marks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 65536 else np.dtype("<u4")
        self.coded = [i.to_bytes(self.width.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        # Known words, and where the ids of each stand in one table.
        self.known = pa.array([""], pa.string())
        self.table, self.starts, self.counts = np.zeros(0, dtype=self.width), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of words from the library. They go to it in one text, apart by a word that none of them holds: this saves most of its cost."""
        tokenize, coded, size = self.model.tokenize, self.coded, self.width.itemsize
        out: list[bytes] = [b""] * len(words)
        joint: list[int] = []
        for i, word in enumerate(words):
            if word.isascii() and word.isalpha() and word.islower():
                # Plain lower-case letters are what normalisers and splitters would leave, so they go to the model itself.
                out[i] = b"".join([coded[t.id] for t in tokenize(word)])
            elif MARK in word:
                out[i] = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype=self.width).tobytes()
            else:
                joint.append(i)
        for at in range(0, len(joint), JOINT_WORDS):
            part = joint[at : at + JOINT_WORDS]
            ids = np.array(self.tokenizer.encode_batch_fast([f" {MARK} ".join([words[i] for i in part])], add_special_tokens=False)[0].ids, dtype=self.width)
            ends = [*np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            if len(ends) != len(part):
                raise ValueError("the words' ids can't be told apart")
            raw, start = ids.tobytes(), 0
            for i, end in zip(part, ends, strict=True):
                out[i] = raw[start * size : end * size]
                start = end + 1
        return out

    def _forget_all_but(self, kept: np.ndarray) -> None:
        starts, self.counts = self.starts[kept], self.counts[kept]
        self.known = self.known.take(pa.array(kept))
        self.starts = np.cumsum(self.counts) - self.counts
        self.table = self.table[np.repeat(starts - self.starts, self.counts) + np.arange(self.counts.sum())]

    def lookup(self, words: pa.Array) -> np.ndarray:
        """The numbers of different words among the known ones; new ones become known. At most CACHED_WORDS stay known besides the block's own."""
        at = pc.index_in(words, value_set=self.known)
        if at.null_count:
            if len(self.known) + at.null_count > CACHED_WORDS:
                self._forget_all_but(np.unique(at.drop_null().to_numpy()))
                at = pc.index_in(words, value_set=self.known)
            missing = words.filter(at.is_null())
            ids = self._encoded(missing.to_pylist())
            counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.width.itemsize
            first = len(self.known)
            self.starts = np.concatenate([self.starts, len(self.table) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.table = np.concatenate([self.table, np.frombuffer(b"".join(ids), dtype=self.width)])
            self.known = pa.concat_arrays([self.known, missing])
            numbers = at.fill_null(0).to_numpy().astype(np.int64)
            numbers[at.is_null().to_numpy(zero_copy_only=False)] = np.arange(first, first + len(ids))
            return numbers
        return at.to_numpy().astype(np.int64)

    @staticmethod
    def parted(words: pa.Array) -> tuple[pa.Array, np.ndarray, list[str]]:
        """For each word its letters (or all of it), and the number of the marks behind them in a list of marks."""
        stems = pc.utf8_rtrim(words, characters=MARKS)
        marks = (pc.binary_length(words).to_numpy() - pc.binary_length(stems).to_numpy()).astype(np.int64)
        plain = pc.ascii_is_alpha(stems)
        latin = pc.and_(pc.utf8_is_alpha(stems), pc.invert(pc.match_substring_regex(stems, NOT_LATIN)))
        apart = pc.and_(pc.or_(plain, latin), pa.array(marks <= MOST_MARKS))
        units = pc.if_else(apart, pc.if_else(plain, pc.ascii_lower(stems), stems), words)
        marks[~apart.to_numpy(zero_copy_only=False)] = 0
        numbers, known = np.zeros(len(words), dtype=np.int64), {"": 0}
        for n in np.unique(marks[marks > 0]).tolist():
            rows = np.flatnonzero(marks == n)
            tails = pc.utf8_slice_codeunits(words.take(pa.array(rows)), start=-n).dictionary_encode()
            own = np.array([known.setdefault(t, len(known)) for t in tails.dictionary.to_pylist()], dtype=np.int64)
            numbers[rows] = own[tails.indices.to_numpy()]
        return units, numbers, list(known)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, and where each text's ids end."""
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        words = lists.flatten().dictionary_encode()
        at = words.indices.to_numpy()
        units, tails, marks = self.parted(words.dictionary)
        units = units.dictionary_encode()
        # One lookup for both: a second one might move what the first found.
        both = pa.concat_arrays([units.dictionary, pa.array(marks, pa.string())]).dictionary_encode()
        numbers = self.lookup(both.dictionary)[both.indices.to_numpy()]
        numbers, marked = numbers[: len(units.dictionary)], numbers[len(units.dictionary) :]
        # Each word is a unit and its marks, the latter often none.
        pieces = np.empty(2 * len(at), dtype=np.int64)
        pieces[0::2] = numbers[units.indices.to_numpy()][at]
        pieces[1::2] = marked[tails][at]
        # A block's positions fit in 32 bits, unless a single text is larger than a block by far.
        each = self.counts[pieces]
        ends = np.cumsum(each)
        kind = np.int32 if not len(ends) or ends[-1] < 1 << 31 else np.int64
        where = np.repeat((self.starts[pieces] - (ends - each)).astype(kind), each)
        where += np.arange(len(where), dtype=kind)
        ends = np.concatenate([[0], ends])
        return self.table[where], ends[2 * (lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py())]

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, ends = self.encode(pa.array(texts, pa.string()))
        return np.split(ids, ends[:-1]) if texts else []


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class TokenStore:
    """A store in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @property
    def chunks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/chunks")

    @property
    def recipes(self) -> DataFrame:
        """The recipes with start, the ids of all documents before."""
        ranges = self.spark.read.parquet(f"{self.folder}/ranges")  # one for each task that wrote recipes
        found = self.spark.read.parquet(f"{self.folder}/recipes").join(F.broadcast(ranges), "range")
        return found.withColumn("start", F.col("range_start") + F.col("within")).drop("range", "range_start", "within")

    @classmethod
    def write(cls, docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None) -> TokenStore:
        spark = docs.sparkSession
        bounded_batches(spark)
        store = cls(spark, folder or new_folder(spark, "token-store"))
        kind = docs.schema["doc_id"].dataType.simpleString()

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = encoder(tokenizer)
            size, last = own.width.itemsize, np.array([end_id], dtype=own.width)
            for batch in blocks(batches):
                n, offsets, digests, lengths, raws, roots = [], [0], [], [], [], []
                all_ids, ends = own.encode(batch.column(1))
                for ids in np.split(all_ids, ends[:-1]):
                    ids = np.concatenate([ids, last])
                    raw, at, first = ids.tobytes(), 0, len(digests)
                    for end in cuts(ids):
                        part = raw[at * size : end * size]
                        digests.append(hashlib.sha256(part).digest())
                        lengths.append(end - at)
                        raws.append(part)
                        at = end
                    n.append(len(ids))
                    offsets.append(len(digests))
                    roots.append(merkle_root(digests[first:]))
                parts = pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(lengths, pa.int32()), pa.array(raws, pa.binary())], ["digest", "n", "ids"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(roots, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts), pa.array(np.full(len(n), size, dtype=np.int32))],
                    ["doc_id", "n_tokens", "root", "chunks", "width"],
                )
            # The worker lives on while others need its memory.
            pa.default_memory_pool().release_unused()

        staged_path = f"{store.folder}/staged"
        schema = f"doc_id {kind}, n_tokens bigint, root binary, chunks array<struct<digest: binary, n: int, ids: binary>>, width int"
        docs.select("doc_id", "text").mapInArrow(cut, schema).withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(staged_path)
        staged = spark.read.parquet(staged_path)

        # Most chunks occur once and are written where they are; only those that may repeat are shuffled.
        digests = staged.select(F.explode("chunks.digest").alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
        repeated = KeyFilter(digests.where("n > 1"), "digest")
        each = staged.select("width", F.explode("chunks").alias("c")).select(F.col("c.digest").alias("digest"), "width", F.col("c.ids").alias("ids"))
        tried = repeated.probed(each, "digest")
        once = tried.where(~F.col("_hit")).unionByName(tried.where("_hit").dropDuplicates(["digest"])).drop("_hit")
        once.write.option("compression", "zstd").parquet(f"{store.folder}/chunks")

        listed = staged.select("doc_id", "row", "n_tokens", "root", F.transform("chunks", lambda c: F.struct(c["digest"].alias("digest"), c["n"].alias("n"))).alias("chunks"))
        store._write_recipes(listed)
        remove(spark, staged_path)
        return store

    def _write_recipes(self, listed: DataFrame) -> None:
        """Ascending by doc_id, within and across files, with each document's place in its range; and each range's start."""
        order = [F.col("doc_id").asc_nulls_first(), F.col("row")]

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before = 0
            for batch in batches:
                n = batch.column(2).to_numpy(zero_copy_only=False)
                ends = before + np.cumsum(n)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - n)], [*batch.schema.names, "within"])
                before = int(ends[-1]) if len(n) else before

        ranged = listed.select("doc_id", "row", "n_tokens", "root", "chunks").repartitionByRange(self._ranges(), *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
        ranged.mapInArrow(placed, f"{kinds}, within bigint").write.parquet(f"{self.folder}/recipes")
        sums = self.spark.read.parquet(f"{self.folder}/recipes").groupBy("range").agg(F.sum("n_tokens").alias("s"))  # a row for each range
        before = sums.select("range", F.coalesce(F.sum("s").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint").alias("range_start"))
        before.write.parquet(f"{self.folder}/ranges")

    def _ranges(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _verified_chunks(self) -> DataFrame:
        """digest, n and the CRC-32 of its ids as 32-bit integers, of every stored chunk whose bytes match its name."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                digests, n, crcs = batch.column(0).to_pylist(), [], []
                for digest, width, raw in zip(digests, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if hashlib.sha256(raw).digest() != digest:
                        raise ValueError(f"the chunk {digest.hex()} is damaged")
                    ids = np.frombuffer(raw, dtype=f"<u{width}")
                    n.append(len(ids))
                    crcs.append(crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(crcs, pa.int64())], ["digest", "n", "crc"])

        return self.chunks.select("digest", "width", "ids").mapInArrow(run, "digest binary, n int, crc bigint")

    def verified(self) -> DataFrame:
        """doc_id, start, n_tokens and ids_crc32 of every document, from the stored bytes."""
        recipes = self.recipes
        uses = recipes.select("row", F.posexplode("chunks").alias("pos", "c")).select("row", "pos", F.col("c.digest").alias("digest"))
        found = uses.join(self._verified_chunks(), "digest", "left")
        parts = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "n", "crc"))).alias("parts"))
        kind = recipes.schema["doc_id"].dataType.simpleString()

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            joiner = CrcJoin()
            for batch in batches:
                lists = batch.column(4)
                offsets, own = lists.offsets.to_numpy(), lists.flatten()
                offsets = offsets - offsets[0]
                n, crcs = own.field("n"), own.field("crc")
                if lists.null_count or n.null_count or (np.diff(offsets) == 0).any():
                    raise ValueError("a document's chunks are missing")
                n, digests = n.to_numpy().astype(np.int64), own.field("digest").to_pylist()
                if batch.num_rows and (np.add.reduceat(n, offsets[:-1]) != batch.column(2).to_numpy()).any():
                    raise ValueError("a document's length is wrong")
                for i, root in enumerate(batch.column(3).to_pylist()):
                    if merkle_root(digests[offsets[i] : offsets[i + 1]]) != root:
                        raise ValueError(f"document {batch.column(0)[i].as_py()} can't be rebuilt")
                found = joiner.joined(crcs.to_numpy(), 4 * n, offsets) if batch.num_rows else np.array([], dtype=np.uint32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(found.astype(np.int64))], ["doc_id", "start", "n_tokens", "ids_crc32"])

        rows = recipes.select("row", "doc_id", "start", "n_tokens", "root").join(parts, "row", "left")
        return rows.select("doc_id", "start", "n_tokens", "root", "parts").mapInArrow(check, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")

    def ids(self) -> DataFrame:
        """doc_id and ids of every document, rebuilt from its chunks."""
        recipes = self.recipes
        uses = recipes.select("row", F.posexplode("chunks").alias("pos", "c")).select("row", "pos", F.col("c.digest").alias("digest"))
        parts = uses.join(self.chunks, "digest").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "width", "ids"))).alias("parts"))
        kind = recipes.schema["doc_id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = [np.concatenate([np.frombuffer(p["ids"], dtype=f"<u{p['width']}").astype(np.int32) for p in parts]) for parts in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

        return recipes.select("row", "doc_id").join(parts, "row").select("doc_id", "parts").mapInArrow(run, f"doc_id {kind}, ids array<int>")
