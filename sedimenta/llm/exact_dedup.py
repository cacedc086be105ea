"""Exact duplicates through a log-structured merge index, in DataFrame operations only.

Every scan task is a memtable: it sorts its digests and flushes them as one run, a file of level 0. Compaction merges
FAN_IN runs of a level into one of the next until one level is left; each merge keeps, for a digest, the smallest identifier in keep
order (most code points, then doc_id) and the number of rows. Digests with more than one row are the hits. A filter over
the hits' rows, by a quick hash of the text as it stands, splits the corpus: rows outside it are unique and need no further
work, rows inside it are compared with their keeper byte by byte, so a collision of digests can't merge different texts.
Each text is normalised and digested once, a candidate's twice.

StoredIndex keeps such an index between batches. A batch is flushed as runs of level 0, each with a filter of its own digests; once
a level has FAN_IN runs they are merged, in order of their digests, into one of the next level, with a new filter. A later batch
looks its digests up: a run is read for those that its filter lets through, and no other. Two batches give what one gives.

Defined results: a null text counts as empty; empty texts are equal to each other; of equal texts the one with the most
code points stays, then the smallest doc_id (null last), and of rows that repeat even these, one. Texts of any length are
read whole. An empty table gives an empty result. Other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.bitfilter import BITS_A_KEY, BUCKET_BITS, KeyFilter
from sedimenta.llm.common import BLANKS, text_or_empty, written


#: Runs that one compaction merges.
FAN_IN = 64


def normalised(column: str = "text") -> Column:
    """The text without its white space."""
    return F.translate(text_or_empty(column), BLANKS, "")


def keep_order(points: str = "_points", doc_id: str = "_id") -> Column:
    """What the row that stays has least of."""
    return F.struct((-F.col(points)).alias("p"), F.col(doc_id).isNull().alias("z"), F.col(doc_id).alias("i"))


class DigestIndex:
    """The index over one corpus. digest_bytes is 32; tests shorten it to force collisions."""

    def __init__(self, digest_bytes: int = 32, fan_in: int = FAN_IN):
        self.digest_bytes = digest_bytes
        self.fan_in = fan_in

    @staticmethod
    def _plain(docs: DataFrame, carry: list[Column]) -> DataFrame:
        """The columns that a scan reads, and a quick hash of the text."""
        return docs.select(F.col("doc_id").alias("_id"), text_or_empty().alias("_text"), F.xxhash64(text_or_empty()).alias("_quick"), *carry)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn("_norm", F.translate("_text", BLANKS, "")).withColumn("_points", F.length("_text"))
        keyed = keyed.withColumn("_sha", F.sha2("_norm", 256)).drop("_text")
        return keyed.withColumn("_digest", F.unhex(F.substring("_sha", 1, 2 * self.digest_bytes)))

    def flush(self, docs: DataFrame, first: int = 0) -> DataFrame:
        """A sorted run (numbered from first) for each memtable, without a shuffle."""
        columns = ["_digest", "_id", "_points", "_quick"] + (["_sha"] if self.digest_bytes < 32 else [])
        return written(self._keyed(self._plain(docs, [])).select(*columns).withColumn("_run", F.spark_partition_id() + F.lit(first)).sortWithinPartitions("_digest"), "lsm-runs")

    def compact(self, runs: DataFrame) -> DataFrame:
        """One row for each digest over all runs: its rows and the keep order of the one that stays (_least), level by level."""
        level = runs.select("_digest", "_run", keep_order().alias("_least"), F.lit(1).cast("long").alias("_rows"))
        left = (runs.agg(F.max("_run")).first()[0] or 0) + 1
        while True:
            left = -(-left // self.fan_in)
            merged = level.withColumn("_run", F.floor(F.col("_run") / self.fan_in)).groupBy("_run", "_digest").agg(F.min("_least").alias("_least"), F.sum("_rows").alias("_rows"))
            if left == 1:  # the last level, of which only the hits are read on
                return merged.drop("_run")
            level = written(merged, "lsm-level")

    def hits(self, level: DataFrame) -> DataFrame:
        return written(level.where("_rows > 1"), "lsm-hits")

    def hit_filters(self, runs: DataFrame, hits: DataFrame) -> tuple[KeyFilter, KeyFilter]:
        """Over the digests that occur more than once, and over the quick hashes of the rows inside that filter."""
        digests = KeyFilter(hits, "_digest")
        return digests, KeyFilter(digests.probed(runs, "_digest").where("_hit").select("_quick").distinct(), "_quick")

    def verified(self, rows: DataFrame, hits: DataFrame) -> DataFrame:
        """The rows of the hits' digests with _keep_id, _size and _kept, after each was compared with its keeper's bytes; others stand alone.

        rows has _digest, _norm, _points, _id and a unique _row. If different texts share a digest, the rows of such
        digests are grouped by their bytes instead.
        """
        found = rows.select("_row", "_digest", keep_order().alias("_own"), "_norm")
        first = found.drop("_norm").join(hits, "_digest").where(F.col("_own") == F.col("_least"))
        # Of rows that repeat the least, one.
        keepers = first.groupBy("_digest").agg(F.min("_row").alias("_keep_row"), F.first("_least.i").alias("_keep_id"), F.first("_rows").alias("_size"))
        keepers = found.select(F.col("_row").alias("_keep_row"), F.col("_norm").alias("_keep_norm")).join(keepers, "_keep_row")
        compared = found.select("_row", "_digest", "_norm").join(keepers, "_digest").select("_row", "_digest", "_keep_row", "_keep_id", "_size", (F.col("_norm") == F.col("_keep_norm")).alias("_same"))
        compared = written(compared, "lsm-verified")
        settled = compared
        clashing = compared.where(~F.col("_same")).select("_digest").distinct()
        if not compared.where(~F.col("_same")).isEmpty():
            settled = compared.join(clashing, "_digest", "left_anti")
            order = F.struct(keep_order().alias("o"), F.col("_row").alias("r"))
            mixed = rows.join(clashing, "_digest", "left_semi")
            exact = mixed.groupBy("_digest", "_norm").agg(F.min(order).alias("_k"), F.count(F.lit(1)).alias("_size"))
            exact = mixed.join(exact, ["_digest", "_norm"]).select("_row", "_digest", F.col("_k.r").alias("_keep_row"), F.col("_k.o.i").alias("_keep_id"), "_size", F.lit(True).alias("_same"))
            settled = settled.unionByName(exact)
        return settled.select("_row", "_keep_id", "_size", (F.col("_row") == F.col("_keep_row")).alias("_kept"))

    def _candidates(self, docs: DataFrame, quick: KeyFilter, digests: KeyFilter, carry: list[Column]) -> DataFrame:
        """The rows inside both filters, each normalised and digested, with a number."""
        inside = self._keyed(quick.probed(self._plain(docs, carry), "_quick").where("_hit").drop("_hit"))
        inside = digests.probed(inside, "_digest").where("_hit").drop("_hit", "_quick")
        return written(inside.withColumn("_row", F.monotonically_increasing_id()), "lsm-candidates")

    def groups(self, docs: DataFrame) -> DataFrame:
        """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
        runs = self.flush(docs)
        hits = self.hits(self.compact(runs))
        digests, quick = self.hit_filters(runs, hits)
        sha = F.lower(F.hex("_digest")) if self.digest_bytes == 32 else F.col("_sha")
        alone = digests.probed(runs, "_digest").where(~F.col("_hit"))
        alone = alone.select(F.col("_id").alias("doc_id"), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha.alias("text_sha256"))
        rows = self._candidates(docs, quick, digests, [])
        # A row inside the filter whose digest is no hit is unique.
        shared = rows.select("_row", "_id", "_sha").join(self.verified(rows, hits), "_row", "left")
        single = F.col("_kept").isNull()
        shared = shared.select(
            F.col("_id").alias("doc_id"),
            F.when(single, F.col("_id")).otherwise(F.col("_keep_id")).alias("keep_id"),
            F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
            F.coalesce("_kept", F.lit(True)).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
        return alone.unionByName(shared)

    def survivors(self, docs: DataFrame) -> DataFrame:
        """The rows of docs that stay, with all their columns; unique rows go through without a shuffle."""
        runs = self.flush(docs)
        hits = self.hits(self.compact(runs))
        digests, quick = self.hit_filters(runs, hits)
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
        # The quick hash alone decides what may repeat, so rows outside it aren't normalised again.
        tried = quick.probed(docs.select(whole, F.xxhash64(text_or_empty()).alias("_quick")), "_quick")
        alone = tried.where(~F.col("_hit")).select("_whole.*")
        inside = self._keyed(quick.probed(self._plain(docs, [whole]), "_quick").where("_hit").drop("_hit")).drop("_quick")
        rows = written(inside.withColumn("_row", F.monotonically_increasing_id()), "lsm-candidates")
        dropped = self.verified(rows, hits).where(~F.col("_kept")).select("_row")
        return alone.unionByName(rows.select("_row", "_whole").join(dropped, "_row", "left_anti").select("_whole.*"))


def exact_groups(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    return DigestIndex(digest_bytes).groups(docs)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    return DigestIndex().survivors(docs)


class StoredIndex:
    """A log-structured merge index that batches are added to and looked up in.

    Rows of a run are _run, _level, _digest, _least (keep order of the row that stays) and _rows. Of runs there are FAN_IN - 1 a level
    at most after an insert, and levels grow with the logarithm of what is held, so a lookup asks a bounded number of filters.
    """

    def __init__(self, spark: SparkSession, digest_bytes: int = 32, fan_in: int = FAN_IN):
        self.spark, self.index, self.fan_in = spark, DigestIndex(digest_bytes, fan_in), fan_in
        self.runs: dict[int, tuple[int, DataFrame, DataFrame]] = {}  # level: runs, rows, filters
        self.next_run = 0

    @staticmethod
    def filters(rows: DataFrame) -> DataFrame:
        """_run, _buckets (a power of two, by the run's rows), _bucket and its bits: what a run's digests set."""
        counts = rows.groupBy(F.col("_run").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
        buckets = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("_n") * BITS_A_KEY / F.lit(float(BUCKET_BITS)), F.lit(1.0))))).cast("bigint")
        sized = rows.join(counts.withColumn("_buckets", buckets), F.col("_run") == F.col("_r"))
        slot = F.pmod(F.xxhash64("_digest"), F.col("_buckets") * BUCKET_BITS)
        placed = sized.select("_run", "_buckets", F.floor(slot / BUCKET_BITS).alias("_bucket"), (slot % BUCKET_BITS).alias("_bit"))
        return written(placed.groupBy("_run", "_buckets", "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "lsm-run-filters")

    def insert(self, docs: DataFrame) -> None:
        """Flushes a batch as runs of level 0 and compacts the levels that are full."""
        flushed = self.index.flush(docs, self.next_run)
        rows = flushed.select("_run", "_digest", keep_order().alias("_least"), F.lit(1).cast("long").alias("_rows"))
        # Within its run a digest is one row; only these leave it.
        rows = written(rows.groupBy("_run", "_digest").agg(F.min("_least").alias("_least"), F.sum("_rows").alias("_rows")).sortWithinPartitions("_run", "_digest"), "lsm-level")
        self._put(0, rows)

    def _put(self, level: int, rows: DataFrame) -> None:
        found = rows.agg(F.count_distinct("_run").alias("n"), F.max("_run").alias("last")).first()
        if not found.n:
            return
        self.next_run = max(self.next_run, found.last + 1)
        runs, held, filters = self.runs.get(level, (0, None, None))
        held = rows if held is None else held.unionByName(rows)
        if runs + found.n < self.fan_in:
            more = self.filters(rows)
            self.runs[level] = (runs + found.n, held, more if filters is None else filters.unionByName(more))
            return
        # min() over structs is a sort aggregate: streams in order of digests are merged, equal ones combined as they meet.
        merged = held.groupBy("_digest").agg(F.min("_least").alias("_least"), F.sum("_rows").alias("_rows")).withColumn("_run", F.lit(self.next_run))
        self.runs.pop(level, None)
        self._put(level + 1, written(merged.select("_run", "_digest", "_least", "_rows").sortWithinPartitions("_digest"), "lsm-level"))

    def candidates(self, digests: DataFrame) -> DataFrame:
        """_digest and _run of the runs whose filter lets a digest through; digests has _digest, each once."""
        out = None
        for _, rows, filters in self.runs.values():
            sizes = [(r["_run"], r["_buckets"]) for r in filters.select("_run", "_buckets").distinct().collect()]  # fan_in at most
            tries = F.explode(F.array(*[F.struct(F.lit(r).alias("run"), F.lit(b).alias("buckets")) for r, b in sizes]))
            asked = digests.select("_digest", tries.alias("t"))
            slot = F.pmod(F.xxhash64("_digest"), F.col("t.buckets") * BUCKET_BITS)
            asked = asked.select("_digest", F.col("t.run").alias("_run"), F.floor(slot / BUCKET_BITS).alias("_bucket"), (slot % BUCKET_BITS).alias("_bit"))
            met = asked.join(filters.drop("_buckets"), ["_run", "_bucket"])
            byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            hits = met.where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) > 0).select("_digest", "_run")
            out = hits if out is None else out.unionByName(hits)
        return digests.select("_digest", F.lit(0).alias("_run")).limit(0) if out is None else out

    def lookup(self, digests: DataFrame) -> DataFrame:
        """_digest, _least and _rows of the digests that the index holds, over all runs."""
        asked = written(self.candidates(digests), "lsm-asked")
        out = None
        for _, rows, _ in self.runs.values():
            hits = rows.join(asked, ["_run", "_digest"])
            out = hits if out is None else out.unionByName(hits)
        if out is None:
            return asked.select("_digest").limit(0).withColumns({"_least": F.lit(None), "_rows": F.lit(0)})
        return out.groupBy("_digest").agg(F.min("_least").alias("_least"), F.sum("_rows").alias("_rows"))

    def groups(self, batch: DataFrame, texts: DataFrame) -> DataFrame:
        """What groups() gives for the rows of a batch that was inserted, with keepers and sizes over all that the index holds.

        texts has doc_id and text of all that was inserted: hits are verified against the bytes of the rows that share
        their digest. Rows of digests that the batch shares with nothing are read from the index alone.
        """
        keyed = self.index._keyed(self.index._plain(batch, [])).drop("_quick")
        keyed = written(keyed.withColumn("_row", F.monotonically_increasing_id()), "lsm-batch")
        known = written(self.lookup(keyed.select("_digest").distinct()), "lsm-known")
        hits = known.where("_rows > 1")
        alone = keyed.join(hits.select("_digest"), "_digest", "left_anti").select(F.col("_id").alias("doc_id"), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("_sha").alias("text_sha256"))
        held = self.index._keyed(self.index._plain(texts, [])).drop("_quick").join(hits.select("_digest"), "_digest", "left_semi")
        held = written(held.withColumn("_row", F.monotonically_increasing_id()), "lsm-held")
        verified = held.select("_row", "_id", "_sha", "_points").join(self.index.verified(held, hits), "_row")
        own = keyed.groupBy(F.col("_id").alias("_i"), F.col("_sha").alias("_s"), F.col("_points").alias("_p")).agg(F.count(F.lit(1)).alias("_copies"))
        # Rows of the batch are those of the held ones with its id, text and length; copies beyond the batch's own aren't its.
        rank = F.row_number().over(Window.partitionBy("_id", "_sha", "_points").orderBy(F.col("_kept").desc(), "_row"))
        shared = verified.withColumn("_n", rank).join(own, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_sha") == F.col("_s")) & (F.col("_points") == F.col("_p"))).where("_n <= _copies")
        return alone.unionByName(shared.select(F.col("_id").alias("doc_id"), F.col("_keep_id").alias("keep_id"), F.col("_size").alias("group_size"), F.col("_kept").alias("kept"), F.col("_sha").alias("text_sha256")))
