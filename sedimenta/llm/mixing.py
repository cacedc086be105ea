"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target gives its documents an expected number of copies: a whole part, and a fraction that must be rounded.
Rounding pairs fractions and moves mass between the two, at random and without bias, until one is 0 or 1; the mass moved is
in words, so the words taken stay exactly what was expected. Groups of documents of one source round among themselves and
leave one residual fraction each; residuals meet in groups of the next level of a tree, until one is left for each source.
So a source's words differ from its target by the size of one document at most.

Groups, pairs and coins depend on hashes of the rows only, so reruns agree whatever the partitioning. Rows that repeat in
every way are counted and numbered, and each number has a hash of its own, so they are dealt like others.

Targets are min(cap * size, weight * level) of each source, with one level for all at which they sum up to the share of all
words: it starts as if no source were full, and each round raises it by what full sources leave. Only sums reach the
driver, so sources may be any number.

Defined results: a null text counts as empty and has size 0; texts of any length are read whole. Rows that repeat are
documents of their own; of rows that repeat in every way, which of them takes a copy doesn't matter. A source whose
documents have no words takes none (target 0). An empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, text_or_empty, utf8, written
from sedimenta.operators.schedule import numbered

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
#: Documents, or residuals, that are rounded together.
GROUP_ROWS = 4096
#: Sources up to which their table is sent to every task.
BROADCAST_SOURCES = 10_000
SEED = 20_240


def words(text: str | None) -> int:
    """Runs of anything but the six ASCII blanks."""
    return len(utf8(text).split())


def pivotal(size: np.ndarray, fraction: np.ndarray, coins: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounded fractions, and the place of the one that stays fractional (-1: none). sum(size * fraction) is kept."""
    out = np.zeros(len(size), dtype=np.float64)
    held, p = -1, 0.0
    for k in range(len(size)):
        q = float(fraction[k])
        if q <= 0.0 or q >= 1.0 or size[k] <= 0:
            out[k] = 1.0 if q >= 1.0 and size[k] > 0 else 0.0
            continue
        if held < 0:
            held, p = k, q
            continue
        a, b = float(size[held]), float(size[k])
        up = min((1 - p) * a, q * b)  # words that can move to the held one
        down = min(p * a, (1 - q) * b)  # words that can move from it
        if coins[k] < down / (up + down):
            held_full, moved = (1 - p) * a <= q * b, up
            p, q = (1.0, q - moved / b) if held_full else (p + moved / a, 0.0)
        else:
            held_empty, moved = p * a <= (1 - q) * b, down
            p, q = (0.0, q + moved / b) if held_empty else (p - moved / a, 1.0)
        if p in (0.0, 1.0):
            out[held], held, p = p, k, q
            if q <= 1e-12 or q >= 1 - 1e-12:  # both at once
                out[k], held = float(q > 0.5), -1
        else:
            out[k] = q
            if p <= 1e-12 or p >= 1 - 1e-12:
                out[held], held = float(p > 0.5), -1
    if held >= 0:
        out[held] = p
    return out, held


class Mix:
    """The mix of one corpus."""

    def __init__(self, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, group_rows: int = GROUP_ROWS):
        self.weights, self.share, self.cap, self.group_rows = tuple(weights), share, cap, group_rows

    def sized(self, docs: DataFrame) -> DataFrame:
        """doc_id, source, size and the order that rounding follows, a hash of id and text."""
        bounded_batches(docs.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = pa.array([words(t) for t in batch.column(3).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), sizes], ["doc_id", "source", "ord", "size"])

        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.select("doc_id", "source", self.order(docs).alias("ord"), "text").mapInArrow(run, f"doc_id {kind}, source string, ord bigint, size bigint")

    @staticmethod
    def order(docs: DataFrame) -> Column:
        return F.xxhash64(F.lit(SEED), F.col("doc_id"), text_or_empty(), F.col("source"))

    def source_targets(self, sized: DataFrame) -> DataFrame:
        """_source, source_size, target and source_rows of every source."""
        sums = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
        order = F.col("source").asc_nulls_last()
        placed = sums.repartitionByRange(int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions")), order).withColumn("_range", F.spark_partition_id())
        placed = written(placed, "mix-sources")
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
        offsets = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
        own = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
        weights = F.array(*[F.lit(float(w)) for w in self.weights])
        rank = F.col("_before") + F.col("_own")
        placed = placed.withColumn("_own", own).join(offsets, "_range").withColumn("_weight", F.element_at(weights, (F.pmod(rank, F.lit(len(self.weights))) + 1).cast("int")))
        placed = written(placed.select("source", "source_size", "source_rows", "_weight"), "mix-weights")
        full_size = F.col("source_size") * F.lit(self.cap)
        level = None
        while True:
            full = F.lit(False) if level is None else F.col("_weight") * F.lit(level) > full_size
            row = placed.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, full_size)).alias("full"), F.sum(F.when(~full, F.col("_weight"))).alias("free")).first()
            if not row["free"]:
                level = float("inf")
                break
            higher = (self.share * (row["all"] or 0) - (row["full"] or 0.0)) / row["free"]
            if level is not None and higher <= level:
                break
            level = higher
        aims = placed.select(F.col("source").alias("_source"), "source_size", F.least(full_size, F.col("_weight") * F.lit(level)).alias("target"), "source_rows")
        return F.broadcast(aims) if placed.count() <= BROADCAST_SOURCES else aims

    def apart(self, sized: DataFrame) -> DataFrame:
        """sized with a hash of its own for each row, and base, the one it shares with rows that repeat it: these are counted and written out again."""
        keys = ["doc_id", "source", "ord", "size"]
        counted = written(sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "mix-counted")
        again = counted.where("_n > 1").select(*keys, "_n", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / self.group_rows))).alias("_block"))
        # Blocks are dealt anew before they are written out, as one row may stand for many.
        again = again.repartition(F.xxhash64("ord", "_block")).withColumn("_low", F.col("_block") * self.group_rows)
        again = again.select(*keys, F.explode(F.sequence(F.col("_low"), F.least(F.col("_low") + self.group_rows, F.col("_n")) - 1)).alias("_k"))
        again = again.select("doc_id", "source", F.xxhash64(F.lit(SEED), "ord", "_k").alias("ord"), "size", F.col("ord").alias("base"))
        return counted.where("_n = 1").select(*keys, F.col("ord").alias("base")).unionByName(again)

    def copies(self, docs: DataFrame) -> DataFrame:
        """doc_id, source, ord, base, size, source_size, target and copies (0, 1 or 2) of every row."""
        spark = docs.sparkSession
        sized = written(self.apart(self.sized(docs)), "mix-sizes")
        aims = self.source_targets(sized)
        rows = sized.join(aims, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        expected = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(self.cap))).otherwise(0.0)
        rows = rows.withColumn("whole", F.floor(expected)).withColumn("fraction", expected - F.floor(expected))
        # A group has GROUP_ROWS rows on average, so hot sources are dealt to many tasks.
        rows = rows.withColumn("groups", F.ceil(F.col("source_rows") / self.group_rows)).withColumn("group", F.pmod("ord", "groups"))
        kind = sized.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {kind}, source string, ord bigint, base bigint, size bigint, source_size bigint, target double, whole bigint, fraction double, groups bigint, group bigint, done boolean"

        def settle(rows: pa.Table) -> pa.Table:
            ord_, size, fraction, coin = (rows[c].to_numpy() for c in ("ord", "size", "fraction", "coin"))
            by = np.lexsort((fraction, size, ord_))
            rows = rows.take(pa.array(by)).drop_columns(["coin"])
            coins = (coin[by].view(np.uint64) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
            rounded, left = pivotal(size[by], fraction[by], coins)
            done = np.ones(len(by), dtype=bool)
            if left >= 0:
                done[left] = False
            rows = rows.set_column(rows.schema.get_field_index("fraction"), "fraction", pa.array(rounded))
            return rows.set_column(rows.schema.get_field_index("done"), "done", pa.array(done))

        columns = [c.split()[0] for c in schema.split(", ")]
        settled, level, most, height = [], rows.withColumn("done", F.lit(False)).select(*columns), None, 0
        while True:
            height += 1  # a residual has a fresh coin on each level
            level = level.withColumn("coin", F.xxhash64(F.lit(SEED), F.lit(height), "ord"))
            most = level.agg(F.max("groups")).first()[0]
            level = written(level.groupBy("source", "group").applyInArrow(settle, schema), "mix-level")
            settled.append(level.where("done"))
            level = level.where("not done")
            if most is None or most <= 1:
                break
            fewer = F.ceil(F.col("groups") / self.group_rows)
            level = level.withColumn("groups", fewer).withColumn("group", F.pmod("group", "groups")).select(*columns)
        # One residual is left for each source at most; a coin of its own settles it.
        coin = F.pmod(F.xxhash64(F.lit(SEED + 1), "ord"), F.lit(1 << 30)) / float(1 << 30)
        settled.append(level.withColumn("fraction", (coin < F.col("fraction")).cast("double")))
        out = settled[0]
        for more in settled[1:]:
            out = out.unionByName(more)
        return out.select("doc_id", "source", "ord", "base", "size", "source_size", "target", (F.col("whole") + F.col("fraction").cast("bigint")).alias("copies"))

    def taken(self, docs: DataFrame) -> DataFrame:
        """doc_id, size, source_size, target and taken of every row."""
        return self.copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))

    def mixed(self, docs: DataFrame) -> DataFrame:
        """docs with each row as often as the mix takes it, all columns kept."""
        count = lambda n: F.sum((F.col("copies") == n).cast("int"))
        found = written(self.copies(docs), "mix-copies")
        own = written(found.groupBy(F.col("doc_id").alias("_id"), F.col("base").alias("_key")).agg(F.count(F.lit(1)).alias("_n"), count(1).alias("_once"), count(2).alias("_twice")), "mix-counts")
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
        rows = docs.select(whole, F.col("doc_id").alias("_doc"), self.order(docs).alias("_ord"))
        rows = rows.join(own, (F.col("_ord") == F.col("_key")) & F.col("_doc").eqNullSafe(F.col("_id"))).drop("_id", "_doc")
        single = rows.where("_n = 1").withColumn("_k", F.lit(1).cast("bigint"))
        # Rows that repeat a doc_id, text and source are numbered, so that each takes copies of its own.
        if own.where("_n > 1").isEmpty():
            every = single
        else:
            every = single.unionByName(self._placed(rows.where("_n > 1")))
        copies = F.when(F.col("_k") <= F.col("_twice"), 2).when(F.col("_k") <= F.col("_twice") + F.col("_once"), 1).otherwise(0)
        return every.select("_whole", F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy")).select("_whole.*")

    @staticmethod
    def _placed(rows: DataFrame) -> DataFrame:
        """rows with their number (_k) from 1 among those of the same id, text and source."""
        ordered = rows.select("*", F.xxhash64("_whole").alias("_order"), F.monotonically_increasing_id().alias("_at"))
        return numbered(ordered, ["_ord"], [F.col("_order"), F.col("_at")], "_k").drop("_order", "_at").withColumn("_k", F.col("_k").cast("bigint"))
