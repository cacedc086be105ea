"""SimHash near-duplicates: fingerprints, a generalised pigeonhole search within a Hamming radius, and components.

The 64 bits are grouped into parts so that correlated bits lie together. Each fingerprint gets its own thresholds, one
for each part: if they sum to radius - parts + 1, any fingerprint within the radius differs by at most the threshold in
some part (a part with threshold -1 is not probed). Dynamic programming picks the thresholds with the least estimated
candidates and probes, so frequent values of a part are left out. Probes meet an index of all fingerprints' parts and each
candidate is verified on all bits. The search is exact: statistics only steer its cost.

Equal fingerprints are one class from the start; copies are never expanded into pairs. A fingerprint has at most 2,080
others within two bits, so links are bounded by the number of different fingerprints.

SimilarRows is the search with its candidates verified on texts: near copies are documents whose sets of five-word shingles
have a Jaccard similarity of 0.8 or more, found among the documents whose word fingerprints lie within NEAR_RADIUS bits. An
edit changes five shingles but one word, so fingerprints of words (weighed by the logarithm of their counts) lie closer. First
each document is held against a centre of its buckets, in crowded buckets against CENTRES, so most of a large group of copies
is one component after a few comparisons of each. Then all that lies within the radius in different components is compared:
outside of crowds pair by pair; within, only documents that share a rare shingle, as similar ones must, and never those of
one large component among each other. What a crowd's text gives to most copies is not looked up pair by pair: each document
counts its frequent shingles in groups, and two share at most the lesser count of each. Every pair within the radius is thus
verified, linked over others, or shown to be too different; similar pairs beyond the radius are missed.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any other. Rows that repeat are in
one component. A null doc_id is never a component's id unless it has no other. Texts of any length
are read whole; an empty table gives an empty result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.bitfilter import KeyFilter
from sedimenta.llm.common import bounded_batches, joined_rows, utf8, written

BITS = 64
SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Bits in which the word fingerprints of near copies may differ.
NEAR_RADIUS = 6
#: Near copies: words of a shingle, and the least similarity as a fraction.
NEAR_SHINGLE_WORDS = 5
LEAST = (4, 5)
#: Fingerprints near a bucket's centre (or rows of one fingerprint) that are a crowd, and the centres that a crowd has.
CROWD = 8
CENTRES = 8
#: Rows near a fingerprint outside of crowds from which it is compared as one of a crowd.
DENSE = 32
#: Fingerprints of one component from which their pairs are kept out of the search between components.
LARGE_COMPONENT = 64
#: Rows of crowds from which a shingle that they share is frequent, and the groups that frequent shingles are counted in.
FREQUENT_ROWS = 64
FREQUENT_GROUPS = 24
#: Fingerprints, and probes of each, that are made as one block.
BLOCK_ROWS = 4096
BLOCK_MASKS = 64
#: A part's values with more than this share of all fingerprints are counted exactly: 1,024 values for a part at most.
FREQUENT_SHARE = 1 / 1024
#: What a probe costs, in candidates: a probe is shuffled and sorted, a candidate only compared.
PROBE_COST = 50.0

#: Numbers that part and value of a key are mixed with.
_PART_MIX, _KEY_MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)

_LANES = np.arange(8, dtype=np.int64) * 256
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(text: str | None, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned SimHash of a whole text; a bit is set if more than half of the shingles' hashes have it."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= words_in_shingle:
        return h(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(words_in_shingle)), strict=False))
    n = len(words) - words_in_shingle + 1
    hashes = np.fromiter((h(s, SEED) for s in shingles), dtype=np.uint64, count=n)
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _LANES).ravel(), minlength=2048).reshape(8, 256)
    return int(_WEIGHTS[(2 * (seen @ _BYTE_BITS) > n).ravel()].sum(dtype=np.uint64))


def word_fingerprint(text: str | None) -> int:
    """The SimHash of the different words, each weighed by the logarithm of its count (in sixteenths, so that sums are exact)."""
    counts = Counter(utf8(text).lower().split())
    if not counts:
        return 0
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(w, SEED) for w in counts), dtype=np.uint64, count=len(counts))
    weights = np.rint(16 * np.log2(1 + np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))).astype(np.int64)
    seen = np.array([np.bincount(column, weights=weights, minlength=256) for column in hashes.view(np.uint8).reshape(-1, 8).T])
    return int(_WEIGHTS[(2 * (seen @ _BYTE_BITS) > weights.sum()).ravel()].sum(dtype=np.uint64))


def shingles(text: str | None) -> np.ndarray:
    """The hashes of the different five-word shingles, in order; five words or fewer are one."""
    words = utf8(text).lower().split()
    h = xxhash.xxh64_intdigest
    if len(words) <= NEAR_SHINGLE_WORDS:
        return np.array([h(b" ".join(words), SEED)], dtype=np.uint64)
    found = map(b" ".join, zip(*(words[i:] for i in range(NEAR_SHINGLE_WORDS)), strict=False))
    return np.unique(np.fromiter((h(s, SEED) for s in found), dtype=np.uint64, count=len(words) - NEAR_SHINGLE_WORDS + 1))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * shared >= LEAST[0] * (len(a) + len(b) - shared)


def fingerprints(docs: DataFrame, words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of every row."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words_in_shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def _as_bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


@dataclass
class Plan:
    """Groups of bits, and what is known of their values: all of a size that doesn't grow with the corpus."""

    radius: int
    groups: list[list[int]]
    total: int = 0
    #: For each part, its two halves' histograms.
    halves: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    #: For each part, its frequent values and their exact counts.
    frequent: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    known_near: list[list[np.ndarray]] | None = None

    def values(self, bits: np.ndarray) -> list[np.ndarray]:
        """Each part's value of every fingerprint."""
        return [(bits[:, g].astype(np.uint64) << np.arange(len(g), dtype=np.uint64)).sum(axis=1, dtype=np.uint64) for g in self.groups]

    def split(self, part: int) -> tuple[int, int]:
        width = len(self.groups[part])
        return min(16, width // 2), min(16, width - width // 2)

    def half_values(self, part: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.split(part)
        return (values & np.uint64((1 << low) - 1)).astype(np.int64), ((values >> np.uint64(low)) & np.uint64((1 << high) - 1)).astype(np.int64)

    def near(self) -> list[list[np.ndarray]]:
        """For each part and half, the count of fingerprints at each distance up to the radius from each value."""
        if self.known_near is not None:
            return self.known_near
        out = []
        for pair in self.halves:
            tables = []
            for histogram in pair:
                ids, rows = np.arange(len(histogram)), np.zeros((self.radius + 1, len(histogram)))
                rows[0] = histogram
                for bit in range(int(np.log2(len(histogram)))):  # each bit is flipped or not
                    rows[1:] += rows[:-1][:, ids ^ (1 << bit)]
                tables.append(rows)
            out.append(tables)
        self.known_near = out
        return out


def correlated_groups(moments: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in groups of nearly equal width: each starts at the strongest free correlation and takes the bit most correlated with it."""
    mean = np.diag(moments) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    strength = np.abs((moments / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        own = strength[np.ix_(free, free)]
        group = [free.pop(int(own.max(axis=1).argmax()))]
        while len(group) < width:
            best = max(free, key=lambda b: (strength[b, group].sum(), -b))
            free.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def thresholds(plan: Plan, values: list[np.ndarray], near: list[list[np.ndarray]]) -> np.ndarray:
    """The cheapest thresholds of each fingerprint, one column for each part, by dynamic programming over the parts."""
    parts, n, top = len(plan.groups), len(values[0]), plan.radius
    cost = np.zeros((parts, top + 2, n))  # [part][threshold + 1]
    for i, own in enumerate(values):
        low, high = plan.half_values(i, own)
        scale = 1 / max(plan.total, 1)
        seen, width = np.zeros(n), len(plan.groups[i])
        for t in range(top + 1):
            for d in range(t + 1):
                seen = seen + near[i][0][d][low] * near[i][1][t - d][high] * scale
            known = seen
            keys, counts = plan.frequent[i]
            if len(keys):
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                known = np.maximum(seen, np.where(keys[at] == own, counts[at], 0))
            cost[i, t + 1] = known + PROBE_COST * sum(comb(width, d) for d in range(t + 1))
    # The thresholds, each plus one, sum to radius + 1.
    whole = top + 1
    best = np.full((whole + 1, n), np.inf)
    best[0] = 0
    chosen = np.zeros((parts, whole + 1, n), dtype=np.int8)
    for i in range(parts):
        after = np.full_like(best, np.inf)
        for s in range(whole + 1):
            for t in range(min(s, top + 1) + 1):
                way = best[s - t] + cost[i, t]
                better = way < after[s]
                after[s][better] = way[better]
                chosen[i, s][better] = t
        best = after
    out, left, rows = np.zeros((n, parts), dtype=np.int64), np.full(n, whole), np.arange(n)
    for i in reversed(range(parts)):
        t = chosen[i, left, rows].astype(np.int64)
        out[:, i], left = t - 1, left - t
    return out


def cheapest_parts(n: int, radius: int) -> int:
    """The number of parts, two at least, with the least cost of probes and candidates if n fingerprints lie evenly."""

    def cost(parts: int) -> float:
        out = 0.0
        for i in range(parts):
            width = BITS // parts + (i < BITS % parts)
            allowed = (radius - parts + 1) // parts + (i < (radius - parts + 1) % parts)
            probes = sum(comb(width, d) for d in range(allowed + 1))
            out += probes * (PROBE_COST + n / 2**width)
        return out

    return min(range(2, radius + 2), key=cost)


class PigeonholeSearch:
    """Pairs of different fingerprints within the radius."""

    def __init__(self, classes: DataFrame, radius: int = RADIUS, parts: int | None = None):
        self.points = classes.select("fp")
        self.radius, self.parts = radius, parts
        self._plan: Plan | None = None

    def plan(self) -> Plan:
        if self._plan is None:
            self._plan = self._learn()
        return self._plan

    def _learn(self) -> Plan:
        fps = self.points.select("fp")
        n = fps.count()
        parts = self.parts or cheapest_parts(n, self.radius)

        def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((BITS, BITS))
            for batch in joined_rows(batches, BLOCK_ROWS):
                bits = _as_bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
                total += bits.T @ bits
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS, dtype=np.int32)), pa.array(total.ravel())], ["cell", "v"])

        sums = np.zeros(BITS * BITS)
        for row in fps.mapInArrow(moments, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():  # 4,096 rows
            sums[row.cell] = row.v
        plan = Plan(self.radius, correlated_groups(sums.reshape(BITS, BITS), n, parts), n)

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: dict[tuple[int, int], np.ndarray] = {}
            for batch in joined_rows(batches, BLOCK_ROWS):
                values = plan.values(_as_bits(batch.column(0).to_numpy(zero_copy_only=False)))
                for i, own in enumerate(values):
                    for h, half in enumerate(plan.half_values(i, own)):
                        more = np.bincount(half, minlength=1 << plan.split(i)[h])
                        counts[i, h] = counts.get((i, h), 0) + more
            for (i, h), c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), 2 * i + h, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))], ["half", "value", "n"])

        tables = [[np.zeros(1 << w) for w in plan.split(i)] for i in range(parts)]
        for row in fps.mapInArrow(histograms, "half int, value int, n bigint").groupBy("half", "value").agg(F.sum("n").alias("n")).collect():  # two tables of 65,536 rows a part at most
            tables[row.half // 2][row.half % 2][row.value] = row.n
        plan.halves = [tuple(pair) for pair in tables]

        def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in joined_rows(batches, BLOCK_ROWS):
                for i, own in enumerate(plan.values(_as_bits(batch.column(0).to_numpy(zero_copy_only=False)))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), i, dtype=np.int8)), pa.array(own.view(np.int64))], ["part", "value"])

        each = fps.mapInArrow(values, "part tinyint, value bigint").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
        often = each.where(F.col("n") > max(8, n * FREQUENT_SHARE)).collect()  # 1,024 rows a part at most
        for i in range(parts):
            own = sorted((row.value & (2**64 - 1), row.n) for row in often if row.part == i)
            plan.frequent.append((np.array([k for k, _ in own], dtype=np.uint64), np.array([c for _, c in own], dtype=np.float64)))
        return plan

    def _mapped(self, points: DataFrame, name: str, make: Callable[[np.ndarray], Iterator[tuple]]) -> DataFrame:
        """key (part and value mixed) and the fingerprint as name; make(fps) gives part, values and the places of their fingerprints."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in joined_rows(batches, BLOCK_ROWS):
                fps = batch.column(0).to_numpy(zero_copy_only=False)
                for part, values, at in make(fps):
                    mixed = (values + np.array([part], dtype=np.uint64) * _PART_MIX) * _KEY_MIX
                    yield pa.RecordBatch.from_arrays([pa.array(mixed.view(np.int64)), pa.array(fps[at])], ["key", name])

        return points.mapInArrow(run, f"key bigint, {name} bigint")

    def index(self, points: DataFrame | None = None) -> DataFrame:
        """A row for each part of each fingerprint."""
        plan = self.plan()

        def make(fps: np.ndarray) -> Iterator[tuple]:
            every = np.arange(len(fps))
            for i, own in enumerate(plan.values(_as_bits(fps))):
                yield i, own, every

        return self._mapped(self.points if points is None else points, "fp", make)

    def probes(self, points: DataFrame | None = None) -> DataFrame:
        """The values to look up for each fingerprint, under its own thresholds."""
        plan = self.plan()

        def make(fps: np.ndarray) -> Iterator[tuple]:
            near, values = plan.near(), plan.values(_as_bits(fps))
            allotted = thresholds(plan, values, near)
            for i, own in enumerate(values):
                for d in range(plan.radius + 1):
                    rows = np.flatnonzero(allotted[:, i] >= d)
                    if not len(rows):
                        break
                    masks = np.array([sum(1 << b for b in chosen) for chosen in combinations(range(len(plan.groups[i])), d)], dtype=np.uint64)
                    for at in range(0, len(masks), BLOCK_MASKS):
                        some = masks[at : at + BLOCK_MASKS]
                        yield i, (own[rows][:, None] ^ some[None, :]).ravel(), np.repeat(rows, len(some))

        return self._mapped(self.points if points is None else points, "probe", make)

    def within(self) -> Column:
        return F.bit_count(F.col("probe").bitwiseXOR(F.col("fp"))) <= self.radius

    def links(self, probing: DataFrame | None = None) -> DataFrame:
        """a and b (a < b) of every pair of different fingerprints within the radius, once each; with probing, of those with one of its points."""
        order = F.col("probe") < F.col("fp") if probing is None else F.col("probe") != F.col("fp")
        found = self.probes(probing).join(self.index(), "key").where(order & self.within())
        return found.select(F.least("probe", "fp").alias("a"), F.greatest("probe", "fp").alias("b")).distinct()

    def stars(self) -> tuple[DataFrame, DataFrame]:
        """a and b of fingerprints within the radius, one of them a centre of a bucket of both; and the fingerprints (fp) in crowds.

        A bucket has one centre, a crowd CENTRES: those with the least hashes, so that buckets of one group share them, and
        those nearest to what most of the crowd have. Pairs grow with the fingerprints only.
        """
        index = written(self.index(), "pigeonholes")
        centres = index.groupBy("key").agg(F.min(F.struct(F.xxhash64("fp"), "fp"))["fp"].alias("probe"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        near = written(index.join(centres, "key").where(self.within()), "near-centres")
        # Sums of each bit in eight columns of eight bytes: a crowd's majority, without its fingerprints in one place.
        votes = [F.sum(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(BITS)]
        crowds = near.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *votes).where(F.col("n") >= CROWD)
        bits = [F.when(2 * F.col(f"b{b}") > F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")) for b in range(BITS)]
        crowds = written(crowds.select("key", reduce(Column.bitwiseOR, bits).alias("middle")), "crowds")
        members = written(near.select("key", "fp").join(crowds, "key"), "crowd-members")
        off = F.bit_count(F.col("fp").bitwiseXOR(F.col("middle")))
        orders = [F.struct(F.xxhash64(F.lit(k), "fp"), F.col("fp")) if k % 2 else F.struct(off.cast("bigint"), F.xxhash64(F.lit(k), "fp"), F.col("fp")) for k in range(1, CENTRES)]
        more = members.groupBy("key").agg(F.array(*[F.min(o)["fp"] for o in orders]).alias("probes"))
        starred = members.select("key", "fp").join(more, "key").select("fp", F.explode("probes").alias("probe"))
        found = near.select("fp", "probe").unionByName(starred).where(F.col("probe") != F.col("fp")).where(self.within())
        return found.select(F.least("fp", "probe").alias("a"), F.greatest("fp", "probe").alias("b")).distinct(), members.select("fp").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it reaches) of every node with a link, by alternating large and small stars."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "small-star")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _named(marked: DataFrame, radius: int) -> DataFrame:
    """For each fingerprint of marked (doc_id, fp, _row): the smallest doc_id of its component, and the row that has it."""
    first = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("_row").alias("r"))
    classes = written(marked.groupBy("fp").agg(F.min(first).alias("rep")), "fingerprint-classes")
    roots = components(PigeonholeSearch(classes, radius).links())
    members = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = members.groupBy("root").agg(F.min("rep").alias("least"))
    return written(members.join(least, "root").select("fp", F.col("least.i").alias("component_id"), F.col("least.r").alias("keep_row")), "components")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    marked = written(fingerprints(docs, words_in_shingle), "fingerprints")
    named = _named(marked.withColumn("_row", F.lit(0).cast("long")), radius)
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


class SimilarRows:
    """Rows (_row, _text) in groups of near copies."""

    def __init__(self, rows: DataFrame, radius: int = NEAR_RADIUS, parts: int | None = None):
        self.rows, self.radius, self.parts = rows, radius, parts

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, rows) whose texts are similar."""
        ids = KeyFilter(pairs.select(F.explode(F.array("a", "b")).alias("_row")).distinct(), "_row")
        known = ids.probed(self.rows.select("_row", "_text"), "_row").where("_hit")
        both = pairs.join(known.select(F.col("_row").alias("a"), F.col("_text").alias("_one")), "a")
        both = both.join(known.select(F.col("_row").alias("b"), F.col("_text").alias("_two")), "b").select("a", "b", "_one", "_two")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets: dict[int, np.ndarray] = {}
                kept = []
                a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for i, (x, y) in enumerate(zip(a, b, strict=True)):
                    if x not in sets:
                        sets[x] = shingles(batch.column(2)[i].as_py())
                    if y not in sets:
                        sets[y] = shingles(batch.column(3)[i].as_py())
                    if similar(sets[x], sets[y]):
                        kept.append(i)
                yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(kept, pa.int64())) for k in (0, 1)], ["a", "b"])

        return both.mapInArrow(run, "a bigint, b bigint")

    def crowd_pairs(self, crowded: DataFrame) -> DataFrame:
        """x and y of pairs within the radius of crowded (_row, fp, of), in different components (of), that may be similar.

        Shingles are ordered by how many of these rows have them. Of two similar documents, each has one shingle at least in common
        with the other among its rarest, a fifth of all and one; the rest alone couldn't make up the similarity. So
        only rows with a shared shingle among these are compared, and none if what a row shares with any other is too little.
        Rows of one large component never meet: they ask first which large components hold a shingle.

        Frequent shingles, those of a text that many copies keep, come last in this order and are counted in groups: those whose
        first row (by hash) is the same are in one, so what copies keep and what each edit makes are apart. Two rows share
        at most the sum over the groups of the lesser counts. A frequent shingle makes a pair only if that sum alone is enough, as
        rows that meet in no other have nothing more in common; any other shingle is in fewer than FREQUENT_ROWS rows.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    own = shingles(text)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), row)), pa.array(own.view(np.int64)), pa.array(np.full(len(own), len(own)))], ["_row", "h", "n"])

        ids = KeyFilter(crowded, "_row")
        texts = ids.probed(self.rows.select("_row", "_text"), "_row").where("_hit").join(crowded.select("_row"), "_row").select("_row", "_text")
        each = written(texts.mapInArrow(run, "_row bigint, h bigint, n bigint"), "crowd-shingles")
        first = F.min(F.struct(F.xxhash64("_row"), "_row"))["_row"]
        known = each.groupBy("h").agg(F.count(F.lit(1)).alias("c"), first.alias("first"), F.min("n").alias("least_n")).where("c > 1")
        common = written(each.join(known, "h"), "crowd-common")
        often = F.col("c") >= FREQUENT_ROWS
        group = F.pmod(F.xxhash64("first", F.pmod("h", F.lit(4))), F.lit(FREQUENT_GROUPS))
        groups = [f"g{i}" for i in range(FREQUENT_GROUPS)]
        in_groups = [F.count_if(often & (F.col("group") == i)).cast("int").alias(g) for i, g in enumerate(groups)]
        sizes = common.withColumn("group", group).groupBy("_row", "n").agg(F.count(F.lit(1)).alias("m"), F.count_if(often).alias("t"), *in_groups)
        # Shingles that no other row has are the rarest; what is left of the fifth comes from the common ones.
        sizes = sizes.withColumn("most", F.col("n") - F.ceil(F.col("n") * LEAST[0] / LEAST[1]) + 1 - (F.col("n") - F.col("m"))).where("most > 0")
        sizes = sizes.withColumn("behind", F.greatest(F.lit(0), F.col("m") - F.col("t") - F.col("most")))
        ranked = common.drop("n").join(sizes, "_row").withColumn("k", F.row_number().over(Window.partitionBy("_row").orderBy("c", "h"))).where(F.col("k") <= F.col("most"))
        # Of rows of these sizes that share so many, whether they may be similar; and whether a shingle is early enough to be in common first.
        enough = lambda shared, n, other: sum(LEAST) * shared >= LEAST[0] * (n + other)
        early = lambda n, m, k, other: enough(m - k + 1, n, other)
        n, m, k, t, lowest = (F.col(c) for c in ("n", "m", "k", "t", "least_n"))
        ranked = ranked.where(~often | (enough(t, n, lowest) & early(n, m, k, lowest)))
        large = crowded.groupBy("of").agg(F.count(F.lit(1)).alias("size")).select("of", (F.col("size") >= LARGE_COMPONENT).alias("large"))
        columns = ["_row", "fp", "of", "n", "m", "t", "k", "behind", "large", *groups]
        rare = written(ranked.join(crowded.join(large, "of"), "_row").select("h", often.alias("often"), *columns), "crowd-rare")
        own, other = (lambda df, side=side: df.select("h", *(["often"] if side == "x" else []), *[F.col(c).alias(f"{side}_{c}") for c in columns]) for side in "xy")
        x, y = (lambda c, side=side: F.col(f"{side}_{c}") for side in "xy")
        may = (x("of") != y("of")) & (F.bit_count(x("fp").bitwiseXOR(y("fp"))) <= self.radius) & enough(F.least(x("m"), y("m")), x("n"), y("n"))
        may &= ~F.col("often") | (early(x("n"), x("m"), x("k"), y("n")) & early(y("n"), y("m"), y("k"), x("n")))
        in_both = reduce(Column.__add__, [F.least(x(g), y(g)) for g in groups])
        may &= enough(in_both + F.when(F.col("often"), 0).otherwise(F.least(x("m") - x("t"), y("m") - y("t"))), x("n"), y("n"))
        # Rows of small components meet in one order, and each row of large ones.
        some = own(rare.where(~F.col("large"))).join(other(rare), "h").where(may & (y("large") | (x("_row") < y("_row"))))
        held = rare.where("large")
        asked = own(held).join(held.select("h", F.col("of").alias("y_of")).distinct(), "h").where(x("of") < y("of"))
        more = asked.join(other(held), ["h", "y_of"]).where(may)
        figures = [F.least(x("_row"), y("_row")).alias("x"), F.greatest(x("_row"), y("_row")).alias("y"), "often", (x("n") + y("n")).alias("n"), in_both.alias("in_both"), F.greatest(x("behind"), y("behind")).alias("behind")]
        met = some.select(*figures).unionByName(more.select(*figures)).groupBy("x", "y").agg(F.count_if(~F.col("often")).alias("met"), *[F.max(c).alias(c) for c in ("n", "in_both", "behind")])
        # All that two rows share is frequent, among the rarest of both, or behind the rarest of one.
        return met.where(enough(F.col("in_both") + F.col("met") + F.col("behind"), F.col("n"), F.lit(0))).select("x", "y")

    def _placed(self, marked: DataFrame, links: DataFrame) -> DataFrame:
        """_row, fp and of (the component, the row itself without a link) of marked."""
        return marked.join(components(links).withColumnRenamed("node", "_row"), "_row", "left").select("_row", "fp", F.coalesce("root", "_row").alias("of"))

    def joining_pairs(self, search: PigeonholeSearch, members: DataFrame) -> DataFrame:
        """a and b of rows within the radius: one of members (_row, fp, of) in no large component, and one of CENTRES of each large one in a bucket."""
        large = members.groupBy("of").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= LARGE_COMPONENT).select("of", F.lit(True).alias("large"))
        held = written(search.index(members.select("fp").distinct()).join(members.join(large, "of", "left"), "fp"), "crowd-index")
        some = [F.min(F.struct(F.xxhash64(F.lit(k), "_row"), F.col("fp"), F.col("_row"))) for k in range(CENTRES)]
        some = held.where("large").groupBy("key", "of").agg(F.array(*some).alias("some")).select("key", F.explode("some").alias("one"))
        met = held.where("large is null").select("key", "fp", "_row").join(some, "key").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("one.fp"))) <= self.radius)
        return met.select(F.col("_row").alias("a"), F.col("one._row").alias("b")).distinct()

    def roots(self, marked: DataFrame) -> DataFrame:
        """node and root of every row of marked (_row, fp) that has a near copy."""
        classes = written(marked.groupBy("fp").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n")), "fingerprint-classes")
        search = PigeonholeSearch(classes, self.radius, self.parts)
        stars, crowd = search.stars()
        crowd = written(crowd.unionByName(classes.where(F.col("n") >= CROWD).select("fp")).distinct(), "crowd")
        # A fingerprint with many rows near it, though near no centre, is one of a crowd; any other makes DENSE pairs at most.
        near = written(search.links(search.points.join(crowd, "fp", "left_anti")).select("a", "b"), "near-lone")
        around = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(classes.select(F.col("fp").alias("b"), "n"), "b")
        around = around.join(crowd.withColumnRenamed("fp", "a"), "a", "left_anti")
        dense = around.groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("rows")).where(F.col("rows") > DENSE).select("fp")
        crowd = written(crowd.unionByName(dense), "whole-crowd")
        # Rows against the first of their fingerprint, and that against the centres of its buckets.
        stars = stars.join(classes.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(classes.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
        same = marked.join(classes.where("n > 1"), "fp").where("_row != first").select(F.col("first").alias("a"), F.col("_row").alias("b"))
        first_links = written(self.links(written(stars.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(same), "star-pairs")), "star-links")
        # Those of crowds in no large component yet against some of each large one in their buckets.
        members = written(self._placed(marked.join(crowd, "fp", "left_semi"), first_links), "crowd-places")
        first_links = written(first_links.unionByName(self.links(written(self.joining_pairs(search, members), "joining-pairs"))), "first-links")
        placed = written(self._placed(marked, first_links), "placed")
        # What lies within the radius and isn't linked yet: pairs with a fingerprint outside of crowds, and rows of those that have some.
        inside = [crowd.select(F.col("fp").alias(side), F.lit(True).alias(f"in_{side}")) for side in ("a", "b")]
        near = near.join(inside[0], "a", "left").join(inside[1], "b", "left").where("in_a is null or in_b is null").select("a", "b")
        alone = classes.where("n > 1").join(crowd, "fp", "left_anti").select(F.col("fp").alias("a"), F.col("fp").alias("b"))
        one, two = (placed.select(F.col("fp").alias(side), F.col("_row").alias(row), F.col("of").alias(f"{row}_of")) for side, row in (("a", "x"), ("b", "y")))
        pairs = near.unionByName(alone).join(one, "a").join(two, "b").where("x_of != y_of").select("x", "y")
        pairs = pairs.unionByName(self.crowd_pairs(written(placed.join(crowd, "fp", "left_semi").select("_row", "fp", "of"), "crowd-rows")))
        pairs = written(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "candidates")
        return components(first_links.unionByName(self.links(pairs)))


def keep_one_of_each_group(docs: DataFrame, radius: int = NEAR_RADIUS) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each group of near copies the row with its smallest doc_id (null last; of repeated rows one)."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("bigint")
    def marks(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([word_fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    rows = docs.select("doc_id", F.col("text").alias("_text"), whole).select("doc_id", marks("_text").alias("fp"), "_whole")
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "fingerprinted")
    found = SimilarRows(rows.select("_row", F.col("_whole.text").alias("_text")), radius).roots(rows.select("_row", "fp"))
    roots = written(found.withColumnRenamed("node", "_row"), "roots")
    first = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("_row").alias("r"))
    members = rows.select("doc_id", "_row").join(roots, "_row")
    keepers = members.groupBy("root").agg(F.min(first).alias("_least")).select(F.col("_least.r").alias("_row"))
    losers = written(roots.select("_row").join(keepers, "_row", "left_anti"), "near-copies")
    tried = KeyFilter(losers, "_row").probed(rows.select("_row", "_whole"), "_row")
    passed = tried.where(~F.col("_hit")).select("_whole.*")
    return passed.unionByName(tried.where("_hit").select("_row", "_whole").join(losers, "_row", "left_anti").select("_whole.*"))


def hex_digits(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
