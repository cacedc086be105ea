"""Scans over ordered groups of any size, and the values of exact ranks.

What a row gets depends on all rows before it, but a group may hold a third of all rows, or all. So rows are dealt to ranges of
group and order, each range is scanned by itself, and a summary of it (a sum, a maximum, its first and last row) is combined with
those of the ranges before, in order. Only summaries meet in one place: a row for each group and range. Then every range is
moved by what came before it. This works for whatever combines associatively.

Rows that are equal by the order may come in any order; give a tie-break where that matters. Null groups are a group. Groups that
aren't there have no rows in the result, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import checkpointed

_ALL = (Window.unboundedPreceding, Window.currentRow)


class Ranges:
    """Rows dealt to ranges, in order within each: _range, _own (a row's number there, from 1)."""

    def __init__(self, df: DataFrame, by: list[str], order: list[Column], ranges: int | None = None):
        n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.by, self.order = by, order
        dealt = checkpointed(df.repartitionByRange(n, *[F.col(c) for c in by], *order).withColumn("_range", F.spark_partition_id()))
        self.within = Window.partitionBy(*by, "_range").orderBy(*order)
        self.rows = dealt.withColumn("_own", F.row_number().over(self.within))

    @property
    def earlier(self):
        """Over summaries: those of the ranges before, of the same group."""
        return Window.partitionBy(*self.by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)

    @property
    def beside(self):
        return Window.partitionBy(*self.by).orderBy("_range")

    def summed(self, *cells: Column) -> DataFrame:
        """A row for each group and range."""
        return self.rows.groupBy(*self.by, "_range").agg(*cells)

    def with_carried(self, summary: DataFrame, names: list[str]) -> DataFrame:
        """The rows, each with what its range's summary says in these columns."""
        keys = [F.col(c).alias(f"_by{i}") for i, c in enumerate(self.by)]
        small = summary.select(*keys, F.col("_range").alias("_r"), *names)
        meet = F.col("_range") == F.col("_r")
        for i, c in enumerate(self.by):
            meet &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
        return self.rows.join(small, meet).drop("_r", *[f"_by{i}" for i in range(len(self.by))])


def running_sums(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """df with the sums of each row's group up to and with the row. Nulls add nothing."""
    cells = {f"_v{i}": F.coalesce(v, F.lit(0)) for i, v in enumerate(sums.values())}
    r = Ranges(df.withColumns(cells), by, order, ranges)
    summary = r.summed(*[F.sum(v).alias(f"_s{i}") for i, v in enumerate(cells)])
    summary = summary.withColumns({f"_b{i}": F.coalesce(F.sum(f"_s{i}").over(r.earlier), F.lit(0)) for i in range(len(sums))})
    r.rows = r.rows.withColumns({f"_l{i}": F.sum(v).over(r.within.rowsBetween(*_ALL)) for i, v in enumerate(cells)})
    out = r.with_carried(summary, [f"_b{i}" for i in range(len(sums))])
    out = out.withColumns({name: F.col(f"_l{i}") + F.col(f"_b{i}") for i, name in enumerate(sums)})
    return out.drop("_range", "_own", *cells, *[f"{p}{i}" for p in ("_l", "_b") for i in range(len(sums))])


def neighbours(df: DataFrame, by: list[str], order: list[Column], key: str, ranges: int | None = None) -> DataFrame:
    """df with the keys before and behind each row."""
    r = Ranges(df, by, order, ranges)
    summary = r.summed(F.min_by(key, "_own").alias("_first"), F.max_by(key, "_own").alias("_last"), F.count(F.lit(1)).alias("_rows"))
    summary = summary.withColumns({"_before": F.lag("_last").over(r.beside), "_behind": F.lead("_first").over(r.beside)})
    r.rows = r.rows.withColumns({"_lag": F.lag(key).over(r.within), "_lead": F.lead(key).over(r.within)})
    out = r.with_carried(summary, ["_before", "_behind", "_rows"])
    previous = F.when(F.col("_own") == 1, F.col("_before")).otherwise(F.col("_lag"))
    following = F.when(F.col("_own") == F.col("_rows"), F.col("_behind")).otherwise(F.col("_lead"))
    return out.withColumns({"previous": previous, "next": following}).drop("_range", "_own", "_before", "_behind", "_rows", "_lag", "_lead")


def paced(df: DataFrame, by: list[str], order: list[Column], arrival: Column, gap: float, burst: int, ranges: int | None = None) -> DataFrame:
    """df with start: when each request of a group may begin, one every gap and burst at once (the generic cell rate algorithm).

    The recurrence t = max(arrival, t + gap) has a closed form in (max, plus): t_n = n gap + the running maximum of
    arrival_i - i gap. A range numbers its rows from 0; with k rows before it, its maxima are lower by k gap.
    """
    r = Ranges(df.withColumn("_at", arrival.cast("double")), by, order, ranges)
    slack = F.col("_at") - (F.col("_own") - 1) * gap
    summary = r.summed(F.count(F.lit(1)).alias("_rows"), F.max(slack).alias("_peak"))
    summary = summary.withColumn("_before", F.coalesce(F.sum("_rows").over(r.earlier), F.lit(0)))
    summary = summary.withColumn("_carried", F.max(F.col("_peak") - F.col("_before") * gap).over(r.earlier))
    r.rows = r.rows.withColumn("_slack", F.max(slack).over(r.within.rowsBetween(*_ALL)))
    out = r.with_carried(summary, ["_before", "_carried"])
    peak = F.greatest(F.col("_slack") - F.col("_before") * gap, F.col("_carried"))  # greatest() leaves out nulls
    due = peak + (F.col("_before") + F.col("_own") - 1) * gap
    return out.withColumn("start", F.greatest(F.col("_at"), due - (burst - 1) * gap)).drop("_range", "_own", "_at", "_slack", "_before", "_carried")


def rolling_counts(df: DataFrame, by: str, at: Column, width: int, name: str, ranges: int | None = None) -> DataFrame:
    """df with the rows of its group whose number at lies between a row's own less width and its own, both included.

    Each row asks twice how many rows lie below: at its own number (rows that equal it count) and at the lower end (they don't).
    Rows and questions are one scan. A null number counts nothing.
    """
    base = checkpointed(df.withColumns({"_id": F.monotonically_increasing_id(), "_at": at}))
    asked = F.array(
        F.struct((F.col("_at") - width).alias("_p"), F.lit(0).alias("_kind")),
        F.struct(F.col("_at").alias("_p"), F.lit(1).alias("_kind")),
        F.struct(F.col("_at").alias("_p"), F.lit(2).alias("_kind")),
    )
    points = base.where("_at is not null").select(F.col(by).alias("_g"), "_id", F.inline(asked))
    below = running_sums(points, ["_g"], [F.col("_p"), F.col("_kind"), F.col("_id")], {"_n": (F.col("_kind") == 1).cast("bigint")}, ranges)
    signed = F.when(F.col("_kind") == 2, F.col("_n")).when(F.col("_kind") == 0, -F.col("_n"))
    found = below.groupBy(F.col("_id").alias("_i")).agg(F.sum(signed).alias(name))
    return base.join(found, F.col("_id") == F.col("_i"), "left").withColumn(name, F.coalesce(name, F.lit(0))).drop("_id", "_i", "_at")


def percentiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[Column, float, str]], ranges: int | None = None) -> DataFrame:
    """Exact percentiles of each group: name -> (column, share, "linear" or "rank"). No buffer holds a group.

    Equal values are counted first; a scan of the counts gives each different value the ranks it has, and those of the wanted
    ranks are kept. linear interpolates between the two values around share * (n - 1); rank is the smallest value that at least
    a share of the values don't exceed. Null values don't count; a group without values has nulls.
    """
    columns: list[Column] = []
    place: dict[str, int] = {}
    for name, (c, _, _) in wanted.items():
        same = [k for k, held in enumerate(columns) if str(held) == str(c)]
        place[name] = same[0] if same else len(columns)
        if not same:
            columns.append(c)
    own = [f"_g{i}" for i in range(len(by))]
    keys = [F.col(c).alias(g) for c, g in zip(by, own, strict=True)]
    each = F.inline(F.array(*[F.struct(F.lit(k).alias("_c"), c.cast("double").alias("_v")) for k, c in enumerate(columns)]))
    counts = df.select(*keys, each).where("_v is not null").groupBy(*own, "_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    scanned = running_sums(counts, [*own, "_c"], [F.col("_v")], {"_upto": F.col("_n")}, ranges)
    totals = scanned.groupBy(*[F.col(g).alias(f"{g}t") for g in own], F.col("_c").alias("_ct")).agg(F.sum("_n").alias("_total"))
    meet = F.col("_c") == F.col("_ct")
    for g in own:
        meet &= F.col(g).eqNullSafe(F.col(f"{g}t"))
    rows = scanned.join(totals, meet)
    holds = lambda k, rank: (F.col("_c") == k) & (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))  # noqa: E731  ranks from 0
    cells, hits = [], F.lit(False)
    for name, (_, share, kind) in wanted.items():
        k = place[name]
        position = F.lit(share) * (F.col("_total") - 1)
        low, high = F.floor(position), F.ceil(position)
        if kind == "rank":
            low = high = F.greatest(F.ceil(F.lit(share) * F.col("_total")) - 1, F.lit(0))
        at = lambda rank, k=k: F.max(F.when(holds(k, rank), F.col("_v")))
        part = F.max(F.when(F.col("_c") == k, position - low)) if kind != "rank" else F.lit(0.0)
        cells.append(((F.lit(1.0) - part) * at(low) + part * at(high) if kind != "rank" else at(low)).alias(name))
        hits |= holds(k, low) | holds(k, high)
    found = rows.where(hits).groupBy(*own).agg(*cells)
    if not by:
        return found
    groups = df.select(*by).distinct()
    same = F.lit(True)
    for c, g in zip(by, own, strict=True):
        same &= F.col(c).eqNullSafe(F.col(g))
    return groups.join(found, same, "left").drop(*own)


def with_percentiles(summary: DataFrame, df: DataFrame, by: list[str], wanted: dict[str, tuple[Column, float, str]]) -> DataFrame:
    """A summary of df's groups with their percentiles beside it."""
    if not by:
        found = percentiles(df, by, wanted)
        return summary.withColumns({name: found.select(name).scalar() for name in wanted})
    found = percentiles(df, by, wanted).withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(by)})
    meet = F.lit(True)
    for i, c in enumerate(by):
        meet &= F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return summary.join(found, meet, "left").drop(*[f"_k{i}" for i in range(len(by))])
