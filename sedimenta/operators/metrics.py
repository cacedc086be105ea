"""Operational metrics: percentiles of two kinds, rates, host roll-ups, bottleneck, ETA, sizes and projections.

`now` is always a parameter, so that a result can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.values import case, percent
from sedimenta.operators.scan import percentiles, rolling_counts, running_sums, with_percentiles
from sedimenta.session import checkpointed

RECENT_ROWS = 500
RATE_WINDOWS = (30, 60, 300)
FORECAST_LEAST = 3


def linear_percentiles(df: DataFrame, columns: list[str], by: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """Interpolated p50 and p90 of each column, three decimals: exact, or with an accuracy from sketches of a fixed size."""
    shares = {f"{c}_p{int(p * 100)}": (c, p) for c in columns for p in (0.5, 0.9)}
    if accuracy is None:
        found = percentiles(df, by or [], {name: (F.col(c), p, "linear") for name, (c, p) in shares.items()})
        return found.withColumns({name: F.round(name, 3) for name in shares})
    cells = [F.round(F.percentile_approx(c, p, accuracy), 3).alias(name) for name, (c, p) in shares.items()]
    return (df.groupBy(*by) if by else df).agg(*cells)


def timing_report(df: DataFrame, seconds: str, by: list[str]) -> DataFrame:
    """n, mean, median, and p90 by nearest rank."""
    summary = df.groupBy(*by).agg(F.count(seconds).alias("n"), F.avg(seconds).alias("mean"))
    return with_percentiles(summary, df, by, {"median": (F.col(seconds), 0.5, "linear"), "p90": (F.col(seconds), 0.9, "rank")})


def host_rollup(df: DataFrame, host: str, status: str, classes: dict[str, list[str]], timings: list[str], top: int = 8) -> DataFrame:
    """Totals by class and medians of timings for each host, most rows first. A timing counts where it is finite and not negative."""
    good = lambda c: F.when(F.col(c).isNotNull() & ~F.isnan(c) & (F.col(c) >= 0) & (F.col(c) < float("inf")), F.col(c))
    cells = [F.count(F.lit(1)).alias("total")]
    cells += [F.count_if(F.col(status).isin(*group)).alias(name) for name, group in classes.items()]
    shown = checkpointed(df.groupBy(host).agg(*cells).orderBy(F.desc("total"), F.asc(host)).limit(top))
    rows = df.join(F.broadcast(shown.select(F.col(host).alias("_host"))), F.col(host).eqNullSafe(F.col("_host")), "left_semi")  # top rows at most
    out = with_percentiles(shown, rows, [host], {f"{c}_p50": (good(c), 0.5, "linear") for c in timings})
    return out.orderBy(F.desc("total"), F.asc(host))


def bottleneck(hosts: DataFrame, queue: str, pacing: str, p90: str) -> DataFrame:
    """The host that waits most, and whether in the queue or for pacing; no row if none waits."""
    waiting = F.coalesce(F.col(queue), F.lit(0.0)) + F.coalesce(F.col(pacing), F.lit(0.0))
    rank = F.struct(waiting.alias("waiting"), F.coalesce(F.col(p90), F.lit(0.0)).alias("p90"), F.col("total").alias("total"), F.col("host").alias("host"), F.coalesce(F.col(queue), F.lit(0.0)).alias("q"), F.coalesce(F.col(pacing), F.lit(0.0)).alias("p"))
    best = hosts.agg(F.max(rank).alias("b")).where("b.waiting > 0")
    return best.select("b.host", "b.waiting", F.when(F.col("b.q") >= F.col("b.p"), "queue").otherwise("pacing").alias("reason"))


def rolling_rates(df: DataFrame, at: str, now: Column, active_seconds: Column) -> DataFrame:
    """Completions in the last 30, 60 and 300 seconds, and their rates a minute over the time that work was active."""
    cells = [F.count_if(F.col(at) >= now - F.make_interval(secs=F.lit(s))).alias(f"count_{s}") for s in RATE_WINDOWS]
    out = df.where(F.col(at) >= now - F.make_interval(secs=F.lit(max(RATE_WINDOWS)))).agg(*cells)
    for s in RATE_WINDOWS:
        out = out.withColumn(f"rate_{s}", F.lit(60.0) * F.col(f"count_{s}") / F.greatest(F.lit(0.001), F.least(F.lit(float(s)), active_seconds)))
    return out


def with_eta(rates: DataFrame, remaining: Column, active: Column) -> DataFrame:
    """Seconds to go at the forecast rate: of 60 s if it counted enough, else of 300 s, else of 30 s."""
    forecast = F.when(F.col("count_60") >= FORECAST_LEAST, F.col("rate_60")).when(F.col("count_300") > 0, F.col("rate_300")).otherwise(F.col("rate_30"))
    out = rates.withColumn("current_rate", F.when(active, F.col("rate_30")).otherwise(0.0)).withColumn("forecast_rate", forecast)
    return out.withColumn("eta_seconds", F.when(active & (F.col("forecast_rate") > 0) & (remaining > 0), 60.0 * remaining / F.col("forecast_rate")))


def rolling_count(df: DataFrame, by: str, at: str, seconds: int) -> DataFrame:
    """df with the rows of its key in the seconds up to each row."""
    return rolling_counts(df, by, F.unix_micros(F.col(at).cast("timestamp")), seconds * 1_000_000, f"last_{seconds}s")


def is_stalled(updated_at: Column, now: Column, threshold: int) -> Column:
    return now.cast("double") - updated_at.cast("double") >= threshold


def recent(df: DataFrame, by: str, at: str, tie: str, rows: int = RECENT_ROWS) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(by).orderBy(F.col(at).desc(), F.col(tie).desc()))
    return df.withColumn("_n", n).where(F.col("_n") <= rows).drop("_n")


def unattributed(duration: Column, *parts: Column) -> Column:
    """What known parts leave of a duration, at least 0; null if no part is known."""
    known = F.coalesce(*parts)
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))
    return F.when(known.isNotNull(), F.greatest(F.lit(0.0), duration - total))


def progress(df: DataFrame, status: str, classes: dict[str, list[str]]) -> DataFrame:
    """Counts by class and their shares of all rows."""
    n = F.count(F.lit(1))
    cells = [n.alias("total")]
    for name, group in classes.items():
        count = F.count_if(F.col(status).isin(*group))
        cells += [count.alias(name), percent(count, n).alias(f"{name}_pct")]
    return df.agg(*cells)


def merge_partials(partials: DataFrame, keys: list[str], counters: list[str], state: str, order: str) -> DataFrame:
    """Counters added, the latest state kept."""
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters], F.max_by(state, order).alias(state))


def merge_host_maps(partials: DataFrame, column: str = "host_status") -> DataFrame:
    """Counts of nested host -> status -> n maps, added."""
    hosts = partials.select(F.explode(column).alias("host", "statuses"))
    return hosts.select("host", F.explode("statuses").alias("status", "n")).groupBy("host", "status").agg(F.sum("n").alias("n"))


def counter_deltas(changes: DataFrame, key: str, status: str, order: str) -> DataFrame:
    """Counters kept by differences: each change of a key's status takes one from the old status and gives one to the new."""
    before = F.lag(status).over(Window.partitionBy(key).orderBy(order))
    out = changes.withColumn("_old", before).where(~F.col("_old").eqNullSafe(F.col(status)))
    each = out.select(F.explode(F.array(F.struct(F.col(status).alias("status"), F.lit(1).alias("delta")), F.struct(F.col("_old").alias("status"), F.lit(-1).alias("delta")))).alias("d")).select("d.*")
    return each.where("status is not null").groupBy("status").agg(F.sum("delta").alias("n"))


def size_report(df: DataFrame, text: str, by: list[str] | None = None) -> DataFrame:
    """n, bytes, mean, median, and p90 by nearest rank, of the sizes of texts in UTF-8."""
    sizes = df.select(*(by or []), F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("bytes"))
    cells = [F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("_sum"), F.avg("bytes").alias("mean")]
    summary = (sizes.groupBy(*by) if by else sizes).agg(*cells)
    out = with_percentiles(summary, sizes, by or [], {"median": (F.col("bytes"), 0.5, "linear"), "p90": (F.col("bytes"), 0.9, "rank")})
    return out.select(*(by or []), "n", F.col("_sum").alias("bytes"), "mean", "median", "p90")


def key_sizes(df: DataFrame) -> DataFrame:
    """Bytes that each column takes as JSON."""
    cells = [F.sum(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`").alias("v"))))).alias(c) for c in df.columns]
    wide = df.agg(*cells)
    return wide.unpivot([], wide.columns, "key", "bytes")


def projections(measured: DataFrame, unit_bytes: str, scenarios: dict[str, float], sizes: list[int]) -> DataFrame:
    """What measured units would take: bytes for each row of measured, each scenario's factor and each size."""
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("scenario"), F.lit(float(factor)).alias("_factor")) for name, factor in scenarios.items()]))
    rows = measured.select("*", each).select("*", F.explode(F.array(*[F.lit(n).cast("bigint") for n in sizes])).alias("records"))
    return rows.withColumn("bytes", F.col("records") * F.col(unit_bytes) * F.col("_factor")).drop("_factor")


def speedup(mean_seconds: Column, n: Column, wall_seconds: Column) -> Column:
    """How many times faster than doing n items one after another."""
    return F.try_divide(mean_seconds * n, wall_seconds)


def circuit_runs(attempts: DataFrame, host: str, order: str, failed: Column, threshold: int) -> DataFrame:
    """Runs of failures on end for each host, and whether one opens the circuit: a run is the failures with as many successes before."""
    rows = attempts.select(F.col(host).alias("host"), F.col(order).alias("_order"), failed.alias("_failed"))
    out = running_sums(rows, ["host"], [F.col("_order")], {"_run": F.when(F.col("_failed"), 0).otherwise(1)})
    runs = out.where("_failed").groupBy("host", "_run").agg(F.count(F.lit(1)).alias("failures"), F.min("_order").alias("since"), F.max("_order").alias("until"))
    return runs.select(F.col("host").alias(host), "failures", "since", "until", (F.col("failures") >= threshold).alias("opens"))


def job_overlaps(jobs: DataFrame, by: str, job: str, first: str, last: str) -> DataFrame:
    """Pairs of jobs of one key whose ranges overlap.

    Ranges are dealt to buckets as wide as they are, by powers of two, and meet in those of the wider of two: each lies in two
    buckets of a width at most, however long it is beside the others. Widths are few, as lengths are numbers.
    """
    level = F.ceil(F.log2(F.greatest(F.col(last).cast("double") - F.col(first).cast("double"), F.lit(1.0)))).cast("int")
    own = jobs.select(by, job, first, last, level.alias("_own"))
    levels = [r[0] for r in own.select("_own").where("_own is not null").distinct().collect()]  # powers of two of a double: 1,024 at most
    bucket = lambda c, w: F.floor(F.col(c).cast("double") / F.pow(F.lit(2.0), w)).cast("bigint")
    wide = F.filter(F.array(*[F.lit(v) for v in sorted(levels)]), lambda v: v >= F.col("_own")) if levels else F.array().cast("array<int>")
    dealt = own.withColumn("_w", F.explode(wide)).withColumn("_b", F.explode(F.sequence(bucket(first, F.col("_w")), bucket(last, F.col("_w")))))
    a, b = dealt.where("_own = _w").alias("a"), dealt.alias("b")
    meet = (F.col(f"a.{by}") == F.col(f"b.{by}")) & (F.col("a._w") == F.col("b._w")) & (F.col("a._b") == F.col("b._b"))
    overlap = (F.col(f"a.{first}") <= F.col(f"b.{last}")) & (F.col(f"a.{last}") >= F.col(f"b.{first}"))
    # A pair is counted in the first bucket that both reach, and once if both are as wide.
    w = F.col("a._w")
    once = (F.col("a._b") == F.greatest(bucket(f"a.{first}", w), bucket(f"b.{first}", w))) & ((F.col("b._own") < w) & (F.col(f"a.{job}") != F.col(f"b.{job}")) | (F.col(f"a.{job}") < F.col(f"b.{job}")))
    return a.join(b, meet & overlap & once).select(F.col(f"a.{by}").alias(by), F.least(f"a.{job}", f"b.{job}").alias("left_job"), F.greatest(f"a.{job}", f"b.{job}").alias("right_job"))


def job_snapshot(items: DataFrame, now: Column, started: Column, total: Column, classes: dict[str, list[str]], active: Column | None = None) -> DataFrame:
    """One row on a job: counts and shares by class, rates, forecast and ETA, and whether it has stalled (60 s without a change).

    items has status and updated_at (a timestamp).
    """
    active = F.lit(True) if active is None else active
    span = F.greatest(F.lit(0.001), now.cast("double") - started.cast("double"))
    rates = with_eta(rolling_rates(items, "updated_at", now, span), total - items.agg(F.count(F.lit(1)).alias("n")).scalar(), active)
    last = items.agg(F.max("updated_at").alias("t")).scalar()
    done = progress(items, "status", classes)
    out = rates.withColumns({c: done.select(c).scalar() for c in done.columns})
    return out.withColumn("stalled", active & is_stalled(F.coalesce(last, started), now, 60))


def live_decision(host_state: Column, now: Column, opened_at: Column, cooldown: int) -> Column:
    """What an open circuit allows: nothing, one probe after the cool-down, or all."""
    return case((host_state != "open", "allow"), (now.cast("double") - opened_at.cast("double") >= cooldown, "probe"), otherwise="skip")
