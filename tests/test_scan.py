"""Scans and exact ranks against plain versions, with groups of all rows, nulls, ties and more ranges than rows."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import metrics, scan, schedule

KEYS = {"one key": lambda r: "k", "a few keys": lambda r: r.choice(["a", "a", "a", "b", None]), "all different": lambda r: f"k{r.random()}"}


def table(spark, kind, n=300, seed=3):
    r = random.Random(seed)
    rows = [(i, KEYS[kind](r), r.choice([None, *map(float, range(12))]) if r.random() < 0.2 else r.randrange(2000) / 4, r.random() < 0.6) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id bigint, g string, v double, failed boolean").repartition(5)


def groups(rows):
    out = {}
    for row in rows:
        out.setdefault(row[1], []).append(row)
    return out


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("ranges", [1, 7, 400])
def test_running_sums_and_neighbours(spark, kind, ranges):
    rows, df = table(spark, kind, 120)
    got = {r.id: (r.s, r.n) for r in scan.running_sums(df, ["g"], [F.col("id")], {"s": F.col("v"), "n": F.lit(1)}, ranges).collect()}
    beside = {r.id: (r.previous, r.next) for r in scan.neighbours(df, ["g"], [F.col("id")], "id", ranges).collect()}
    for held in groups(rows).values():
        total = 0
        for k, row in enumerate(held):
            total += row[2] or 0
            assert got[row[0]] == (total, k + 1)
            assert beside[row[0]] == (held[k - 1][0] if k else None, held[k + 1][0] if k + 1 < len(held) else None)


@pytest.mark.parametrize("kind", ["one key", "a few keys"])
def test_circuit_runs_are_gaps_and_islands(spark, kind):
    rows, df = table(spark, kind)
    want = []
    for g, held in groups(rows).items():
        run = []
        for row in [*held, (None, g, None, False)]:
            if row[3]:
                run.append(row[0])
            elif run:
                want.append((g, len(run), run[0], run[-1], len(run) >= 3))
                run = []
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in metrics.circuit_runs(df, "g", "id", F.col("failed"), 3).collect())


@pytest.mark.parametrize("burst", [1, 3])
def test_paced_is_the_recurrence(spark, burst):
    r = random.Random(5)
    arrivals = sorted(r.randrange(0, 400) / 2 for _ in range(250))
    df = spark.createDataFrame([("h", i, a) for i, a in enumerate(arrivals)], "h string, i int, a double")
    due, want = None, []
    for a in arrivals:
        due = a if due is None else max(a, due)
        want.append(max(a, due - (burst - 1) * 2.0))
        due += 2.0
    got = scan.paced(df, ["h"], [F.col("a"), F.col("i")], F.col("a"), 2.0, burst, 16)
    assert [x.start for x in got.orderBy("i").collect()] == want
    assert schedule.gcra(df, "h", "a", 0.5, burst).agg(F.sum("start")).first()[0] == sum(want)


@pytest.mark.parametrize("kind", ["one key", "a few keys"])
def test_rolling_counts(spark, kind):
    rows, df = table(spark, kind)
    got = {r.id: r.n for r in scan.rolling_counts(df, "g", F.floor("v"), 30, "n", 9).collect()}
    for row in rows:
        near = lambda o: o[2] is not None and int(row[2]) - 30 <= int(o[2]) <= int(row[2])
        assert got[row[0]] == (0 if row[2] is None else sum(o[1] == row[1] and near(o) for o in rows))


@pytest.mark.parametrize("kind", KEYS)
def test_exact_percentiles(spark, kind):
    rows, df = table(spark, kind)
    wanted = {"p0": (F.col("v"), 0.0, "linear"), "m": (F.col("v"), 0.5, "linear"), "p90": (F.col("v"), 0.9, "rank"), "top": (F.col("v"), 1.0, "rank"), "low": (-F.col("v"), 0.5, "linear")}
    got = {r.g: r for r in scan.percentiles(df, ["g"], wanted, 11).collect()}
    for g, held in groups(rows).items():
        v = sorted(x[2] for x in held if x[2] is not None)
        r = got[g]
        if not v:
            assert tuple(r)[1:] == (None,) * 5
            continue
        assert (r.p0, r.m, r.top, r.low) == (v[0], median(v), v[-1], -median(v))
        assert r.p90 == v[max(0, -(-9 * len(v) // 10) - 1)]


def test_percentiles_without_groups_or_rows(spark):
    _, df = table(spark, "one key")
    one = scan.percentiles(df, [], {"m": (F.col("v"), 0.5, "linear")}).first().m
    assert one == df.agg(F.percentile("v", F.lit(0.5))).first()[0]
    assert scan.percentiles(df.limit(0), ["g"], {"m": (F.col("v"), 0.5, "linear")}).count() == 0
    assert metrics.size_report(df.limit(0).select(F.lit("x").alias("t")), "t").first().n == 0
    assert scan.running_sums(df.limit(0), ["g"], [F.col("id")], {"n": F.lit(1)}).count() == 0


def test_equal_values_are_one_row_of_the_scan(spark):
    df = spark.range(50_000).select(F.lit("g").alias("g"), F.lit(1.0).alias("v"))
    assert tuple(scan.percentiles(df, ["g"], {"m": (F.col("v"), 0.5, "linear"), "p": (F.col("v"), 0.9, "rank")}).first()) == ("g", 1.0, 1.0)
