"""Nearest markers, trigram postings and releases against plain versions and broken runs."""

import random
from math import hypot

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import spatial, trigrams
from sedimenta.sources.release import ReleaseStore


def nearest(points, markers, reach):
    out = []
    for i, x, y in points:
        if x is None or y is None:
            continue
        found = sorted((((x - a) ** 2 + (y - b) ** 2) ** 0.5, m) for m, a, b in markers if a is not None and b is not None and hypot(x - a, y - b) <= reach + 1e-6)
        found = [f for f in found if f[0] <= reach]
        if found:
            out.append((i, found[0][1], round(found[0][0], 9)))
    return sorted(out)


@pytest.mark.parametrize("kind", ["even", "one dense spot", "on a line", "all in one place", "on cell edges"])
def test_nearest_marker_of_every_point(spark, kind):
    rng = random.Random(3)
    spot = {
        "even": lambda: (rng.uniform(-50, 50), rng.uniform(-50, 50)),
        "one dense spot": lambda: (7 + rng.gauss(0, 0.001), -3 + rng.gauss(0, 0.001)) if rng.random() < 0.9 else (rng.uniform(-50, 50), rng.uniform(-50, 50)),
        "on a line": lambda: (rng.uniform(-50, 50), 1.0),
        "all in one place": lambda: (2.5, 2.5),
        "on cell edges": lambda: (5.0 * rng.randrange(-9, 10), 5.0 * rng.randrange(-9, 10)),
    }[kind]
    markers = [(i, *spot()) for i in range(400)] + [(900, None, 1.0), (-1, 0.0, 0.0)]
    points = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(150)] + [(500 + i, *spot()) for i in range(50)] + [(990, None, None), (991, 0.0, 0.0)]
    schema = "id int, x double, y double"
    got = spatial.nearest(spark.createDataFrame(points, schema), spark.createDataFrame(markers, schema), 5.0, 4)
    assert sorted((r.id, r.marker_id, round(r.distance, 9)) for r in got.collect()) == nearest(points, markers, 5.0)


def test_nearest_of_nothing(spark):
    schema = "id int, x double, y double"
    some, none = spark.createDataFrame([(1, 0.0, 0.0)], schema), spark.createDataFrame([], schema)
    assert spatial.nearest(some, none, 1.0).count() == 0 and spatial.nearest(none, some, 1.0).count() == 0


TEXTS = [None, "", "ab", "abc", "xabcx", "ABC", "aabbcc", "中文字", "x中文", "abc\nabc", "bca cab abc", "🙂🙂", "a" * 5000 + "needle" + "b" * 5000]


@pytest.mark.parametrize("shard_bytes", [8_000_000, 40])
def test_trigram_hits_are_those_that_contain(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(trigrams, "SHARD_BYTES", shard_bytes)
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("abc ") for _ in range(rng.randrange(40))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts)], "id int, text string, row string").repartition(4)
    index = trigrams.TrigramIndex.build(df, "id", "text")
    for needle in ("abc", "abca", "b c", "needle", "中文", "🙂", "bb", "", "zzz", "abc\nabc", "cab abc"):
        assert sorted(r.key for r in index.search(needle).collect()) == [i for i, t in enumerate(texts) if t is not None and needle in t], needle


def test_texts_without_a_trigram_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(trigrams, "SHARD_BYTES", 2_000)
    df = spark.range(2_000).select("id", F.concat(F.repeat(F.lit("common words "), F.lit(10)), F.when(F.col("id") == 777, "rareneedle").otherwise("")).alias("text"))
    index = trigrams.TrigramIndex.build(df.repartition(4), "id", "text")
    held = lambda needle: index.candidates(needle).agg(F.sum(F.size("rows"))).first()[0]
    assert held("rareneedle") == 1 and held("common") == 2_000
    hits = index.search("rareneedle")
    assert [r.key for r in hits.collect()] == [777]
    plan = hits._jdf.queryExecution().toString()
    assert "In(shard" in plan or "EqualTo(shard" in plan  # the scan knows which shards it needs
    empty = trigrams.TrigramIndex.build(df.limit(0), "id", "text")
    assert empty.search("abc").count() == 0


def store(spark, tmp_path):
    return ReleaseStore(spark, f"file://{tmp_path}/r")


def test_releases_are_published_and_rolled_back(spark, tmp_path):
    s, df = store(spark, tmp_path), spark.range(10).toDF("id")
    assert s.current is None and s.roll_back() is None
    with pytest.raises(ValueError, match="committed"):
        s.publish("r1", lambda t: True)
    s.build("r1", {"a": df}, lambda t: [])
    s.build("r2", {"a": df.limit(3)}, lambda t: [])
    with pytest.raises(FileExistsError):
        s.build("r1", {"a": df}, lambda t: [])
    assert s.publish("r1", lambda t: t["a"].count() == 10) and s.current == "r1"
    assert not s.publish("r2", lambda t: t["a"].count() == 10) and s.current == "r1"
    assert s.publish("r2", lambda t: True) and s.read("a").count() == 3
    assert s.roll_back() == "r1" and s.read("a").count() == 10
    with pytest.raises(ValueError, match="faults"):
        s.build("bad", {"a": df}, lambda t: ["rows"])
    assert not s.committed("bad")


def test_a_build_that_breaks_off_is_taken_up(spark, tmp_path):
    s, df = store(spark, tmp_path), spark.range(5).toDF("id")
    with pytest.raises(ZeroDivisionError):
        s.build("r1", {"a": df, "b": df}, lambda t: 1 / 0)
    assert not s.committed("r1")
    before = sorted(p.name for p in (tmp_path / "r/releases/r1/data/a").iterdir())
    s.build("r1", {"a": df, "b": df}, lambda t: [])
    assert s.committed("r1") and sorted(p.name for p in (tmp_path / "r/releases/r1/data/a").iterdir()) == before
    assert s.publish("r1", lambda t: True)


def test_one_changed_byte_is_found(spark, tmp_path):
    s = store(spark, tmp_path)
    s.build("r1", {"a": spark.range(1000).toDF("id").coalesce(1)}, lambda t: [])
    (part,) = (tmp_path / "r/releases/r1/data/a").glob("part-*.parquet")
    body = bytearray(part.read_bytes())
    body[len(body) // 2] ^= 1
    part.write_bytes(bytes(body))
    for crc in part.parent.glob(".*.crc"):
        crc.unlink()
    (part.parent / "part-extra.parquet").write_bytes(b"x")
    assert sorted((r.path.split("-")[0], r.problem) for r in s.problems("r1").collect()) == [("a/part", "changed"), ("a/part", "unlisted")]
    with pytest.raises(ValueError, match="manifest"):
        s.publish("r1", lambda t: True)
    assert s.current is None


def test_of_two_publishers_one_wins(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path)
    for r in ("r1", "r2"):
        s.build(r, {"a": spark.range(2).toDF("id")}, lambda t: [])
    s.publish("r1", lambda t: True)
    stale = s._log()
    assert s.publish("r2", lambda t: True)
    monkeypatch.setattr(s, "_log", lambda: stale)
    with pytest.raises(FileExistsError):
        s.publish("r1", lambda t: True)
