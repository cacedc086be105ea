"""A longer log of few keys has more runs, and the stream gives the same rows."""

import datetime

from pyspark.sql import functions as F

from sedimenta.streaming import live, replay


def test_rows_per_run(spark, monkeypatch):
    start = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    rows = [(f"i{k * 7 % 11}", f"s{k}", start + datetime.timedelta(minutes=k), k) for k in range(600)]
    log = spark.createDataFrame(rows, "item string, status string, ts timestamp, seq bigint").withColumn("id", F.lit("one")).coalesce(2)
    end = log.limit(1).withColumn("ts", F.lit(start + datetime.timedelta(days=3))).withColumn("id", F.lit("none"))

    def flushed(**options):
        return sorted(map(tuple, replay.replay(log, "ts", lambda read: live.coalesced(read(), 5, 3_600_000), closing=end, **options).where("id = 'one'").drop("batch").collect()))

    whole = flushed()
    taken: list[int] = []
    kept = replay.slices

    def counted(log, at, n):
        taken.append(n)
        return kept(log, at, n)

    monkeypatch.setattr(replay, "slices", counted)
    assert flushed(rows_per_run=150) == whole and len(whole) > 100
    assert taken == [4]
