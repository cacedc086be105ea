"""Runs over a stored worklist: broken off, paused, cancelled, retried."""

import pytest
from pyspark.sql import functions as F

from sedimenta.streaming.runs import Run


def targets(spark, n=30):
    return spark.range(n).select(F.concat(F.lit("t"), "id").alias("identity"), F.col("id").alias("size")).coalesce(2)


def by_size(seen, breaks=None, ask=None):
    def process(rows, attempt):
        seen.append(sorted(r.identity for r in rows.collect()))
        if breaks == len(seen):
            raise RuntimeError("the driver is lost")
        if ask:
            ask(len(seen))
        return rows.select("identity", F.when((F.col("size") % 3 != 0) | (F.lit(attempt) > 1), "PARSED").otherwise("BLOCKED").alias("status"))

    return process


def test_lost_driver_then_retry_of_gaps_only(spark, tmp_path):
    run, seen = Run(spark, f"file://{tmp_path}/r", batch_rows=10), []
    run.create(targets(spark))
    with pytest.raises(RuntimeError):
        run.execute(by_size(seen, breaks=2))
    again = Run(spark, f"file://{tmp_path}/r", batch_rows=10)
    rest = []
    assert again.state["status"] == "RUNNING" and again.execute(by_size(rest)) == "COMPLETED_WITH_GAPS"
    assert seen[0] not in rest and seen[1] in rest  # a committed batch isn't done again, the broken one is
    again.retry()
    redone = []
    assert again.execute(by_size(redone)) == "COMPLETED"
    assert sorted(sum(redone, [])) == sorted(f"t{i}" for i in range(0, 30, 3))
    assert {(r.identity, r.status, r.attempt) for r in again.outcomes().collect()} == {(f"t{i}", "PARSED", 1 if i % 3 else 2) for i in range(30)}
    assert again.history() == ["CREATED", "QUEUED", "RUNNING", "COMPLETED_WITH_GAPS", "CREATED", "QUEUED", "RUNNING", "COMPLETED"]
    with pytest.raises(ValueError):
        again.retry()


def test_pause_resume_and_cancel(spark, tmp_path):
    run, seen = Run(spark, f"file://{tmp_path}/r", batch_rows=10), []
    run.create(targets(spark))
    assert run.execute(by_size(seen, ask=lambda n: run.request("pause") if n == 1 else None)) == "PAUSED" and len(seen) == 1
    assert run.execute(by_size(seen)) == "PAUSED" and len(seen) == 1
    run.request("resume")
    assert run.execute(by_size(seen, ask=lambda n: run.request("cancel") if n == 2 else None)) == "CANCELLED"
    assert 0 < run.outcomes().count() < 30
    with pytest.raises(ValueError):
        run.execute(by_size(seen))
    with pytest.raises(ValueError):
        run.request("stop")


def test_worklist_that_is_wrong_changed_or_empty(spark, tmp_path):
    twice = targets(spark, 3).union(targets(spark, 2)).union(spark.createDataFrame([(None, 1)], "identity string, size bigint"))
    with pytest.raises(ValueError, match=r"None, t0, t1 \(3\)"):
        Run(spark, f"file://{tmp_path}/a").create(twice)
    run = Run(spark, f"file://{tmp_path}/b")
    run.create(targets(spark, 3))
    with pytest.raises(FileExistsError):
        run.create(targets(spark, 3))
    spark.createDataFrame([("t9", 9)], "identity string, size bigint").withColumn("_batch", F.lit(0)).write.mode("append").partitionBy("_batch").parquet(f"file://{tmp_path}/b/worklist/000001")
    with pytest.raises(ValueError):
        run.execute(by_size([]))
    lost = Run(spark, f"file://{tmp_path}/c")
    lost.create(targets(spark, 3))
    assert lost.execute(lambda rows, attempt: rows.where("size > 0").select("identity", F.lit("PARSED").alias("status"))) == "FAILED"
