"""A run over a fixed worklist: batches that are done once each, paused, resumed, cancelled and retried through stored state.

    worklist/<batches>/_batch=<b>/...     the targets, dealt by the hash of their identity, with a digest in worklist.json
    outcomes/<attempt>/<b>/...            what came of a batch; whole when Spark has committed it
    states/<n>.json                       each state the run has been in, one entry a move; a move that isn't allowed raises
    control/<n>.json                      what was asked for: pause, resume or cancel

All files are written whole by a rename. A run that loses its driver goes on with the batches that aren't committed, and does
a batch that broke off again. A retry is a new attempt over the targets that have no kept status; others stay as they are.
Targets with a null or repeated identity block a worklist. A worklist without targets is completed at once.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import files
from sedimenta.operators.merge import latest
from sedimenta.operators.refs import worklist_digest
from sedimenta.streaming.live import move, remaining

#: Repeated identities that an error names; their number is always told.
SHOWN = 20

#: Files of a batch.
FILES = 16


class Run:
    def __init__(self, spark: SparkSession, folder: str, batch_rows: int = 1_000_000, kept: tuple[str, ...] = ("NORMALIZED", "PARSED")):
        self.spark, self.folder, self.batch_rows, self.kept = spark, folder.rstrip("/"), batch_rows, kept

    def _entries(self, kind: str) -> list[str]:
        return [n for n in files.names(self.spark, f"{self.folder}/{kind}") if n.endswith(".json") and not n.startswith(".")]

    def _last(self, kind: str) -> dict:
        found = self._entries(kind)
        return json.loads(files.read_text(self.spark, f"{self.folder}/{kind}/{found[-1]}")) if found else {}

    def _add(self, kind: str, entry: dict) -> None:
        n = self._last(kind).get("n", 0) + 1
        files.write_once(self.spark, f"{self.folder}/{kind}/{n:012d}.json", json.dumps({"n": n, **entry}, sort_keys=True))

    @property
    def state(self) -> dict:
        return self._last("states")

    def history(self) -> list[str]:
        return [json.loads(files.read_text(self.spark, f"{self.folder}/states/{n}"))["status"] for n in self._entries("states")]

    def _go(self, *states: str) -> None:
        for to in states:
            at = self.state
            self._add("states", {"attempt": at["attempt"], "status": move(at["status"], to)})

    def request(self, action: str) -> None:
        if action not in ("pause", "resume", "cancel"):
            raise ValueError(f"a run can't be asked to {action}")
        self._add("control", {"action": action})

    def create(self, targets: DataFrame) -> str:
        """Stores the worklist for good and gives its digest; targets has identity and whatever a batch needs."""
        ids = targets.groupBy("identity").agg(F.count(F.lit(1)).alias("n"))
        bad = ids.where("n > 1 or identity is null")
        wrong = [str(r.identity) for r in bad.orderBy("identity").limit(SHOWN).collect()]
        if wrong:
            raise ValueError(f"identities that repeat or are null: {', '.join(wrong)} ({bad.count()})")
        if files.exists(self.spark, f"{self.folder}/worklist.json"):
            raise FileExistsError(f"{self.folder} has a worklist")
        self._deal(targets, 1)
        stored = self._attempt(1)
        digest = worklist_digest(stored).first().digest
        files.write_once(self.spark, f"{self.folder}/worklist.json", json.dumps({"digest": digest, "targets": stored.count(), "schema": stored.schema.json()}, sort_keys=True))
        self._add("states", {"attempt": 1, "status": "CREATED"})
        return digest

    def _deal(self, targets: DataFrame, attempt: int) -> None:
        batches = max(1, -(-targets.count() // self.batch_rows))
        dealt = targets.withColumn("_batch", F.pmod(F.xxhash64("identity"), F.lit(batches)).cast("int"))
        # A batch is FILES files at most, so that tasks share its work and a long worklist has no file for each task and batch.
        dealt = dealt.repartition("_batch", F.pmod(F.xxhash64("identity", F.lit(1)), F.lit(FILES)))
        dealt.write.mode("overwrite").partitionBy("_batch").parquet(f"{self.folder}/worklist/{attempt:06d}")

    def _attempt(self, attempt: int) -> DataFrame:
        found = self.spark.read.parquet(f"{self.folder}/worklist/{attempt:06d}")
        return found.drop("_batch")

    def worklist(self) -> DataFrame:
        """The targets, if they are still those that were stored."""
        said = json.loads(files.read_text(self.spark, f"{self.folder}/worklist.json"))
        stored = self._attempt(1)
        if worklist_digest(stored).first().digest != said["digest"]:
            raise ValueError("the worklist isn't the one that was stored")
        return stored

    def _committed(self, attempt: int) -> list[str]:
        at = f"{self.folder}/outcomes/{attempt:06d}"
        return [b for b in files.names(self.spark, at) if files.exists(self.spark, f"{at}/{b}/_SUCCESS")]

    def outcomes(self) -> DataFrame:
        """identity, what the last attempt gave it, and the attempt; null before any batch is done raises ValueError."""
        parts = [f"{self.folder}/outcomes/{a:06d}/{b}" for a in range(1, self.state["attempt"] + 1) for b in self._committed(a)]
        if not parts:
            raise ValueError("no batch is done")
        return latest(self.spark.read.parquet(*parts), ["identity"], ["attempt"])

    def retry(self) -> None:
        """A new attempt over the targets whose status isn't a kept one."""
        at = self.state
        if at["status"] != "COMPLETED_WITH_GAPS":
            raise ValueError(f"a run that is {at['status']} has no gaps to retry")
        self._deal(remaining(self.worklist(), self.outcomes(), "identity", retry=True, kept=self.kept), at["attempt"] + 1)
        self._add("states", {"attempt": at["attempt"] + 1, "status": "CREATED"})

    def execute(self, process: Callable[[DataFrame, int], DataFrame]) -> str:
        """Does the batches that aren't done and gives the state then. process takes targets and the attempt, and gives identity and status."""
        targets = self.worklist()
        status, attempt = self.state["status"], self.state["attempt"]
        asked = self._last("control").get("action")
        if status == "PAUSED" and asked == "pause":
            return status
        if status == "CREATED":
            self._go("QUEUED")
        if self.state["status"] in ("QUEUED", "PAUSED"):
            self._go("RUNNING")
        elif self.state["status"] != "RUNNING":
            raise ValueError(f"a run that is {status} can't be executed")
        source, done = f"{self.folder}/worklist/{attempt:06d}", set(self._committed(attempt))
        batches = [n for n in files.names(self.spark, source) if n.startswith("_batch=")]
        for name in batches:
            asked = self._last("control").get("action")
            if asked in ("pause", "cancel"):
                self._go("PAUSED" if asked == "pause" else "CANCELLED")
                return self.state["status"]
            if name.removeprefix("_batch=") not in done:
                rows = process(self.spark.read.schema(targets.schema).parquet(f"{source}/{name}"), attempt)
                rows.withColumn("attempt", F.lit(attempt)).write.mode("overwrite").parquet(f"{self.folder}/outcomes/{attempt:06d}/{name.removeprefix('_batch=')}")
        if not batches:
            self._go("COMPLETED")
            return "COMPLETED"
        kept = F.coalesce(F.col("status").isin(*self.kept), F.lit(False))
        told = self.outcomes().agg(F.count(F.lit(1)).alias("n"), F.count_if(~kept).alias("gaps")).first()
        whole = told.n == json.loads(files.read_text(self.spark, f"{self.folder}/worklist.json"))["targets"]
        self._go("FAILED" if not whole else "COMPLETED_WITH_GAPS" if told.gaps else "COMPLETED")
        return self.state["status"]
