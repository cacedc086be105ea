"""Releases on any file system: built once, committed by one rename, published by a log that a lost driver can't tear.

    releases/<id>/data/<table>/...    the tables
    releases/<id>/manifest/...        path, bytes and sha256 of every file of the tables, as a table
    releases/<id>/report.json         what validation found
    releases/<id>/release.json        the commit: a release without it isn't one
    published/<n>.json                which release is current from n on, and what it replaced

A build that breaks off is taken up again: tables that were written whole stay. Publishing first checks the files against the
manifest and asks whether the candidate is healthy; then the next entry of the log is written by a rename that one writer wins. Readers
take the last entry. Rolling back is an entry as well. Nothing is changed in place and nothing passes the driver but counts.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import files

#: Differences that are named in an error; their number is always told.
SHOWN = 20


class ReleaseStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def folder(self, release: str) -> str:
        return f"{self.root}/releases/{release}"

    def committed(self, release: str) -> bool:
        return files.exists(self.spark, f"{self.folder(release)}/release.json")

    def tables(self, release: str) -> dict[str, DataFrame]:
        base = f"{self.folder(release)}/data"
        return {name: self.spark.read.parquet(f"{base}/{name}") for name in files.names(self.spark, base)}

    def build(self, release: str, tables: dict[str, DataFrame], validate: Callable[[dict[str, DataFrame]], list[str]]) -> str:
        """Writes what isn't there yet, validates what was written, and commits it; a release with faults is never committed."""
        at = self.folder(release)
        if self.committed(release):
            raise FileExistsError(f"the release {release} exists")
        for name, df in tables.items():
            if not files.exists(self.spark, f"{at}/data/{name}/_SUCCESS"):
                df.write.mode("overwrite").parquet(f"{at}/data/{name}")
        faults = validate(self.tables(release))
        files.write_once(self.spark, f"{at}/report.json", json.dumps({"release": release, "passed": not faults, "faults": faults}, sort_keys=True), replace=True)
        if faults:
            raise ValueError(f"the release {release} has faults: {', '.join(faults[:SHOWN])} ({len(faults)})")
        self.checksums(release).write.mode("overwrite").parquet(f"{at}/manifest")
        listed = self.spark.read.parquet(f"{at}/manifest").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).first()
        files.write_once(self.spark, f"{at}/release.json", json.dumps({"release": release, "tables": sorted(tables), "files": listed.n, "bytes": listed.b or 0}, sort_keys=True))
        return at

    def checksums(self, release: str) -> DataFrame:
        """path (below data), bytes and sha256 of every file of the tables; a file is read in one task."""
        at = f"{self.folder(release)}/data"
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(at)
        path = F.regexp_extract("path", f"/releases/{release}/data/(.*)$", 1)
        return found.select(path.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))

    def problems(self, release: str) -> DataFrame:
        """path and problem (missing, changed or unlisted) of every file that isn't as the manifest says."""
        said = self.spark.read.parquet(f"{self.folder(release)}/manifest").select("path", F.col("sha256").alias("said"))
        both = said.join(self.checksums(release), "path", "full_outer")
        problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("said").isNull(), "unlisted").when(F.col("said") != F.col("sha256"), "changed")
        return both.select("path", problem.alias("problem")).where("problem is not null")

    def _log(self) -> list[dict]:
        at = f"{self.root}/published"
        last = [n for n in files.names(self.spark, at) if n.endswith(".json") and not n.startswith(".")][-1:]
        return [json.loads(files.read_text(self.spark, f"{at}/{n}")) for n in last]

    @property
    def current(self) -> str | None:
        last = self._log()
        return last[0]["release"] if last else None

    def _point(self, release: str | None, why: str) -> None:
        last = self._log()
        n = last[0]["n"] + 1 if last else 1
        files.write_once(self.spark, f"{self.root}/published/{n:012d}.json", json.dumps({"n": n, "release": release, "replaced": last[0]["release"] if last else None, "why": why}, sort_keys=True))

    def publish(self, release: str, healthy: Callable[[dict[str, DataFrame]], bool]) -> bool:
        """Makes a release current if its files are whole and it is healthy; else the one before stays."""
        if not self.committed(release):
            raise ValueError(f"the release {release} isn't committed")
        wrong = self.problems(release).limit(SHOWN).collect()
        if wrong:
            raise ValueError(f"the release {release} isn't as its manifest says: {', '.join(f'{r.path} {r.problem}' for r in wrong)}")
        if not healthy(self.tables(release)):
            return False
        self._point(release, "published")
        return True

    def roll_back(self) -> str | None:
        """Makes the release current that the last one replaced."""
        last = self._log()
        if last:
            self._point(last[0]["replaced"], "rolled back")
        return self.current

    def read(self, table: str) -> DataFrame:
        """A table of the current release."""
        if self.current is None:
            raise ValueError("nothing is published")
        return self.spark.read.parquet(f"{self.folder(self.current)}/data/{table}")
