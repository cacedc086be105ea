"""Sinks: content-addressed bodies, exports, indexes, and releases that are validated before they are published."""

from __future__ import annotations

import json
import os
import stat
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.session import spread
from sedimenta.sources.keyed import KeyValueTable

__all__ = ["KeyValueTable"]

#: The columns of an export of references, in order. Fixed values.
REFERENCE_COLUMNS = [
    "source_reference_id",
    "record_id",
    "raw_url",
    "normalized_url",
    "normalization_status",
    "normalization_reason",
    "label",
    "title",
    "publisher",
    "citation_text",
    "publication_date",
    "source_type",
    "domain",
    "current_reachability_status",
    "content_preservation_status",
    "duplicate_relationship",
    "malformed",
    "manual_review",
    "external_source_id",
]


def write_text(path: str | Path, text: str) -> None:
    """Whole or not at all: written beside, synced and renamed."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def write_json(path: str | Path, value: object) -> None:
    write_text(path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def store_bodies(responses: DataFrame, bodies: str, attempts: str) -> None:
    """Each different body once under its SHA-256; every attempt as a row without the body."""
    rows = responses.withColumn("sha256", F.sha2("body", 256))
    rows.drop("body").write.mode("append").parquet(attempts)
    new = rows.select("sha256", "body").dropDuplicates(["sha256"])
    spark = responses.sparkSession
    if _exists(spark, bodies):
        new = new.join(spark.read.parquet(bodies).select("sha256"), "sha256", "left_anti")
    new.write.mode("append").parquet(bodies)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def append_audit(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def export_references(references: DataFrame, folder: str) -> None:
    """JSON lines, CSV, and the sorted different URLs of both forms; columns that references lacks are empty."""
    rows = references.select(*[F.col(c) if c in references.columns else F.lit(None).cast("string").alias(c) for c in REFERENCE_COLUMNS])
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/references_jsonl")
    rows.write.mode("overwrite").option("header", True).csv(f"{folder}/references_csv")
    fine = F.coalesce("normalization_status", F.lit("")) != "malformed"
    for c, kept in (("raw_url", F.lit(True)), ("normalized_url", fine)):
        urls = rows.where((F.coalesce(F.col(c), F.lit("")) != "") & kept).select(c).distinct()
        urls.orderBy(c).write.mode("overwrite").text(f"{folder}/{c}s")


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """path and sha256 of every file below a folder, but its own manifest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    base = folder.removeprefix("file:").rstrip("/")
    path = F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), f"^{base}/", "")
    return files.select(path.alias("path"), F.sha2("content", 256).alias("sha256")).where("path != 'checksums.sha256'")


def write_manifest(spark: SparkSession, folder: str) -> None:
    rows = checksums(spark, folder).orderBy("path").toLocalIterator()
    write_text(Path(folder) / "checksums.sha256", "".join(f"{r.sha256}  {r.path}\n" for r in rows))


def verify_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """path and problem (missing, changed or unlisted) of every file that doesn't match the manifest."""
    lines = spark.read.text(f"{folder}/checksums.sha256").select(F.substring("value", 1, 64).alias("said"), F.expr("substring(value, 67)").alias("path"))
    both = lines.join(checksums(spark, folder), "path", "full_outer")
    problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("said").isNull(), "unlisted").when(F.col("said") != F.col("sha256"), "changed")
    return both.select("path", problem.alias("problem")).where("problem is not null")


def seal(folder: str | Path) -> None:
    """Marks a release as final and takes the right to write from its files."""
    folder = Path(folder)
    (folder / ".immutable").touch()
    for path in folder.rglob("*"):
        if path.is_file():
            path.chmod(path.stat().st_mode & ~(stat.S_IWUSR | stat.S_IWGRP | stat.S_IWOTH))


class Release:
    """A folder of releases, and a link `current` to the one that is published."""

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def build(self, spark: SparkSession, release_id: str, tables: dict[str, DataFrame], validate: Callable[[dict[str, DataFrame]], list[str]]) -> Path:
        """Writes the tables, validates what was written, and only then writes the report, manifest and seal."""
        folder = self.root / release_id
        if folder.exists():
            raise FileExistsError(f"the release {release_id} exists")
        for name, df in tables.items():
            df.write.parquet(str(folder / "data" / name))
        written = {name: spark.read.parquet(str(folder / "data" / name)) for name in tables}
        faults = validate(written)
        write_json(folder / "reports" / "validation.json", {"release": release_id, "passed": not faults, "faults": faults})
        if faults:
            raise ValueError(f"the release {release_id} has faults: {', '.join(faults)}")
        write_manifest(spark, str(folder))
        seal(folder)
        return folder

    @property
    def current(self) -> Path | None:
        link = self.root / "current"
        return link.resolve() if link.is_symlink() else None

    def publish(self, release_id: str, healthy: Callable[[Path], bool]) -> bool:
        """Moves the link at once; if the release isn't healthy, moves it back."""
        before, folder = self.current, self.root / release_id
        if not (folder / ".immutable").exists():
            raise ValueError(f"the release {release_id} isn't sealed")
        self._point(folder)
        if healthy(folder):
            return True
        if before is None:
            (self.root / "current").unlink()
        else:
            self._point(before)
        return False

    def _point(self, folder: Path) -> None:
        new = self.root / f".current-{os.getpid()}"
        new.unlink(missing_ok=True)
        new.symlink_to(folder.name)
        os.replace(new, self.root / "current")


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """A small aggregate as a table; more than `most` rows are an error, never cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(cell(v) for v in r) + " |" for r in rows)]) + "\n"


def file_for_each(rows: DataFrame, path: str) -> None:
    """A JSON file for each row, by all cores; tasks move their own files in place, as one by one on the driver they take longer than to write."""
    spread(rows).write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(path)


def json_parts(rows: DataFrame, path: str) -> None:
    """JSON lines in parts, dealt to all cores; a larger table has more parts, so none grows with it."""
    spread(rows).write.json(path)
