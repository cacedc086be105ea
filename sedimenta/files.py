"""Small files on any file system that Spark can reach: written whole, once, by Hadoop's rename; folders that go with the session."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, sorted; nothing if it isn't there."""
    fs, target = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Whole or not at all: written beside and renamed. A file that is there already raises FileExistsError, unless it may be replaced."""
    fs, target = _path(spark, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
        out.hsync()
    finally:
        out.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if replace else kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, how)
    except Py4JJavaError as e:
        fs.delete(beside, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise FileExistsError(path) from None
        raise


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path in spark.checkpoint.dir, which driver and executors share; it goes when the application ends.

    Where that isn't set, a local session gets a temporary folder; on a cluster it is an error, as executors couldn't read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='sedimenta-')}"
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/sedimenta-{label}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """df, written to the shared folder and read back: the lineage ends there."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _clean_up() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
                remove(spark, path)
        except Exception:  # the gateway may be gone already; the folder is only left over then
            return
