"""ZIP archives as a Spark data source: spark.read.format("zip_members") and spark.readStream.format("zip_members").

The central directory of an archive says where its members lie, so an archive is many tasks' work: each reads a span of members
of some SPAN_BYTES through a file that is open for random access, and holds one member at a time. Files are reached through
Arrow's file systems (file, hdfs, s3 and others by their URI).

Options: path (an archive, or a folder of them), pattern (a regular expression that a member's name must contain), spanBytes. Rows
are archive, member, size and content. As a stream, archives are taken in the order of their names; an offset is the last name
that was read, so new archives need greater names than those before.

Empty archives have no rows, folders within an archive are no members, an archive that can't be read is an error.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SPAN_BYTES = 8_000_000
SCHEMA = "archive string, member string, size bigint, content binary"
_ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("content", pa.binary())])


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI; file:/x is read as file:///x."""
    if re.match("file:/[^/]", path):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def archives(path: str) -> list[str]:
    """Paths of an archive, or of the archives right in a folder, by name."""
    system, at = _opened(path)
    if system.get_file_info(at).type == fs.FileType.File:
        return [at]
    found = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".zip") and not f.base_name.startswith((".", "_")))


class _File:
    """What zipfile needs of a file; Arrow's raises other errors for places that aren't there."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.read, self.tell = file, file.read, file.tell

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            self.file.seek(offset, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from None
        return self.file.tell()

    def seekable(self) -> bool:
        return True


class Span(InputPartition):
    """Members of one archive that a task reads."""

    def __init__(self, archive: str, members: list[str]):
        self.archive, self.members = archive, members


class _Members:
    """What batch and stream share: spans from central directories, rows from spans."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.pattern = re.compile(options.get("pattern", ""))
        self.most = int(options.get("spanbytes", options.get("spanBytes", SPAN_BYTES)))

    def spans(self, paths: list[str]) -> list[Span]:
        system, _ = _opened(self.path)
        out = []
        for path in paths:
            held, size = [], 0
            with system.open_input_file(path) as f, zipfile.ZipFile(_File(f)) as z:  # the directory alone is read
                for info in z.infolist():
                    if info.is_dir() or not self.pattern.search(info.filename):
                        continue
                    if held and size + info.compress_size > self.most:
                        out.append(Span(path, held))
                        held, size = [], 0
                    held.append(info.filename)
                    size += info.compress_size
            if held:
                out.append(Span(path, held))
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Span):  # of a table without archives
            return
        system, _ = _opened(self.path)
        with system.open_input_file(partition.archive) as f, zipfile.ZipFile(_File(f)) as z:
            for name in partition.members:
                content = z.read(name)
                yield pa.RecordBatch.from_arrays([pa.array([partition.archive.rpartition("/")[2]]), pa.array([name]), pa.array([len(content)], pa.int64()), pa.array([content], pa.binary())], schema=_ARROW)


class ZipReader(_Members, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.spans(archives(self.path)) or [InputPartition(None)]


class ZipStream(_Members, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"last": ""}

    def latestOffset(self) -> dict:
        return {"last": max([p.rpartition("/")[2] for p in archives(self.path)], default="")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        fresh = [p for p in archives(self.path) if start["last"] < p.rpartition("/")[2] <= end["last"]]
        return self.spans(fresh) or [InputPartition(None)]

    def commit(self, end: dict) -> None:
        pass


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ZipReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ZipStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipMembers)


def write_archives(df: DataFrame, member: str, content: str, folder: str, most_bytes: int = 64_000_000, prefix: str = "part") -> DataFrame:
    """Rows as members of ZIP archives in a folder, one and more a task; gives archive, members and bytes of each.

    An archive is closed at most_bytes and appears under its name only when it is whole, so a task that is lost or done again
    leaves no other. Members of one name within a task follow one another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = _opened(folder)
        system.create_dir(at, recursive=True)
        task, done = TaskContext.get(), []

        def closed(buffer: io.BytesIO, z: zipfile.ZipFile, n: int) -> None:
            z.close()
            name = f"{prefix}-{task.partitionId():05d}-{len(done):05d}.zip"
            beside = f"{at}/_{task.taskAttemptId()}-{name}"
            with system.open_output_stream(beside) as out:
                out.write(buffer.getbuffer())
            system.move(beside, f"{at}/{name}")
            done.append((name, n, buffer.tell()))

        buffer, z, n = None, None, 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if buffer is None:
                    buffer, n = io.BytesIO(), 0
                    z = zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED)
                z.writestr(zipfile.ZipInfo(name or ""), value or b"", zipfile.ZIP_DEFLATED)
                n += 1
                if buffer.tell() >= most_bytes:
                    closed(buffer, z, n)
                    buffer = None
        if buffer is not None:
            closed(buffer, z, n)
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["archive", "members", "bytes"])

    rows = df.selectExpr(f"cast(`{member}` as string) as member", f"cast(`{content}` as binary) as content")
    return rows.mapInArrow(run, "archive string, members bigint, bytes bigint")
