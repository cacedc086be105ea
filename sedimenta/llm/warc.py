"""Web archives: written as WARC/1.1 records, read back, and assembled into one nested row for each capture.

A capture is a transaction of three records: the response (or, for a payload seen before, a revisit), its request and its
metadata; the latter two name the first in WARC-Concurrent-To. Spark's text writer ends each record with the two line
ends that the format asks for, so archives go to any file system that Spark writes to, under its commit protocol, as gzip.

Archives are read by the text reader as well, cut at the same two line ends and put together again as a stream, so a task
holds one record at a time, however long its archive.

Assembly joins request and metadata to the response or revisit through that identifier, and a revisit to its original
through WARC-Refers-To. Payloads stay where they are parsed: the joins move identifiers, lengths and digests. For writing,
only payloads that may repeat are shuffled, by a filter over the digests that do.

Of pages with equal payloads of at least `least_bytes`, those with the smallest page_id are responses and the others
revisits; smaller payloads are all responses.

Defined results: a null html is an empty payload, a null url an empty target. Rows that repeat the smallest page_id of a
payload are all responses. A null page_id is a response's only if its payload has no other; refers_to is null then. Payloads
of any length are kept whole; an empty table gives empty archives and an empty result; other columns are left alone. An
archive that ends within a record, or whose block doesn't match its digest, raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.bitfilter import KeyFilter
from sedimenta.llm.common import bounded_batches, new_folder, written

RECORD_END = "\r\n\r\n"
#: Identifiers are derived from page_id and payload under this name space.
NAMESPACE = uuid.UUID("6f1d2c3a-5b0e-4d57-9a3c-2f8e1b7c4d60")
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes that an archive is read in, and read bytes that are kept at most.
READ_BYTES = 1 << 20
#: Records of an archive at most, as one is read by one task.
FILE_RECORDS = 15_000

RECORD = (
    "record_id string, type string, concurrent_to string, refers_to_id string, target_uri string, page_id string, "
    "payload_bytes bigint, payload_digest string, block_bytes bigint, fields map<string, string>"
)


def payload_digest(raw: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(kind: str, page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind}/{page_id}/{digest}')}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block


def _safe(value: str | None) -> str:
    """A header's value: no control characters."""
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in value or "")


def capture_records(page_id: object, url: str | None, payload: bytes, keep_id: object, is_revisit: bool) -> list[bytes]:
    """The three records of a capture."""
    digest, target = payload_digest(payload), _safe(url)
    own = record_id("revisit" if is_revisit else "response", page_id, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target)]
    main = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if is_revisit:
        main += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id("response", keep_id, digest))]
        block = http
    else:
        block = http + payload
    main.append(("WARC-Block-Digest", f"sha1:{payload_digest(block)}"))
    request = f"GET {target} HTTP/1.1\r\n\r\n".encode("utf-8", "surrogatepass")
    named = "" if page_id is None else f"page-id: {quote(str(page_id), safe='')}\r\n"
    facts = f"{named}payload-bytes: {len(payload)}\r\n".encode()
    return [
        _record(main, block),
        _record([("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", page_id, digest)), ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/http; msgtype=request")], request),
        _record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", page_id, digest)), ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/warc-fields")], facts),
    ]


def write(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> str:
    """Archives of page_id, url and html; gives their folder."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = folder or new_folder(spark, "warc")
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digests = pages.select("page_id", F.sha1(body).alias("sha"), F.octet_length(body).alias("n")).where(F.col("n") >= least_bytes)
    # Payloads that occur once need no entry; the others' table is small beside the pages, and has no payloads.
    first = digests.groupBy("sha", "n").agg(F.min("page_id").alias("keep_id"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("sha", "n", "keep_id")
    first = written(first.withColumn("quick", F.xxhash64("sha")), "warc-repeated")
    rows = KeyFilter(first, "quick").probed(pages.select("page_id", "url", body.alias("body"), F.sha1(body).alias("sha")).withColumn("quick", F.xxhash64("sha")), "quick")
    alone = rows.where(~F.col("_hit")).select("page_id", "url", "body", F.lit(None).cast(pages.schema["page_id"].dataType).alias("keep_id"))
    among = rows.where("_hit").withColumn("n", F.octet_length("body")).join(first.drop("quick"), ["sha", "n"], "left").select("page_id", "url", "body", "keep_id")
    rows = alone.unionByName(among)
    revisit = F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, payload, keep_id, again in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                out += capture_records(page_id, url, payload, keep_id, again)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = rows.select("page_id", "url", "body", "keep_id", revisit.alias("again")).mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)
    return folder


class _Reader:
    """Bytes of archives, asked for part by part."""

    def __init__(self, parts: Iterable[bytes]):
        self.parts, self.have, self.read = iter(parts), bytearray(), 0

    def more(self) -> bool:
        part = next(self.parts, None)
        if part is None:
            return False
        if self.read > READ_BYTES:
            del self.have[: self.read]
            self.read = 0
        self.have += part
        return True

    def skip_line_ends(self) -> None:
        while True:
            while self.read < len(self.have) and self.have[self.read] in b"\r\n":
                self.read += 1
            if self.read < len(self.have) or not self.more():
                return

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to a mark, which is skipped; None at the archive's end."""
        start = self.read
        while (end := self.have.find(mark, start)) < 0:
            tried = len(self.have) - self.read - len(mark) + 1
            if not self.more():
                if self.have[self.read :].strip():
                    raise ValueError("the archive ends within a record")
                return None
            start = self.read + max(0, tried)
        out = bytes(self.have[self.read : end])
        self.read = end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.have) - self.read < n:
            if not self.more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.have[self.read : self.read + n])
        self.read += n
        return out


def unpacked(raw: bytes) -> Iterator[bytes]:
    """An archive's bytes in parts, of gzip members one after another or plain."""
    packed, unpack = raw[:2] == b"\x1f\x8b", zlib.decompressobj(31)
    for at in range(0, len(raw), READ_BYTES):
        part = raw[at : at + READ_BYTES]
        if not packed:
            yield part
            continue
        while part:
            yield unpack.decompress(part)
            part = unpack.unused_data
            if unpack.eof:  # another member may follow
                unpack = zlib.decompressobj(31)


def parse(raw: bytes) -> Iterator[dict]:
    """The records of one archive."""
    return records_in(unpacked(raw))


def records_in(parts: Iterable[bytes]) -> Iterator[dict]:
    """The records of archives that come in parts, one after another."""
    reader, end = _Reader(parts), RECORD_END.encode()
    while True:
        reader.skip_line_ends()
        head = reader.until(b"\r\n\r\n")
        if head is None:
            return
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        block = reader.take(int(fields["content-length"]))
        if reader.take(len(end)) != end:
            raise ValueError("a record's end is missing")
        if (said := fields.get("warc-block-digest")) and said != f"sha1:{payload_digest(block)}":
            raise ValueError(f"the block of {fields['warc-record-id']} is damaged")
        out = {"record_id": fields["warc-record-id"], "type": fields["warc-type"], "concurrent_to": fields.get("warc-concurrent-to"), "refers_to_id": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"), "block_bytes": len(block), "page_id": None, "payload_bytes": None, "payload_digest": None, "fields": []}
        if out["type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            out["payload_bytes"], out["payload_digest"] = len(payload), payload_digest(payload)
            if fields.get("warc-payload-digest") != f"sha1:{out['payload_digest']}":
                raise ValueError(f"the payload of {out['record_id']} is damaged")
        elif out["type"] == "revisit":
            out["payload_digest"] = fields["warc-payload-digest"].partition(":")[2]
        elif out["type"] == "metadata":
            facts = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in block.decode("utf-8", "surrogatepass").split("\r\n") if line)]
            page_id = dict(facts).get("page-id")
            out["fields"], out["page_id"] = facts, page_id if page_id is None else unquote(page_id)
        yield out


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in a folder, without their blocks."""
    bounded_batches(spark)
    kind = pa.struct([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to_id", pa.string()), ("target_uri", pa.string()), ("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The reader took the ends away; where a block's own line ends came before, it took those, and the rest follows.
        parts = (part for batch in batches for value in batch.column(0) for part in (value.as_buffer(), end))
        rows = []
        for record in records_in(parts):
            rows.append(record)
            if len(rows) == 2000:
                yield pa.RecordBatch.from_struct_array(pa.array(rows, kind))
                rows = []
        if rows:
            yield pa.RecordBatch.from_struct_array(pa.array(rows, kind))

    end = RECORD_END.encode()
    lines = spark.read.option("lineSep", RECORD_END).option("pathGlobFilter", "*.gz").text(folder)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: response, request, metadata and, of a revisit, its original."""
    main = records.where(F.col("type").isin("response", "revisit"))
    side = lambda kind, *columns: records.where(F.col("type") == kind).dropDuplicates(["concurrent_to"]).select(F.col("concurrent_to").alias("record_id"), F.struct(*columns).alias(kind))
    # A response is its own original, so that no key is null.
    originals = records.where("type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(F.first(F.struct("payload_bytes", "payload_digest")).alias("original"))
    facts = records.where("type = 'metadata'").groupBy(F.col("concurrent_to").alias("refers_to_id")).agg(F.first("page_id").alias("original_page_id"))
    out = main.join(side("request", "target_uri", "block_bytes"), "record_id", "left").join(side("metadata", "page_id", "fields"), "record_id", "left")
    found = originals.join(facts, "refers_to_id", "left")
    out = out.withColumn("refers_to_id", F.coalesce("refers_to_id", "record_id")).join(found, "refers_to_id", "left")
    return out.select(
        F.col("record_id").alias("capture_id"),
        "target_uri",
        F.struct("type", "payload_bytes", "payload_digest", "block_bytes").alias("response"),
        "request",
        "metadata",
        F.when(F.col("type") == "revisit", F.struct("original_page_id", F.col("original.payload_bytes").alias("payload_bytes"), F.col("original.payload_digest").alias("payload_digest"))).alias("original"),
    )


def captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every row, from archives that were written and read back."""
    kind = pages.schema["page_id"].dataType
    found = assemble(written(read(pages.sparkSession, write(pages, least_bytes)), "warc-records"))
    as_id = lambda c: F.col(c).cast(kind)
    return found.select(
        as_id("metadata.page_id").alias("page_id"),
        F.coalesce("response.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.coalesce("response.payload_digest", "original.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        as_id("original.original_page_id").alias("refers_to"),
    )
