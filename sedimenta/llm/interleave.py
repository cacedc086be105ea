"""Interleaved documents: ordered text and media references from HTML, with the media resolved by digest.

sequences() parses each page into one array of structs in page order, each a text block or a media reference with its
position, source, digest and caption. A caption belongs to the media of its figure and doesn't appear as text again.
Media lie in a MediaStore, a Parquet table of raster images under the SHA-256 of their samples, each once. resolve() joins
references to what the store holds; only small rows of the two sides meet, as a store reads its own bytes back where they
lie and passes on what was measured, a row for each digest. Positions and captions stay aligned, as every reference keeps
its place in the array.

The raster format is PNG, 8-bit greyscale, ROW_SAMPLES samples a row: a payload is padded with 255 to whole rows, one at
least, and n_bytes says how many bytes were there before.

Defined results: null pages and texts count as empty; an empty page has no elements; a reference whose digest the store
lacks keeps its place with null measures; rows that repeat are resolved each on its own; texts of any length are stored whole;
an empty table gives an empty store and an empty result; other columns, whatever their names, are left alone. Of bad HTML no text
is lost: an end tag closes what was left open within its element, content closes an open head, and a caption left open ends with its figure or the page.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.bitfilter import KeyFilter
from sedimenta.llm.common import bounded_batches, new_folder, written

ROW_SAMPLES = 576
TAIL_BYTES = 32
#: zlib's level for the rasters.
LEVEL = 1
#: References to the store are written as this scheme and the digest.
SCHEME = "sha256:"
#: Elements that end a text block, and elements whose content is no text. Fixed values.
BLOCKS = set("address article aside blockquote body br dd div dl dt figcaption figure footer h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table td th tr ul".split())
SILENT = set("head script style template noscript".split())
MEDIA = set("img video audio source embed object".split())
IN_HEAD = set("head title base link meta script style noscript template".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())

ELEMENT = "struct<kind: string, position: int, text: string, src: string, digest: string, caption: string>"
MEASURES = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


class _Sequence(HTMLParser):
    """Collects elements in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[dict] = []
        self.text: list[str] = []
        self.open: list[str] = []
        self.counts: Counter[str] = Counter()
        self.figures: list[list[dict]] = []
        self.caption: list[str] | None = None

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            self._add("text", text, None, None)

    def _add(self, kind: str, text: str | None, src: str | None, caption: str | None) -> dict:
        digest = src[len(SCHEME) :] if src and src.startswith(SCHEME) else None
        element = {"kind": kind, "position": len(self.elements), "text": text, "src": src, "digest": digest, "caption": caption}
        self.elements.append(element)
        return element

    def _silent(self) -> bool:
        return any(self.counts[t] for t in SILENT)

    def _close_until(self, tag: str) -> None:
        """Ends the innermost such element and all that is open in it."""
        while self.open:
            last = self.open.pop()
            self.counts[last] -= 1
            if last == "figcaption":
                self._end_caption()
            elif last == "figure":
                self._end_figure()
            if last == tag:
                return

    def _end_caption(self) -> None:
        if self.caption is None:
            return
        text, self.caption = " ".join("".join(self.caption).split()), None
        if self.figures:
            self.figures[-1].append({"caption": text})
        elif text:
            self._add("text", text, None, None)

    def _end_figure(self) -> None:
        self._flush()
        if not self.figures:
            return
        parts = self.figures.pop()
        captions = [p["caption"] for p in parts if "kind" not in p]
        media = [p for p in parts if "kind" in p]
        for found in media:
            if captions and captions[-1]:
                found["caption"] = captions[-1]
        # A caption of no media is text, and so is any but the last.
        for text in captions if not media else captions[:-1]:
            if text:
                self._add("text", text, None, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.counts["head"] and tag not in IN_HEAD and not any(self.counts[t] for t in SILENT - {"head"}):
            self._close_until("head")
        if tag in BLOCKS and self.caption is None:
            self._flush()
        if tag in MEDIA:
            own = dict(attrs)
            src = own.get("src") or own.get("data")
            if src and not self._silent():
                self._flush()
                found = self._add("media", None, src, own.get("alt") or own.get("title"))
                if self.figures:
                    self.figures[-1].append(found)
        if tag in VOID:
            return
        if tag == "figure":
            self.figures.append([])
        elif tag == "figcaption":
            self._end_caption()
            self._flush()
            self.caption = []
        self.open.append(tag)
        self.counts[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS and self.caption is None:
            self._flush()
        if self.counts[tag] > 0:
            self._close_until(tag)

    def handle_data(self, data: str) -> None:
        if self.counts["head"] and data.strip() and self.open[-1] == "head":
            self._close_until("head")
        if not self._silent():
            (self.text if self.caption is None else self.caption).append(data)

    def finish(self) -> None:
        self.close()
        self._close_until("")
        self._flush()


def parse(html: str | None) -> list[dict]:
    """The elements of one page."""
    reader = _Sequence()
    reader.feed(html or "")
    reader.finish()
    return reader.elements


def sequences(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key and elements, an array in page order, of every row."""
    bounded_batches(pages.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("position", pa.int32()), ("text", pa.string()), ("src", pa.string()), ("digest", pa.string()), ("caption", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([parse(h) for h in batch.column(1).to_pylist()], kind)], [key, "elements"])

    return pages.select(key, html).mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, elements array<{ELEMENT}>")


def padded(raw: bytes) -> bytes:
    """raw with bytes 255 up to a positive multiple of ROW_SAMPLES."""
    return raw + b"\xff" * (-len(raw) % ROW_SAMPLES if raw else ROW_SAMPLES)


def _png_chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(samples: bytes) -> bytes:
    """An 8-bit greyscale PNG, rows unfiltered."""
    rows = len(samples) // ROW_SAMPLES
    lines = np.zeros((rows, ROW_SAMPLES + 1), dtype=np.uint8)
    lines[:, 1:] = np.frombuffer(samples, dtype=np.uint8).reshape(rows, ROW_SAMPLES)
    head = struct.pack(">IIBBBBB", ROW_SAMPLES, rows, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _png_chunk(b"IHDR", head) + _png_chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _png_chunk(b"IEND", b"")


def from_png(png: bytes) -> bytes:
    """The samples of such a PNG; its checksums must hold."""
    if png[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, data, shape = 8, [], (0, 0)
    while at < len(png):
        (n,), kind = struct.unpack(">I", png[at : at + 4]), png[at + 4 : at + 8]
        body = png[at + 8 : at + 8 + n]
        if struct.unpack(">I", png[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError("a PNG chunk is damaged")
        if kind == b"IHDR":
            width, rows, *rest = struct.unpack(">IIBBBBB", body)
            if rest != [8, 0, 0, 0, 0]:
                raise ValueError("not 8-bit greyscale")
            shape = (rows, width)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(data)), dtype=np.uint8).reshape(shape[0], shape[1] + 1)
    if lines[:, 0].any():
        raise ValueError("filtered rows")
    return lines[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Mean and spread of the samples, entropy of their histogram, and a 64-bit hash of which of 65 equal spans are brighter than the next."""
    s = np.frombuffer(samples, dtype=np.uint8)
    share = np.bincount(s, minlength=256) / len(s)
    mean = float(share @ np.arange(256))
    spread = float(np.sqrt(max(0.0, share @ (np.arange(256) - mean) ** 2)))
    entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
    edges = np.arange(66) * len(s) // 65
    spans = np.add.reduceat(s, edges[:-1], dtype=np.int64) * 1_000_000 // np.diff(edges)
    bright = int((np.uint64(1) << np.flatnonzero(spans[:-1] > spans[1:]).astype(np.uint64)).sum(dtype=np.uint64))
    return f"mean={mean:.4f};spread={spread:.4f};entropy={entropy:.4f};dhash={bright:016x}"


class MediaStore:
    """Rasters under the digest of their samples, in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def from_texts(cls, docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None) -> tuple[MediaStore, DataFrame]:
        """Stores each different text as a raster; also gives a page for each row that shows it: key, n_bytes and html."""
        spark = docs.sparkSession
        bounded_batches(spark)
        store = cls(spark, folder or new_folder(spark, "media"))
        raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
        n = F.octet_length(raw)
        whole = F.greatest(F.ceil(n / ROW_SAMPLES), F.lit(1)) * ROW_SAMPLES
        digest = F.sha2(F.rpad(raw, whole.cast("int"), F.lit(b"\xff")), 256)
        name = F.coalesce(F.col(key).cast("string"), F.lit("None"))
        for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            name = F.replace(name, F.lit(plain), F.lit(coded))
        figure = F.concat(F.lit("<article><h1>"), name, F.lit(f'</h1><figure><img src="{SCHEME}'), F.col("digest"), F.lit('"><figcaption>'), name, F.lit(", "), F.col("n_bytes").cast("string"), F.lit(" bytes</figcaption></figure></article>"))
        pages = written(docs.select(key, n.cast("bigint").alias("n_bytes"), digest.alias("digest")).withColumn("html", figure), "media-pages")
        # A text that occurs once is stored where it is; of those that may repeat, one of each.
        repeated = KeyFilter(pages.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "digest")
        tried = repeated.probed(docs.select(raw.alias("raw"), digest.alias("digest")), "digest")
        once = tried.where(~F.col("_hit")).select("raw", "digest").unionByName(tried.where("_hit").select("raw", "digest").dropDuplicates(["digest"]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rasters = []
                for value, named in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    samples = padded(value)
                    if hashlib.sha256(samples).hexdigest() != named:
                        raise ValueError(f"the samples of {named} are others")
                    rasters.append(to_png(samples))
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rasters, pa.binary())], ["digest", "media"])

        once.mapInArrow(run, "digest string, media binary").write.option("compression", "none").parquet(store.folder)
        return store, pages.select(key, "n_bytes", "html")

    def measured(self) -> DataFrame:
        """digest and what the stored bytes give when read back, a row for each different digest."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[list] = [[] for _ in MEASURES]
                for digest, png in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    samples = from_png(png)
                    found = hashlib.sha256(samples).hexdigest()
                    if found != digest:
                        raise ValueError(f"the raster {digest} is damaged")
                    for to, value in zip(out, (len(samples), found, zlib.crc32(samples[-TAIL_BYTES:]), len(png), hashlib.sha256(png).hexdigest(), feature(samples)), strict=True):
                        to.append(value)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))], ["digest", *MEASURES])

        schema = "digest string, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
        return self.spark.read.parquet(self.folder).select("digest", "media").mapInArrow(run, schema)


def resolve(sequenced: DataFrame, key: str, store: MediaStore) -> DataFrame:
    """key, position, kind, text, src, caption and the store's measures of every element; text elements have no measures."""
    each = sequenced.select(key, F.explode("elements").alias("e")).select(key, "e.*")
    return each.join(store.measured(), "digest", "left")


def media_features(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the measures of each document's raster."""
    store, pages = MediaStore.from_texts(docs)
    # Rows that repeat a doc_id stay apart: a page is its row, so n_bytes travels with it.
    shown = sequences(pages.withColumn("_page", F.struct("doc_id", "n_bytes")), "_page")
    found = resolve(shown, "_page", store).where("kind = 'media'")
    return found.select("_page.doc_id", "_page.n_bytes", *MEASURES)
