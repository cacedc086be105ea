"""Sources: JSON folders and lines, ZIP snapshots, captured responses, and connectors that are registered by name."""

from __future__ import annotations

import json
import uuid
from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sedimenta import files
from sedimenta.functions.values import rows_by_header
from sedimenta.operators.extract import FieldRule, extract_records
from sedimenta.operators.schedule import numbered
from sedimenta.sources import archives

CORRUPT = "_corrupt"


def json_folder(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One object for each file; a bad file is a row with its text in _corrupt. `file` is its name."""
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    rows = spark.read.schema(whole).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", "*.json").json(path)
    return rows.withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))


def json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One object for each line; blank lines are skipped, bad ones kept in _corrupt; line counts from 1 within its file.

    Lines are numbered by ranges of a file and moved by the lines before, so that a large file is many tasks' work.
    """
    lines = spark.read.text(path).withColumn("file", F.input_file_name()).withColumn("_at", F.monotonically_increasing_id())
    counted = numbered(lines, ["file"], [F.col("_at")], "line").where(F.trim("value") != "")
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = counted.withColumn("_r", F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    return parsed.select("_r.*", "line", F.regexp_extract("file", r"([^/]+)$", 1).alias("file"))


def zip_members(spark: SparkSession, path: str, pattern: str = r"\.json$") -> DataFrame:
    """archive, member and text of the files in ZIP snapshots, by spans of members."""
    archives.register(spark)
    rows = spark.read.format("zip_members").option("path", path).option("pattern", pattern).load()
    return rows.select("archive", "member", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def joined_parts(spark: SparkSession, path: str) -> bytes:
    """A file that was stored as part-* files, in their order; on the driver, for one snapshot."""
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).orderBy("path").select("content").toLocalIterator()
    return b"".join(bytes(p.content) for p in parts)


def assemble_parts(spark: SparkSession, folder: str, target: str) -> None:
    """Puts the part-* files of a folder together as one file, in order of their names; bytes stream through, and the file appears when it is whole."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    whole = path(target)
    beside = path(whole.getParent(), f".{whole.getName()}.{uuid.uuid4().hex}")
    system = whole.getFileSystem(conf)
    out = system.create(beside, False)
    try:
        for name in files.names(spark, folder):
            if name.startswith("part-"):
                part = path(f"{folder}/{name}")
                stream = part.getFileSystem(conf).open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
                finally:
                    stream.close()
    finally:
        out.close()
    if not system.rename(beside, whole):
        raise FileExistsError(target)


def normalized_records(spark: SparkSession, path: str, schema: StructType, columns: dict[str, str]) -> DataFrame:
    """Entity files under the names that a snapshot's rows have."""
    return json_folder(spark, path, schema).where(f"{CORRUPT} is null").select(*[F.col(c).alias(name) for name, c in columns.items()])


def capture_rows(df: DataFrame, key: str, payload: str, newest: int | None = None, types: list[str] | None = None) -> DataFrame:
    """Captures of an archive's answer, an array of arrays whose first is the header: key and a map for each, newest first."""
    table = F.from_json(payload, "array<array<string>>")
    rows = rows_by_header(table[0], F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0))))
    each = df.select(key, F.explode(rows).alias("capture"))
    if types:
        each = each.where(F.col("capture")["mimetype"].isin(*types))
    if newest is not None:
        n = F.row_number().over(Window.partitionBy(key).orderBy(F.col("capture")["timestamp"].desc()))
        each = each.withColumn("_n", n).where(F.col("_n") <= newest).drop("_n")
    return each


def latest_capture(df: DataFrame, key: str, payload: str) -> DataFrame:
    rows = capture_rows(df, key, payload)
    return rows.groupBy(key).agg(F.max_by("capture", F.col("capture")["timestamp"]).alias("capture"))


def capture_by_provider(df: DataFrame, key: str, providers: list[str]) -> DataFrame:
    """key, provider and capture of the first provider, in the order given, that has one. df has a column for each."""
    found = [F.when(F.col(p).isNotNull(), F.struct(F.lit(p).alias("provider"), F.col(p).alias("capture"))) for p in providers]
    return df.select(key, F.coalesce(*found).alias("f")).where("f is not null").select(key, "f.*")


def api_payload(payload: str | Column, schema: str) -> Column:
    """An endpoint's object: the first of a list, or the object itself; null without an id."""
    text = F.trim(F.col(payload) if isinstance(payload, str) else payload)
    one = F.when(text.startswith("["), F.try_element_at(F.from_json(text, f"array<{schema}>"), F.lit(1))).otherwise(F.from_json(text, schema))
    return F.when(one["id"].isNotNull(), one)


def endpoint_urls(base: str, code: str | Column, sequence: str | Column) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    s = F.col(sequence) if isinstance(sequence, str) else sequence
    return F.array_compact(F.array(F.when(c.isNotNull(), F.concat(F.lit(f"{base}/wp-json/wp/v2/incidents?slug="), F.url_encode(c))), F.when(s.isNotNull(), F.concat(F.lit(f"{base}/wp-json/wp/v2/incidents/"), s.cast("string")))))


def with_snapshot_text(records: DataFrame, snapshots: DataFrame, key: str, least: int = 100) -> DataFrame:
    """A record's saved text where it is long enough, and the largest number of sources that it declares."""
    counts = F.transform(F.regexp_extract_all(F.coalesce("snapshot_text", F.lit("")), F.lit(r"Sources\s*\((\d[\d,]*)\)"), F.lit(1)), lambda n: F.replace(n, F.lit(","), F.lit("")).cast("int"))
    out = records.join(snapshots.select(key, "snapshot_text"), key, "left")
    return out.withColumn("saved_text", F.when(F.length("snapshot_text") >= least, F.col("snapshot_text"))).withColumn("declared_sources", F.array_max(counts))


class Connector(ABC):
    """A kind of site: what records it has, where they are, and how a response becomes records. Responses come as a table."""

    key = ""

    @abstractmethod
    def record_types(self) -> list[str]: ...

    @abstractmethod
    def discover(self, responses: DataFrame) -> DataFrame:
        """identity and url of each target."""

    @abstractmethod
    def parse(self, responses: DataFrame) -> DataFrame:
        """record_id, fields, references and error of each response."""

    def analyze(self, responses: DataFrame) -> DataFrame:
        """How often each field was found, and links, in a sample of responses."""
        parsed = self.parse(responses)
        fields = parsed.select(F.explode(F.map_keys("fields")).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
        links = parsed.agg(F.sum(F.size("references")).alias("n")).select(F.lit("(references)").alias("field"), "n")
        return fields.unionByName(links)


_connectors: dict[str, type[Connector]] = {}


def register(connector: type[Connector]) -> type[Connector]:
    _connectors[connector.key] = connector
    return connector


def connector(key: str, **options) -> Connector:
    if key not in _connectors:
        raise KeyError(f"no connector {key!r}; known: {', '.join(sorted(_connectors))}")
    return _connectors[key](**options)


@register
class CatalogueConnector(Connector):
    """Pages of a catalogue, by rules kept as data."""

    key = "catalogue"
    RULES = (
        FieldRule("accession", r"<article[^>]*\bdata-accession=[\"']([^\"']+)[\"']", required=True),
        FieldRule("title", r"(?s)<h1[^>]*class=[\"'][^\"']*entry-title[^\"']*[\"'][^>]*>(.*?)</h1>", required=True),
        FieldRule("published", r"<time[^>]*class=[\"'][^\"']*published[^\"']*[\"'][^>]*datetime=[\"']([^\"']+)[\"']"),
        FieldRule("abstract", r"(?s)<section[^>]*class=[\"'][^\"']*abstract[^\"']*[\"'][^>]*>(.*?)</section>", required=True),
        FieldRule("references", r"<a[^>]*class=[\"'][^\"']*reference-link[^\"']*[\"'][^>]*href=[\"']([^\"']*)[\"']", many=True),
    )

    def record_types(self) -> list[str]:
        return ["catalogue_entry"]

    def discover(self, responses: DataFrame) -> DataFrame:
        return responses.select(F.col("url").alias("identity"), "url").distinct()

    def parse(self, responses: DataFrame) -> DataFrame:
        body = responses.withColumn("_html", F.col("body").cast("string"))
        found = extract_records(body, "url", "_html", list(self.RULES))
        missing = F.try_element_at("missing", F.lit(1))
        error = F.when(F.array_contains("missing", "accession"), "catalogue_entry_missing").when(missing.isNotNull(), F.concat(F.lit("missing_required_field:"), missing))
        return found.select(F.col("fields")["accession"].alias("record_id"), "url", "fields", F.col("lists")["references"].alias("references"), error.alias("error"))


def snapshot_import(payloads: DataFrame, payload: str, schema: str, names: dict[str, str]) -> DataFrame:
    """Normalised rows of a snapshot's JSON, by a map of new names to paths in it; the raw text stays."""
    rows = payloads.withColumn("_p", F.from_json(payload, schema))
    return rows.select(*[F.col(f"_p.{path}").alias(name) for name, path in names.items()], F.col(payload).alias("raw"))


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def database_table(spark: SparkSession, url: str, name: str, key: str | None = None, parts: int = 1, properties: dict[str, str] | None = None) -> DataFrame:
    """A table of a database by JDBC; with a numeric key it is read in so many ranges of it, between its least and greatest."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **(properties or {}))
    if key is None or parts < 2:
        return reader.load()
    low, high = spark.read.format("jdbc").options(url=url, query=f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {name}", **(properties or {})).load().first()
    if low is None:
        return reader.load()
    return reader.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)).load()


def write_database_table(df: DataFrame, url: str, name: str, mode: str = "append", properties: dict[str, str] | None = None) -> None:
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=name, **(properties or {})).save()
