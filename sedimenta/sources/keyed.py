"""A table of the latest row of each key: deltas by hash bucket, merged when they are read, compacted bucket by bucket.

    data/<name>/_bucket=<b>/...    a delta: the rows of one upsert, sorted by key within each bucket
    log/<version>.json             what is live: (name, buckets) of each delta, and how far each stream has come

An upsert writes its own rows, then the next log entry, by a rename that only one writer can win. Until then readers see the
old version, whatever is left behind by an upsert that breaks off. A bucket that has more deltas than most_deltas is rewritten as
one; other buckets aren't touched. An entry names everything live: its size is bounded by buckets and most_deltas.

Of equal keys and orders the row that is larger column by column wins; rows with a null key are kept as one key; an empty
upsert is a version without a delta.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import files
from sedimenta.operators.merge import latest


class KeyValueTable:
    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str = "cache_key", order: str = "updated_at", buckets: int = 64, most_deltas: int = 8):
        self.spark, self.folder, self.key, self.order = spark, str(folder).rstrip("/"), key, order
        self.empty = spark.createDataFrame([], schema)
        self.schema, self.buckets, self.most_deltas = self.empty.schema, buckets, most_deltas

    def _entry(self) -> dict:
        entries = [n for n in files.names(self.spark, f"{self.folder}/log") if n.endswith(".json") and not n.startswith(".")]
        return json.loads(files.read_text(self.spark, f"{self.folder}/log/{entries[-1]}")) if entries else {"version": 0, "buckets": self.buckets, "parts": [], "done": {}}

    def _commit(self, entry: dict) -> None:
        """The next version, or FileExistsError if another writer was first."""
        files.write_once(self.spark, f"{self.folder}/log/{entry['version']:012d}.json", json.dumps(entry, sort_keys=True))

    def _bucket(self, entry: dict):
        return F.pmod(F.xxhash64(self.key), F.lit(entry["buckets"])).cast("int")

    def _write(self, rows: DataFrame, entry: dict, kind: str) -> dict | None:
        """Rows of different keys as a delta; where they went."""
        name = f"{entry['version'] + 1:012d}-{kind}"
        files.remove(self.spark, f"{self.folder}/data/{name}")  # of a writer that broke off
        dealt = rows.withColumn("_bucket", self._bucket(entry)).repartition("_bucket").sortWithinPartitions("_bucket", self.key)
        dealt.write.partitionBy("_bucket").parquet(f"{self.folder}/data/{name}")
        held = [int(n.partition("=")[2]) for n in files.names(self.spark, f"{self.folder}/data/{name}") if n.startswith("_bucket=")]
        return {"name": name, "buckets": sorted(held)} if held else None

    def _rows(self, parts: list[dict]) -> DataFrame | None:
        found = []
        for p in parts:
            at = f"{self.folder}/data/{p['name']}"
            found.append(self.spark.read.schema(self.schema).parquet(*[f"{at}/_bucket={b}" for b in p["buckets"]]))
        return reduce(DataFrame.unionByName, found) if found else None

    def _read(self, entry: dict, wanted: set[int] | None = None) -> DataFrame:
        """Buckets of one delta as they lie; only those of several are merged."""
        parts = [{"name": p["name"], "buckets": [b for b in p["buckets"] if wanted is None or b in wanted]} for p in entry["parts"]]
        times = {b: sum(b in p["buckets"] for p in parts) for p in parts for b in p["buckets"]}
        split = lambda more: [{"name": p["name"], "buckets": own} for p in parts if (own := [b for b in p["buckets"] if (times[b] > 1) == more])]
        single, several = self._rows(split(False)), self._rows(split(True))
        merged = None if several is None else latest(several, [self.key], [self.order]).select(*self.schema.names)
        both = [df for df in (single, merged) if df is not None]
        return reduce(DataFrame.unionByName, both) if both else self.empty

    def read(self) -> DataFrame:
        return self._read(self._entry())

    def get(self, *keys: object) -> DataFrame:
        """Rows of some keys: their buckets alone, and of these what the files' statistics let through."""
        entry = self._entry()
        kind = self.schema[self.key].dataType
        asked = self.spark.createDataFrame([(k,) for k in keys], f"`{self.key}` {kind.simpleString()}")
        wanted = {r[0] for r in asked.select(self._bucket(entry)).collect()}
        return self._read(entry, wanted).where(F.col(self.key).isin(*keys))

    def upsert(self, changes: DataFrame, token: tuple[str, int] | None = None) -> bool:
        """The latest row of each key wins. token: a stream's name and batch; a batch that was committed before changes nothing."""
        entry = self._entry()
        if token and entry["done"].get(token[0], -1) >= token[1]:
            return False
        part = self._write(latest(changes.select(*self.schema.names), [self.key], [self.order]), entry, "delta")
        new = entry | {"version": entry["version"] + 1, "parts": entry["parts"] + ([part] if part else [])}
        if token:
            new["done"] = entry["done"] | {token[0]: token[1]}
        self._commit(new)
        self._compact(new)
        return True

    def _compact(self, entry: dict) -> None:
        times = {b: sum(b in p["buckets"] for p in entry["parts"]) for b in range(entry["buckets"])}
        full = {b for b, n in times.items() if n > self.most_deltas}
        if full:
            part = self._write(self._read(entry, full), entry, "merged")
            rest = [{"name": p["name"], "buckets": own} for p in entry["parts"] if (own := [b for b in p["buckets"] if b not in full])]
            self._commit(entry | {"version": entry["version"] + 1, "parts": [part, *rest]})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes deltas that none of the last versions names, and the entries before these. Readers of older versions must be done."""
        entries = [n for n in files.names(self.spark, f"{self.folder}/log") if n.endswith(".json")]
        live = {p["name"] for n in entries[-keep:] for p in json.loads(files.read_text(self.spark, f"{self.folder}/log/{n}"))["parts"]}
        gone = [n for n in files.names(self.spark, f"{self.folder}/data") if n not in live]
        for path in [f"data/{n}" for n in gone] + [f"log/{n}" for n in entries[:-keep]]:
            files.remove(self.spark, f"{self.folder}/{path}")
        return gone

    def count(self) -> int:
        return self.read().count()
