import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sedimenta import files
from sedimenta.sources import readers, writers
from sedimenta.sources.keyed import KeyValueTable
from sedimenta.streaming import live
from sedimenta.streaming.replay import replay

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType())])


def test_json_folder_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1,\n "name": "x"}')
    (tmp_path / "b.json").write_text("{broken")
    rows = readers.json_folder(spark, str(tmp_path), SCHEMA).orderBy("file").collect()
    assert [(r.file, r.id, r._corrupt is None) for r in rows] == [("a.json", 1, True), ("b.json", None, False)]
    (tmp_path / "l.jsonl").write_text('{"id": 1}\n\n{"id": 2}\nbad\n')
    lines = readers.json_lines(spark, str(tmp_path / "l.jsonl"), SCHEMA).orderBy("line").collect()
    assert [(r.line, r.id) for r in lines] == [(1, 1), (3, 2), (4, None)] and lines[2]._corrupt == "bad"
    assert readers.normalized_records(spark, str(tmp_path), SCHEMA, {"key": "id"}).collect()[0].key == 1


def test_zip_snapshots_and_parts(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("data/1.json", '{"id": 1, "name": "n"}')
        z.writestr("readme.md", "x")
    members = readers.zip_members(spark, str(tmp_path / "s.zip"))
    assert [r.member for r in members.collect()] == ["data/1.json"]
    out = readers.snapshot_import(members, "text", "struct<id: bigint, name: string>", {"record_id": "id", "title": "name"}).first()
    assert (out.record_id, out.title, json.loads(out.raw)["id"]) == (1, "n", 1)
    for i, part in enumerate([b"ab", b"cd"]):
        (tmp_path / f"part-{i:03d}").write_bytes(part)
    assert readers.joined_parts(spark, str(tmp_path)) == b"abcd"


def test_saved_text_is_a_fallback(spark):
    records = spark.createDataFrame([(1,), (2,)], "id int")
    saved = spark.createDataFrame([(1, "Sources (3) " + "x" * 100 + " Sources (12)"), (2, "short")], "id int, snapshot_text string")
    rows = {r.id: (r.saved_text is not None, r.declared_sources) for r in readers.with_snapshot_text(records, saved, "id").collect()}
    assert rows == {1: (True, 12), 2: (False, None)}


def test_bodies_are_stored_once(spark, tmp_path):
    df = spark.createDataFrame([("u1", bytearray(b"x")), ("u2", bytearray(b"x")), ("u3", bytearray(b"y"))], "url string, body binary")
    for _ in range(2):
        writers.store_bodies(df, str(tmp_path / "bodies"), str(tmp_path / "attempts"))
    assert spark.read.parquet(str(tmp_path / "bodies")).count() == 2
    assert spark.read.parquet(str(tmp_path / "attempts")).count() == 6


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("f1", "r1", "http://b", "http://b/"), ("f2", "r1", "http://a", "http://a/"), ("f3", "r2", "http://a", "")], "source_reference_id string, record_id string, raw_url string, normalized_url string")
    writers.export_references(df, str(tmp_path))
    assert spark.read.json(str(tmp_path / "references_jsonl")).count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "references_csv")).columns == writers.REFERENCE_COLUMNS and len(writers.REFERENCE_COLUMNS) == 19
    assert [r.value for r in spark.read.text(str(tmp_path / "raw_urls")).collect()] == ["http://a", "http://b"]
    assert writers.markdown_table(df.select("record_id").distinct().orderBy("record_id")) == "| record_id |\n|---|\n| r1 |\n| r2 |\n"
    with pytest.raises(ValueError):
        writers.markdown_table(df, 2)
    writers.append_audit(df, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).count() == 3


def test_releases_are_validated_published_and_rolled_back(spark, tmp_path):
    release = writers.Release(tmp_path)
    tables = {"records": spark.createDataFrame([(1,)], "id int")}
    folder = release.build(spark, "r1", tables, lambda t: [])
    assert writers.verify_manifest(spark, str(folder)).count() == 0 or {r.path for r in writers.verify_manifest(spark, str(folder)).collect()} <= {".immutable"}
    assert release.publish("r1", lambda f: True) and release.current == folder
    with pytest.raises(ValueError):
        release.build(spark, "bad", tables, lambda t: ["count"])
    with pytest.raises(ValueError):
        release.publish("bad", lambda f: True)
    release.build(spark, "r2", tables, lambda t: [])
    assert not release.publish("r2", lambda f: False) and release.current == folder
    with pytest.raises(FileExistsError):
        release.build(spark, "r1", tables, lambda t: [])
    report = folder / "reports" / "validation.json"
    report.chmod(0o644)
    report.write_text("{}")
    assert ("reports/validation.json", "changed") in {tuple(r) for r in writers.verify_manifest(spark, str(folder)).collect()}


def test_key_value_table(spark, tmp_path):
    table = writers.KeyValueTable(spark, str(tmp_path), "cache_key string, entry string, updated_at int")
    assert table.count() == 0
    table.upsert(spark.createDataFrame([("a", "1", 1), ("b", "1", 1), ("a", "2", 2)], table.schema))
    table.upsert(spark.createDataFrame([("a", "old", 1), ("c", "3", 3)], table.schema))
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", "2", 2), ("b", "1", 1), ("c", "3", 3)]


def stamp(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def stream(spark, folder, rows, schema, transform, mode):
    """Runs a stream over two files, in order, and gives what it wrote."""
    half = len(rows) // 2
    for part in (rows[:half], rows[half:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = live.event_stream(spark, f"{folder}/in", spark.createDataFrame([], schema), 1)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", live.ROCKSDB)
    name = f"out_{abs(hash(str(folder))) % 10**9}"
    query = transform(source).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [tuple(r) for r in spark.table(name).collect()]


def test_streamed_counts_and_sessions(spark, tmp_path):
    rows = [("h", "ok", stamp(0)), ("h", "ok", stamp(5)), ("h", "bad", stamp(40)), ("g", "ok", stamp(100))]
    schema = "host string, kind string, ts timestamp"
    got = stream(spark, tmp_path / "a", rows, schema, lambda s: live.result_counts(s, "host", "kind"), "complete")
    assert sorted(got) == [("g", "ok", 1), ("h", "bad", 1), ("h", "ok", 2)]
    got = stream(spark, tmp_path / "b", rows, schema, lambda s: live.windowed_counts(live.with_watermark(s, "ts", "1 minute"), "ts", "30 seconds"), "complete")
    assert sorted(r[2] for r in got) == [1, 1, 2]
    df = spark.createDataFrame(rows, schema)
    assert sorted((r.host, r.n) for r in live.sessions(df, "ts", "host", "20 seconds").collect()) == [("g", 1), ("h", 1), ("h", 2)]
    assert sorted((r.host, r.n) for r in live.running_totals(df.withColumn("v", F.lit(2)), "host", "v").collect()) == [("g", 1), ("h", 3)]


def replayed(spark, rows, schema, transform, **options):
    """What a stream gives over rows in two runs, the second of them broken off and done again."""
    out = replay(spark.createDataFrame(rows, schema), "ts", lambda read: transform(read()), **options)
    return [tuple(r) for r in out.drop("batch").collect()]


def test_change_feed_beats_while_it_is_quiet_and_ends(spark):
    rows = [("j", stamp(t), s, t) for t, s in [(0, "queued"), (1, "queued"), (30, "running"), (54, "completed"), (60, "running")]] + [("q", stamp(5), "queued", 5)]
    end = spark.createDataFrame([("end", stamp(80), "x", 80)], "id string, ts timestamp, status string, seq int")
    got = replayed(spark, rows, end.schema, live.change_feed, closing=end)
    at = lambda key: sorted((round((r[1] - stamp(0)).total_seconds()), r[2], r[3]) for r in got if r[0] == key)
    assert at("j") == [(0, "change", "queued"), (12, "heartbeat", "queued"), (24, "heartbeat", "queued"), (30, "change", "running"), (42, "heartbeat", "running"), (54, "change", "completed")]
    assert at("q") == [(5, "change", "queued")] + [(t, "heartbeat", "queued") for t in (17, 29, 41, 53, 65, 77)]


def test_flushes_by_size_and_by_interval(spark):
    rows = [("j", f"i{k % 4}", f"s{k}", stamp(k), k) for k in range(5)] + [("j", "z", "z1", stamp(100), 100), ("j", "z", "z2", stamp(105), 105), ("k", "a", "b", stamp(7), 7)]
    schema = "id string, item string, status string, ts timestamp, seq int"
    end = spark.createDataFrame([("end", "x", "x", stamp(300), 300)], schema)
    got = sorted(replayed(spark, rows, schema, lambda s: live.coalesced(s, 4, 20_000), closing=end))
    brief = [(r[0], r[1], round((r[2] - stamp(0)).total_seconds()), r[3], r[4], r[5]) for r in got]
    assert brief == [
        *[("j", 0, 3, "size", f"i{k}", f"s{k}") for k in range(4)],
        ("j", 1, 24, "interval", "i0", "s4"),
        ("j", 2, 120, "interval", "z", "z2"),
        ("k", 0, 27, "interval", "a", "b"),
    ]


def test_circuit_opens_probes_and_closes(spark):
    rows = [("h", stamp(t), f) for t, f in [(0, True), (1, True), (2, True), (3, True), (70, True), (80, True), (140, False), (141, True)]]
    got = replayed(spark, rows, "host string, ts timestamp, failed boolean", lambda s: live.circuits(s, 3, 60.0))
    assert [(r[3], r[4]) for r in sorted(got, key=lambda r: r[1])] == [("allow", "closed"), ("allow", "closed"), ("allow", "open"), ("skip", "open"), ("probe", "open"), ("skip", "open"), ("probe", "closed"), ("allow", "closed")]


def test_misses_are_remembered_and_expire(spark):
    rows = [("h", stamp(t), f, "gone", t) for t, f in [(0, True), (10, True), (20, False), (30, True), (50, True), (95, True), (96, True)]]
    got = replayed(spark, rows, "host string, ts timestamp, failed boolean, reason string, seq int", lambda s: live.negative_cache(s, 60_000))
    assert [r[3] for r in sorted(got, key=lambda r: r[1])] == [False, True, True, False, True, False, True]


def test_a_broken_batch_is_done_again_once(spark):
    rows = [("h", k, stamp(k)) for k in range(40)]
    seen = []

    def sink(batch, number):
        seen.append((number, batch.count()))

    log = spark.createDataFrame(rows, "host string, kind int, ts timestamp").repartition(4)
    assert replay(log, "ts", lambda read: read(), runs=2, files_per_batch=1, breaks_in=1, sink=sink) is None
    numbers = [n for n, _ in seen]
    assert len(numbers) == len(set(numbers)) + 1 and sum(dict(seen).values()) == 40
    empty = replay(log.limit(0), "ts", lambda read: live.result_counts(read(), "host", "kind"), "update", ["host", "kind"])
    assert empty.count() == 0


KEYED = "cache_key string, entry string, updated_at int"


def keyed(spark, tmp_path, **options):
    return KeyValueTable(spark, f"file://{tmp_path}/t", KEYED, buckets=4, **options)


def entries(spark, *rows):
    return spark.createDataFrame(list(rows), KEYED)


def test_upserts_can_be_redone(spark, tmp_path):
    table = keyed(spark, tmp_path)
    write = live.upsert_sink(table, "feed")
    write(entries(spark, ("a", "1", 1), ("a", "2", 2)), 0)
    before = table._entry()
    write(entries(spark, ("a", "1", 1), ("a", "2", 2)), 0)
    assert table._entry() == before and [tuple(r) for r in table.read().collect()] == [("a", "2", 2)]


def test_an_upsert_that_breaks_off_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path)
    table.upsert(entries(spark, ("a", "1", 1), ("b", "1", 1)))
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", lambda entry: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.upsert(entries(spark, ("a", "lost", 9), ("c", "lost", 9)))
    assert sorted(r.entry for r in table.read().collect()) == ["1", "1"]
    table.upsert(entries(spark, ("c", "2", 2)))
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", "1", 1), ("b", "1", 1), ("c", "2", 2)]


def test_of_two_writers_one_wins(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(entries(spark, ("a", "1", 1)))
    stale = table._entry()
    table.upsert(entries(spark, ("a", "2", 2)))
    with pytest.raises(FileExistsError):
        table._commit(stale | {"version": stale["version"] + 1})
    assert table.read().first().entry == "2"


def test_only_full_buckets_are_compacted_and_bytes_follow_the_batch(spark, tmp_path):
    table = keyed(spark, tmp_path, most_deltas=2)
    table.upsert(spark.range(20_000).selectExpr("concat('k', id) cache_key", "sha2(cast(id as string), 256) entry", "0 updated_at"))
    size = lambda name: sum(p.stat().st_size for p in (tmp_path / "t/data" / name).rglob("*.parquet"))
    first = table._entry()["parts"][0]
    for n in (1, 2, 3):
        table.upsert(entries(spark, ("k7", f"v{n}", n)))
    entry = table._entry()
    deltas = [p for p in (tmp_path / "t/data").iterdir() if p.name.endswith("delta") and p.name != first["name"]]
    assert len(deltas) == 3 and all(size(p.name) * 100 < size(first["name"]) for p in deltas)
    assert entry["parts"][0]["name"].endswith("merged") and len(entry["parts"][0]["buckets"]) == 1
    assert set(entry["parts"][1]["buckets"]) == set(range(4)) - set(entry["parts"][0]["buckets"])
    assert table.count() == 20_000 and table.get("k7").first().entry == "v3" and table.get("nothing").count() == 0
    assert "EqualTo(cache_key,k7)" in table.get("k7")._jdf.queryExecution().toString()  # reaches the files
    gone = table.vacuum(1)
    assert gone and table.count() == 20_000


def test_upserts_in_any_order(spark, tmp_path):
    rows = [(f"k{k % 7}", str(k), k % 11) for k in range(60)] + [(None, "n", 1), (None, "m", 2)]
    table = keyed(spark, tmp_path, most_deltas=1)
    for at in range(0, len(rows), 13):
        table.upsert(entries(spark, *rows[at : at + 13]))
    table.upsert(spark.createDataFrame([], KEYED))
    best = {}
    for k, e, u in rows:
        best[k] = max(best.get(k, (-1, "")), (u, e))
    assert sorted((tuple(r) for r in table.read().collect()), key=str) == sorted(((k, e, u) for k, (u, e) in best.items()), key=str)


def test_small_files_are_written_once(spark, tmp_path):
    path = f"file://{tmp_path}/x/a.txt"
    files.write_once(spark, path, "one ü")
    assert files.read_text(spark, path) == "one ü" and files.exists(spark, path)
    with pytest.raises(FileExistsError):
        files.write_once(spark, path, "two")
    files.write_once(spark, path, "three", replace=True)
    assert files.read_text(spark, path) == "three" and "a.txt" in files.names(spark, f"file://{tmp_path}/x")
    assert files.names(spark, f"file://{tmp_path}/none") == []


def test_recovery_queue(spark):
    now = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    queue = live.RecoveryQueue(spark, "1-10")
    rows = spark.createDataFrame([("s1", "http://a/1", "a", "timeout"), ("s2", "http://a/2", "a", "timeout"), ("s3", "http://b/1", "b", "x")], "source_id string, original_url string, host string, reason string")
    queue.defer(rows, "1-10", now)
    queue.defer(rows.limit(1), "1-10", now)
    assert queue.pending.count() == 3
    with pytest.raises(ValueError):
        queue.defer(rows, "11-20", now)
    queue.note(spark.createDataFrame([("s1", "timed_out")], "source_id string, status string"), now)
    assert [r.source_id for r in queue.select(3).collect()] == ["s2", "s3", "s1"]
    assert [tuple(r) for r in queue.summary().collect()] == [("a", 2), ("b", 1)]
    queue.resolve(spark.createDataFrame([("s1",)], "source_id string"))
    assert queue.pending.count() == 2 and queue.resolved.first().recovery_attempts == 1


def test_runs_move_as_allowed_and_resume(spark):
    assert live.move("QUEUED", "RUNNING") == "RUNNING"
    with pytest.raises(ValueError):
        live.move("PUBLISHED", "RUNNING")
    targets = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    done = spark.createDataFrame([(1, "PARSED"), (2, "DEAD")], "id int, status string")
    assert [r.id for r in live.remaining(targets, done, "id").collect()] == [3]
    assert sorted(r.id for r in live.remaining(targets, done, "id", retry=True).collect()) == [2, 3]


def test_database_tables_are_read_in_ranges(spark):
    url = "jdbc:derby:memory:sedimenta;create=true"
    rows = [(i, f"n{i}") for i in range(100)]
    readers.write_database_table(spark.createDataFrame(rows, "ID int, NAME string"), url, "ITEMS", "overwrite", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    found = readers.database_table(spark, url, "ITEMS", "ID", 4, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert found.rdd.getNumPartitions() == 4 and sorted(tuple(r) for r in found.collect()) == rows
    assert readers.database_table(spark, url, "ITEMS", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}).count() == 100


def test_streams_join_within_a_time(spark, tmp_path):
    """Requests and answers of a key, the answer within ten seconds."""
    for name, rows in (("a", [("k", stamp(0), "q1"), ("k", stamp(100), "q2"), ("z", stamp(0), "q3")]), ("b", [("k", stamp(5), "r1"), ("k", stamp(130), "r2"), ("z", stamp(0), "r3")])):
        spark.createDataFrame(rows, f"key string, ts timestamp, {name} string").coalesce(1).write.parquet(str(tmp_path / name))
    sources = [live.event_stream(spark, str(tmp_path / n), spark.createDataFrame([], f"key string, ts timestamp, {n} string")) for n in "ab"]
    query = live.joined_streams(*sources, "key", "ts", "10 seconds", "1 minute").writeStream.format("memory").queryName("joined_out").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(240), "the stream hasn't ended"
    finally:
        query.stop()
    assert sorted((r.key, r.a, r.b) for r in spark.table("joined_out").collect()) == [("k", "q1", "r1"), ("z", "q3", "r3")]
