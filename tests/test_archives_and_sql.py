"""The ZIP data source, table functions and aggregates by name, and main runs of blocks."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import tables
from sedimenta.operators import extract
from sedimenta.sources import archives


def members(spark, path, **options):
    archives.register(spark)
    return spark.read.format("zip_members").options(**{"path": str(path), **options}).load()


def zipped(path, files):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in files:
            z.writestr(name, content)


def test_an_archive_is_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    files = [(f"d/{i}.json", rng.randbytes(3000)) for i in range(40)] + [("d/readme.md", b"x"), ("d/empty.json", b""), ("d/ü.json", b"{}")]
    zipped(tmp_path / "a.zip", [("d/", b""), *files])
    rows = members(spark, tmp_path, spanBytes=10_000, pattern=r"\.json$")
    assert rows.rdd.getNumPartitions() >= 12
    found = {r.member: bytes(r.content) for r in rows.collect()}
    assert found == {n: c for n, c in files if n.endswith(".json")} and {r.archive for r in rows.collect()} == {"a.zip"}
    assert members(spark, f"file:{tmp_path}/a.zip").count() == 43


def test_no_archives_and_broken_ones(spark, tmp_path):
    assert members(spark, tmp_path / "none").count() == 0
    zipped(tmp_path / "empty.zip", [])
    (tmp_path / "_hidden.zip").write_bytes(b"")
    assert members(spark, tmp_path).count() == 0
    (tmp_path / "z.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="zip"):
        members(spark, tmp_path).count()


def test_written_archives_are_read_back(spark, tmp_path):
    rows = [(f"m{i}", f"content {i} ü") for i in range(500)] + [("null", None)]
    df = spark.createDataFrame(rows, "name string, text string").repartition(3)
    done = archives.write_archives(df, "name", "text", f"file://{tmp_path}/z", most_bytes=5_000).collect()
    assert sum(r.members for r in done) == 501 and len(done) > 3
    assert {p.name for p in (tmp_path / "z").iterdir()} == {r.archive for r in done}
    assert {r.member: bytes(r.content).decode() for r in members(spark, f"file://{tmp_path}/z").collect()} == {n: t or "" for n, t in rows}
    assert archives.write_archives(df.limit(0), "name", "text", f"file://{tmp_path}/y").count() == 0


def test_new_archives_are_a_stream(spark, tmp_path):
    archives.register(spark)
    got = []
    for lot in ("a", "b", "c"):
        if lot != "b":
            zipped(tmp_path / f"{lot}.zip", [(f"{lot}{i}", b"x") for i in range(3)])
        query = spark.readStream.format("zip_members").option("path", str(tmp_path)).load().select("member").writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        got.append(sorted(r.member for r in spark.read.schema("member string").parquet(f"file://{tmp_path}/out").collect()))
    assert got == [["a0", "a1", "a2"], ["a0", "a1", "a2"], ["a0", "a1", "a2", "c0", "c1", "c2"]]


def test_table_functions(spark):
    tables.register(spark)
    docs = spark.createDataFrame([(1, '{"a": [1, {"k": "v"}], "k": null}'), (2, "bad"), (3, None), (4, '"s"')], "id int, doc string")
    rows = spark.sql("SELECT id, path, value FROM {docs}, LATERAL json_leaves(doc) ORDER BY id, path", docs=docs).collect()
    assert [tuple(r) for r in rows] == [(1, "$.a[0]", "1"), (1, "$.a[1].k", "v"), (4, "$", "s")]
    rows = spark.sql("SELECT id, value FROM {docs}, LATERAL json_under(doc, 'k')", docs=docs).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "v")]
    pages = spark.createDataFrame([(1, "<h1>T</h1><p>one <a href=x>two</a><li>"), (2, None)], "id int, html string")
    assert [tuple(r) for r in spark.sql("SELECT * FROM {pages}, LATERAL page_blocks(html)", pages=pages).drop("html").collect()] == [(1, 1, "h1", "T", 0), (1, 2, "p", "one two", 3)]
    record = spark.createDataFrame([("<article><section><h2>Sources (1)</h2><ul><li><a href='http://a/1'>A</a></li></ul></section></article>",)], "html string")
    assert [tuple(r) for r in spark.sql("SELECT position, url, label FROM {r}, LATERAL page_sources(html)", r=record).collect()] == [(1, "http://a/1", "A")]
    texts = spark.createDataFrame([(1, "aa\n\nbbbbb"), (2, ""), (3, None)], "id int, t string")
    assert [tuple(r) for r in spark.sql("SELECT id, position, text FROM {t}, LATERAL paragraphs(t, 3)", t=texts.withColumnRenamed("t", "t")).collect()] == [(1, 1, "aa"), (1, 2, "bbb"), (1, 3, "bb")]


def test_aggregates(spark):
    tables.register(spark)
    df = spark.createDataFrame([("a", 1, 3.0, True), ("a", 2, 1.0, True), ("a", 3, None, False), ("a", 4, 2.0, True), ("b", 1, None, None)], "g string, at int, v double, f boolean")
    rows = spark.sql("SELECT g, nearest_rank(v, 0.5D) AS m, longest_run(f, at) AS run FROM {df} GROUP BY g ORDER BY g", df=df).collect()
    assert [tuple(r) for r in rows] == [("a", 2.0, 2), ("b", None, 0)]


def test_main_run_has_the_greatest_sum():
    rng = random.Random(7)
    for _ in range(400):
        blocks = [extract.Block(rng.choice(["p", "h2", "li"]), " ".join(["w"] * rng.randrange(1, 30)), 0, rng.randrange(3), rng.random() < 0.2) for _ in range(rng.randrange(9))]
        weights = [extract.block_weight(b) for b in blocks]
        runs = [(sum(weights[i:j]), j - i, i, j) for i in range(len(blocks)) for j in range(i + 1, len(blocks) + 1)]
        first, last = extract.main_run(blocks)
        best = max((s for s, *_ in runs), default=0)
        if best <= 0:
            assert (first, last) == (0, 0)
        else:
            assert sum(weights[first:last]) == best
            assert last - first == max(n for s, n, _, j in runs if s == best and j == last)


def test_main_text_of_a_page_that_marks_none(spark):
    links = "".join(f"<li><a href=/{i}>Section number {i}</a></li>" for i in range(9))
    body = "".join(f"<p>{'Some words of the story, which go on for a while, as stories do. ' * 3}</p>" for _ in range(4))
    html = f"<body><div><ul>{links}</ul></div><div><h1>Title</h1>{body}<p>Short.</p>{body}</div><div>Share this</div></body>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")
    rows = {r.id: r for r in extract.main_texts(pages, "id").collect()}
    assert rows[1].text.startswith("Title\nSome words") and "\nShort.\n" in rows[1].text and "Section" not in rows[1].text and "Share" not in rows[1].text
    assert (rows[2].text, rows[3].last) == ("", 0)
    assert extract.extract(html.encode(), "text/html", "html")["method"] == "main_run"
