"""Pages of records: both readers give one tree, and a table of one row group is dealt to all cores."""

import random

import duckdb
from pyspark.sql import functions as F

from sedimenta.operators import record_pages
from sedimenta.session import spread

PIECES = (
    "<div>", "</div>", "<p>", "</p>", "<h4>", "</h4>", "<h2>", "</h2>", "<ul>", "<li>", "</li>", "</ul>", "<br>", "<img src='/a.jpg' alt=\"b c\">", "<a href='/x'>", "</a>", "<a class=archive href='http://w/1'>",
    "<article>", "</article>", "<section>", "</section>", "<figure>", "<figcaption>", "</figcaption>", "</figure>", "Sources (1,2)", "text", " two\n lines ", "&amp; &eacute", "a b", " ", "</x>", "<span class='tag'>", "</span>",
    "<h4></h4>", "5 > 4", "\r\n", "\x0b",
)
ODD = ("<!-- c -->", "<script type='application/ld+json'>{\"a\": 1}</script>", "<title>t &lt; u</title>", "<BR/>", "<a href=/q?a&b=1>", "<p", "</", "<a href='&amp;'>")


def shape(elements):
    return [(e.tag, e.attrs, "".join(c for c in e.children if isinstance(c, str)), e.parent.at if e.parent else None, e.end or len(elements)) for e in elements]


def parsed(text):
    builder = record_pages._Builder()
    builder.feed(text)
    builder.close()
    return builder.tree.elements


def test_both_readers_give_one_tree():
    draw, plain = random.Random(5), 0
    for k in range(4000):
        text = "".join(draw.choices(PIECES + (ODD if k % 2 else ()), k=draw.randrange(1, 40)))
        want = parsed(text)
        assert shape(record_pages.elements_of(text)) == shape(want), text
        plain += record_pages._plain_tree(text) is not None
        for e in want:
            inside = [x for x in e.walk() if x is not e]
            assert want[e.at + 1 : e.end] == inside, text
    assert plain > 1500


def test_one_row_group_is_dealt(spark, tmp_path):
    duckdb.sql(f"COPY (SELECT i AS k, sha256(CAST(i AS VARCHAR)) AS t FROM range(20000) r(i)) TO '{tmp_path}/one.parquet' (FORMAT parquet, ROW_GROUP_SIZE 1000000)")
    settings = {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        table = spark.read.parquet(f"{tmp_path}/one.parquet")
        assert table.rdd.getNumPartitions() >= 8
        counts = [r["count"] for r in spread(table).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sum(counts) == 20000 and max(counts) * 8 <= 2 * 20000


def test_many_files_stay_as_they_are(spark, tmp_path):
    spark.range(1000).repartition(16).write.parquet(f"{tmp_path}/many")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        table = spark.read.parquet(f"{tmp_path}/many")
        assert spread(table) is table
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
