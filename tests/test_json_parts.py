"""A table written in parts and put together as one file."""

from sedimenta.sources import readers, writers


def test_parts_grow_in_number_with_the_table(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id as doc_id", "repeat('x', 50) as text").repartition(30)
    writers.json_parts(rows, f"{tmp_path}/parts")
    readers.assemble_parts(spark, f"{tmp_path}/parts", f"{tmp_path}/whole.json")
    assert len(list((tmp_path / "parts").glob("part-*"))) == 30
    assert spark.read.schema(rows.schema).json(f"{tmp_path}/whole.json").distinct().count() == 3000
