import os

from sedimenta.sources import writers


def test_a_file_for_each_row_by_all_cores(spark, tmp_path):
    writers.file_for_each(spark.range(0, 40, 1, 1), f"{tmp_path}/out")
    names = [n for n in os.listdir(f"{tmp_path}/out") if n.endswith(".json")]
    assert len(names) == 40 and len({n.split("-")[1] for n in names}) > 1
    assert sorted(r.id for r in spark.read.json(f"{tmp_path}/out").collect()) == list(range(40))
