"""The corpus operators in a session that names no shared folder."""

import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from sedimenta.llm import exact_dedup, mixing, simhash
docs = spark.createDataFrame([(1, "a b c", "x"), (2, "a  b c", "x"), (3, "d e", "y")], "doc_id bigint, text string, source string")
assert sorted(r.keep_id for r in exact_dedup.exact_groups(docs).collect()) == [2, 2, 3]
assert simhash.near_duplicates(docs).count() == 3 and mixing.Mix().taken(docs).count() == 3
print("fine")
"""


def test_a_default_session_is_enough(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root + os.pathsep + os.environ.get("PYTHONPATH", "")}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]
