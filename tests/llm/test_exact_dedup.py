import hashlib
import re

import pytest

from pyspark.sql import functions as F

from sedimenta.llm import exact_dedup
from sedimenta.llm.exact_dedup import DigestIndex, drop_exact_duplicates, exact_groups


def brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)
        out += [(m[2] if not m[1] else None, keep[2] if not keep[1] else None, len(members), m == keep, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_groups_match_brute_force_even_when_digests_collide(edge_docs, documents, digest_bytes):
    for docs in (edge_docs, documents):
        want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        assert found(exact_groups(docs, digest_bytes)) == want


def test_one_row_of_each_group_survives_whole(edge_docs):
    kept = drop_exact_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    # blanks: 3 (longest); same text: 6 (longest); of the repeated rows none is longest
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 4, 6, None, 8, 9], key=str)


def test_of_identical_rows_one_survives(spark):
    docs = spark.createDataFrame([(1, "a b")] * 5 + [(None, "q")] * 3, "doc_id bigint, text string")
    assert sorted((r.doc_id, r.text) for r in drop_exact_duplicates(docs.where("doc_id = 1")).collect()) == [(1, "a b")]
    assert drop_exact_duplicates(docs).count() == 2


def test_empty_table(no_docs):
    assert exact_groups(no_docs).count() == 0
    assert drop_exact_duplicates(no_docs).count() == 0


def test_runs_are_sorted_and_compacted(documents):
    index = DigestIndex()
    runs = index.flush(documents)
    assert runs.count() == documents.count()
    level = index.compact(runs)
    assert level.agg({"_rows": "sum"}).first()[0] == documents.count()


def index_of(spark, *batches, **options):
    index = exact_dedup.StoredIndex(spark, **options)
    for batch in batches:
        index.insert(batch)
    return index


@pytest.mark.parametrize("digest_bytes, fan_in", [(32, 64), (32, 2), (1, 3)])
def test_two_batches_give_what_one_gives(spark, edge_docs, digest_bytes, fan_in):
    docs = edge_docs.select("doc_id", "text").withColumn("n", F.monotonically_increasing_id()).cache()
    batches = [docs.where(f"n % 3 = {k}").drop("n").repartition(2) for k in range(3)]
    index = index_of(spark, *batches, digest_bytes=digest_bytes, fan_in=fan_in)
    whole = docs.drop("n")
    want = sorted(map(str, exact_dedup.exact_groups(whole).collect()))
    assert sorted(map(str, index.groups(whole, whole).collect())) == want
    parts = [r for b in batches for r in map(str, index.groups(b.where("doc_id is null or doc_id <> 7"), whole).collect())]
    assert sorted(parts) == [w for w in want if "doc_id=7," not in w]


def test_a_lookup_reads_the_runs_that_filters_let_through(spark):
    docs = lambda low: spark.range(low, low + 2000).selectExpr("id doc_id", "concat('text ', id) text").repartition(4)
    index = index_of(spark, docs(0), docs(2000), fan_in=64)
    keyed = index.index._keyed(index.index._plain(docs(1000).unionByName(docs(9000)), [])).select("_digest").distinct()
    asked = index.candidates(keyed)
    assert 2000 <= asked.count() < 2600  # eight runs, and each of 4,000 digests passes its own run's filter and hardly any other
    assert index.lookup(keyed).count() == 2000
    assert exact_dedup.StoredIndex(spark).lookup(keyed).count() == 0


def test_levels_are_merged_when_they_are_full(spark):
    docs = lambda k: spark.range(40).selectExpr(f"id * 10 + {k} doc_id", "concat('t', id % 7) text").repartition(2)
    index = index_of(spark, *[docs(k) for k in range(5)], fan_in=4)
    assert sum(n for n, _, _ in index.runs.values()) == 4 and set(index.runs) == {0, 1}
    _, merged, _ = index.runs[1]
    assert merged.groupBy("_digest").count().where("count > 2").count() == 0
    assert index.lookup(merged.select("_digest").distinct()).agg(F.sum("_rows")).first()[0] == 200
    plan = merged.groupBy("_digest").agg(F.min("_least"))._jdf.queryExecution().toString()
    assert "SortAggregate" in plan
