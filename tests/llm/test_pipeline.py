import hashlib
from collections import Counter

import pyarrow as pa

import corpus_pipeline
from sedimenta.llm import mixing, quality, simhash
from tests_llm_plain import keep_exact, keep_near


def test_stages_match_plain_versions(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [r.asDict() for r in docs.collect()]
    scores = quality.fit(docs, labels).score(pa.array([r["text"] for r in rows], pa.string()))
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= quality.ACCEPT]
    rows = keep_near(keep_exact(rows))
    left = spark.createDataFrame([tuple(r.values()) for r in rows], docs.schema)
    copies = {r.doc_id: r.copies for r in mixing.Mix().copies(left).collect()}
    want = Counter({d: c for d, c in copies.items() if c})
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = out.collect()
    assert Counter(r.doc_id for r in got) == want
    text = {r["doc_id"]: r["text"] for r in rows}
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "tokens"]
    assert simhash.NEAR_RADIUS == 6


def test_stages_take_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            if name != "tokens":
                assert out.columns == docs.columns, name
            assert out.count() <= 2 * docs.count()
