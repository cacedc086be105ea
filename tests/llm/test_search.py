"""Ranked search against a plain version over all documents."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sedimenta.llm import postings, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    counts = [(d["doc_id"], Counter(terms(d["text"]))) for d in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in sorted({(r["item_id"], r["text"]) for r in items}, key=str):
        asked, found = Counter(terms(text)), []
        for doc_id, c in counts:
            m = 25 + 75 * sum(c.values()) * n_docs // n_words
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


ITEMS = [(1, "same text NOW"), (1, "same text NOW"), (2, None), (3, " \t"), (4, "w1 w2 w3 w3 w5 zzz"), (None, "中文 é x"), (5, "absent words only")]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(*i, "s") for i in ITEMS], "item_id bigint, text string, score string")


def test_words_are_the_pattern(spark):
    texts = ["", None, "A b\x00c", "Zürich-42_x", "ÀB ć", "a" * 70, "  trailing ", "é", "x y", "no", "more"]
    found, counts = postings.words(pa.array(texts, pa.string()))
    wanted = [terms(t) for t in texts]
    assert counts.tolist() == [len(w) for w in wanted]
    assert [t.decode() for t in found.to_pylist()] == [t for w in wanted for t in w]
    assert postings.words(pa.array(texts, pa.string())[3:6])[1].tolist() == [3, 2, 1]
    assert postings.words(pa.array([], pa.string()))[1].tolist() == []


def test_best_keeps_ties_by_id():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(0, 40))
        scores, ids = rng.integers(1, 5, n), rng.permutation(n)
        at = search.best(scores, ids, 10)
        assert [(-scores[i], ids[i]) for i in at] == sorted((-s, i) for s, i in zip(scores, ids, strict=True))[:10]


@pytest.mark.parametrize("shard_bytes, query_bytes", [(8_000_000, 4_000_000), (100, 8)])
def test_equals_plain_version(spark, edge_docs, items, monkeypatch, shard_bytes, query_bytes):
    monkeypatch.setattr(search, "SHARD_BYTES", shard_bytes)
    index = search.Index.build(edge_docs.repartition(3))
    index.query_bytes = query_bytes
    found = index.search(items, 3)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == plain(edge_docs.collect(), items.collect(), 3)


def test_given_documents(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert rows(search.Index.build(documents).search(items)) == plain(documents.collect(), items.collect(), 10)


def test_copies_tie_by_id(spark):
    docs = spark.createDataFrame([(i, "one two three" if i % 3 else "one other") for i in range(500)], "doc_id bigint, text string").repartition(5)
    found = search.Index.build(docs).search(spark.createDataFrame([(7, "two")], "item_id bigint, text string"))
    assert [r.doc_id for r in found.orderBy("rank").collect()] == [1, 2, 4, 5, 7, 8, 10, 11, 13, 14]


def test_empty_tables(spark, edge_docs, no_docs, items):
    assert search.Index.build(no_docs).search(items).count() == 0
    assert search.Index.build(edge_docs).search(items.limit(0)).count() == 0
