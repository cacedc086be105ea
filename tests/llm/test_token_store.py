import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sedimenta.llm import token_store
from sedimenta.llm.token_store import TokenStore

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_library(tokenizer, documents):
    rng = random.Random(1)
    alphabet = list("aabA's  \n\t\x1c\x85\xa0éÉİſK中!?.,12'llüßͅΣς\x01|")
    texts = [r.text for r in documents.collect()] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for text, ids in zip(texts, token_store.encoder(PATH).encode_batch(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_store_matches_brute_force(tokenizer, documents, edge_docs):
    for docs in (documents, edge_docs):
        store = TokenStore.write(docs, PATH)
        rows = docs.select("doc_id", "text").collect()
        rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        got = [tuple(r) for r in store.verified().collect()]
        got.sort(key=lambda r: r[1])
        assert [g[0] for g in got] == [r.doc_id for r in rows]
        assert [g[1] for g in got] == np.cumsum([0] + [g[2] for g in got])[:-1].tolist()
        want = sorted((str(r.doc_id), len(i := tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]), crc32(np.array(i, "<u4").tobytes())) for r in rows)
        assert sorted((str(g[0]), g[2], g[3]) for g in got) == want
        rebuilt = sorted((str(r.doc_id), list(r.ids)) for r in store.ids().collect())
        assert rebuilt == sorted((str(r.doc_id), tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in rows)
        assert store.chunks.count() == store.chunks.select("digest").distinct().count()


def test_empty_table(no_docs):
    assert TokenStore.write(no_docs, PATH).verified().count() == 0


def test_chunks_follow_content_not_position():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 40000, 5000).astype(np.uint16)
    a = np.concatenate([rng.integers(0, 40000, 300).astype(np.uint16), shared])
    b = np.concatenate([rng.integers(0, 40000, 777).astype(np.uint16), shared])
    pieces = lambda x: {x[i:j].tobytes() for i, j in zip([0, *token_store.cuts(x)], token_store.cuts(x), strict=False)}
    assert len(pieces(a) & pieces(b)) >= 8
    for x in (a, b, shared[:1], np.zeros(10000, np.uint16)):
        ends = token_store.cuts(x)
        assert ends[-1] == len(x) and all(0 < j - i <= token_store.MAX_IDS for i, j in zip([0, *ends], ends, strict=False))


def test_crc_of_parts():
    rng = random.Random(3)
    texts = [[rng.randbytes(rng.randint(1, 900)) for _ in range(rng.randint(1, 9))] for _ in range(40)]
    parts = [p for t in texts for p in t]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    got = token_store.CrcJoin().joined(np.array([crc32(p) for p in parts], dtype=np.int64), np.array([len(p) for p in parts]), offsets)
    assert got.tolist() == [crc32(b"".join(t)) for t in texts]


def test_a_damaged_chunk_is_found(documents, spark):
    store = TokenStore.write(documents.limit(20), PATH)
    bad = store.chunks.selectExpr("digest", "width", "concat(ids, x'0000') as ids")
    rows = bad.collect()
    spark.createDataFrame(rows, bad.schema).write.mode("overwrite").parquet(f"{store.folder}/chunks")
    with pytest.raises(Exception, match="damaged"):
        store.verified().collect()
