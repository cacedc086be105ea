import zlib

import numpy as np
import pyarrow as pa

from sedimenta.llm import quality


def test_held_out_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.scored(docs, quality.fit(docs, labels)).toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    assert (out.predicted == (out.score >= 0.7)).all()
    known = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    assert (known.predicted == known.quality).mean() > 0.98
    assert (known[known.quality == 1].score >= 0.7).mean() > 0.99


def test_scores_equal_the_plain_model():
    rng = np.random.default_rng(3)
    model = quality.Model(rng.normal(size=quality.FEATURES))
    texts = ["a b b c", "", None, "x" * 500, "ab cd " * 3000, "É ß 中 中", "  lead and trail  ", "\n"]
    texts += [" ".join(f"w{rng.integers(0, 50)}" for _ in range(rng.integers(0, 90))) for _ in range(50)]
    got = model.score(pa.array(texts, pa.string()))
    for text, score in zip(texts, got, strict=True):
        ((at, x),) = quality.document_features(pa.array([text], pa.string()))
        assert abs(score - 1 / (1 + np.exp(-(model.evidence[at] * x).sum()))) < 1e-6


def test_features_are_those_of_each_word():
    words = ["ab", "x", "Straße", "a" * 300, "中"]
    owner, bucket = quality.features(words)
    for i, word in enumerate(words):
        alone = quality.features([word])[1]
        assert sorted(bucket[owner == i]) == sorted(alone)
        assert len(alone) == 1 + sum(max(0, len(word) + 2 - n + 1) for n in quality.GRAM_SIZES)


def test_held_out_labels_teach_nothing(spark):
    ids = [i for i in range(400)]
    docs = spark.createDataFrame([(i, "good fine words" if i % 2 else "!!! ### ***") for i in ids], "doc_id bigint, text string")
    flipped = spark.createDataFrame([(i, (1 - i % 2) if zlib.crc32(str(i).encode()) % 4 == 2 else i % 2) for i in ids], "doc_id bigint, quality int")
    out = {r.doc_id: r.predicted for r in quality.scored(docs, quality.fit(docs, flipped)).collect()}
    assert all(out[i] == i % 2 for i in ids)


def test_edges(edge_docs, no_docs, spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (8, 1), (9, None), (None, 1)], "doc_id bigint, quality int")
    out = quality.scored(edge_docs, quality.fit(edge_docs, labels))
    assert out.count() == edge_docs.count() and out.where("score is null").count() == 0
    nothing = quality.fit(edge_docs, labels.where("false"))
    assert {r.score for r in quality.scored(edge_docs, nothing).collect()} == {0.5}
    assert {r.score for r in quality.scored(edge_docs, quality.fit(edge_docs, labels.where("quality = 1"))).collect()} <= {0.5, 1.0}
    assert quality.scored(no_docs, nothing).count() == 0
    kept = quality.accepted(edge_docs, quality.Model(None, 1.0))
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def plain_features(text):
    """Share of each bucket: every word with its boundaries, its n-grams, the end, and repeats of the word before."""
    mask = (1 << 64) - 1

    def bucket(h, buckets):
        m = (h ^ (h >> 31)) * 0xD6E8FEB86659FD93 & mask
        return (m ^ (m >> 32)) % buckets

    words = (text or "").translate(str.maketrans("\t\n\v\f\r", " " * 5)).split(" ")
    words = [w for w in words if w]
    counts = {quality.END: 1}
    for k, word in enumerate(words):
        codes = [ord(c) for c in f"<{word}>"]
        found = [bucket(sum(c * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(codes)) & mask, 1 << 14)]
        for size in (2, 3, 4):
            for i in range(len(codes) - size + 1):
                h = size
                for c in codes[i : i + size]:
                    h = (h * 0x9E3779B97F4A7C15 + c) & mask
                found.append((1 << 14) + bucket(h, 1 << 15))
        for b in found:
            counts[b] = counts.get(b, 0) + 1
        if k and word == words[k - 1]:
            counts[quality.REPEAT] = counts.get(quality.REPEAT, 0) + 4
    total = sum(counts.values())
    return {b: n / total for b, n in counts.items()}


def test_scores_equal_a_plain_version(edge_docs, documents):
    model = quality.Model(np.random.default_rng(4).normal(size=quality.FEATURES))
    for docs in (edge_docs, documents):
        texts = [r.text for r in docs.collect()]
        got = model.score(pa.array(texts, pa.string()))
        for text, score in zip(texts, got, strict=True):
            z = sum(model.evidence[b] * x for b, x in plain_features(text).items())
            assert abs(score - 1 / (1 + np.exp(-z))) < 1e-9


def plain_training(rows, seed=7):
    """Gradient descent of the mean vector's softmax, vector by vector."""
    rng = np.random.default_rng(seed)
    share = sum(y for _, _, y in rows) / len(rows)
    d = quality.DIMENSION
    vectors = rng.uniform(-1 / d, 1 / d, (quality.FEATURES, d)).astype(np.float32)
    out = np.zeros((2, d))
    step = 0
    for _ in range(quality.EPOCHS):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            hidden = sum(w * vectors[b].astype(float) for b, w in zip(at, x, strict=True))
            e = np.exp(out @ hidden)
            error = e / e.sum() - np.eye(2)[y]
            rate = quality.RATE * (1 - step / (quality.EPOCHS * len(rows))) * 0.5 / (share if y else 1 - share)
            back = error @ out
            out = out - rate * np.outer(error, hidden)
            for b, w in zip(at, x, strict=True):
                vectors[b] -= (rate * w / max(x) * back).astype(np.float32)
            step += 1
    return vectors.astype(float) @ (out[1] - out[0])


def test_training_equals_a_plain_version():
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["good", "fine", "words", "here"] if k % 2 else ["###", "!!", "buy", "here"], 6)) for k in range(30)]
    rows = [(at.astype(np.int64), x, k % 2) for k, (at, x) in enumerate(quality.document_features(pa.array(texts)))]
    assert np.abs(quality.train(rows).evidence - plain_training(rows)).max() < 1e-3


def test_the_sample_has_a_bound(spark):
    docs = spark.createDataFrame([(1, "a b")] * 20000 + [(i, f"w {i}") for i in range(2, 60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id bigint, quality int")
    got = quality.training_sample(docs, labels, 5)
    assert len(got) <= 10 and {y for _, _, y in got} == {0, 1}
