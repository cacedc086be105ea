import random

import numpy as np

from sedimenta.llm import mixing


def plain_targets(sizes, share=1.5, cap=2.0):
    """Shares by weight, cut at the cap, what is cut shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        out = {s: cap * sizes[s] if s in full else rest * weight[s] / free for s in order}
        more = {s for s in order if out[s] > cap * sizes[s]}
        if not more:
            return out
        full |= more


def test_targets(spark):
    rng = random.Random(3)
    cases = [{"b": 100, "a": 100, None: 100}, {"a": 10, "b": 1000}, {"a": 0, "b": 10}, {"é": 7, "z": 3, "Z": 9, "": 1}, {"a": 0}]
    cases += [{f"s{k}": int(10 ** rng.uniform(0, 6)) for k in range(n)} for n in (1, 2, 30, 400)]
    assert plain_targets(cases[0]) == {"a": 200.0, "b": 250 / 3, None: 500 / 3}
    assert plain_targets(cases[1]) == {"a": 20.0, "b": 1495.0}
    for sizes in cases:
        sized = spark.createDataFrame([(s, n - n // 2) for s, n in sizes.items()] + [(s, n // 2) for s, n in sizes.items()], "source string, size bigint")
        got = {r._source: r for r in mixing.Mix().source_targets(sized).collect()}
        want = plain_targets(sizes)
        assert {s: r.source_size for s, r in got.items()} == sizes
        assert all(abs(got[s].target - want[s]) <= 1e-9 * (1 + want[s]) for s in want), sizes
    assert mixing.Mix().source_targets(spark.createDataFrame([], "source string, size bigint")).count() == 0


def plain_pivotal(sizes, fractions, draw):
    """Two fractions after another exchange words until one of them is 0 or 1."""
    sizes, p = list(sizes), list(fractions)
    open_ = [i for i in range(len(p)) if 0 < p[i] < 1]
    while len(open_) > 1:
        i, j = open_[:2]
        gain_i = min((1 - p[i]) * sizes[i], p[j] * sizes[j])
        gain_j = min((1 - p[j]) * sizes[j], p[i] * sizes[i])
        moved = gain_i if draw() < gain_j / (gain_i + gain_j) else -gain_j
        p[i], p[j] = p[i] + moved / sizes[i], p[j] - moved / sizes[j]
        p = [round(v) if abs(v - round(v)) < 1e-9 else v for v in p]
        open_ = [k for k in open_ if 0 < p[k] < 1]
    return p


def test_pivotal_has_the_plain_one_s_chances():
    """How often each of a few documents is taken together with another, over many draws."""
    size, p = np.array([3, 10, 4, 7, 5]), np.array([0.2, 0.5, 0.9, 0.4, 0.7])
    rng, n = np.random.default_rng(5), 20000
    mine, plain = np.zeros((5, 5)), np.zeros((5, 5))
    for _ in range(n):
        own = np.rint(mixing.pivotal(size, p, rng.random(5))[0])
        other = np.rint(plain_pivotal(size, p, rng.random))
        mine += np.outer(own, own)
        plain += np.outer(other, other)
    assert np.abs(mine - plain).max() / n < 0.02


def test_pivotal_keeps_the_sum_and_is_unbiased():
    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 500, 60), rng.random(60)
    total = np.zeros(60)
    for _ in range(4000):
        out, left = mixing.pivotal(size, p, rng.random(60))
        assert abs((out * size).sum() - (p * size).sum()) < 1e-6
        assert all(v in (0, 1) for i, v in enumerate(out) if i != left)
        total += out
    assert np.abs(total / 4000 - p).max() < 0.04


def test_words_come_near_targets_and_reruns_agree(documents):
    for group_rows in (4096, 4):
        mix = mixing.Mix(group_rows=group_rows)
        rows = mix.taken(documents).toPandas().sort_values("doc_id").reset_index(drop=True)
        assert rows.equals(mix.taken(documents.repartition(7)).toPandas().sort_values("doc_id").reset_index(drop=True))
        texts = documents.toPandas().set_index("doc_id")
        assert (rows["size"] == [mixing.words(texts.text[i]) for i in rows.doc_id]).all()
        assert (rows.taken <= 2 * rows["size"]).all() and (rows.taken % rows["size"].clip(lower=1) == 0).all()
        rows["source"] = [texts.source[i] for i in rows.doc_id]
        want = plain_targets(rows.groupby("source")["size"].sum().to_dict())
        for source, own in rows.groupby("source"):
            assert own.source_size.eq(own["size"].sum()).all() and np.allclose(own.target, want[source])
            assert abs(own.taken.sum() - want[source]) <= own["size"].max()


def test_mixed_rows_are_the_copies(documents, edge_docs):
    for docs in (documents, edge_docs):
        copies = mixing.Mix().copies(docs)
        mixed = mixing.Mix().mixed(docs)
        assert mixed.columns == docs.columns
        want = {r.doc_id: r.c for r in copies.groupBy("doc_id").agg({"copies": "sum"}).withColumnRenamed("sum(copies)", "c").collect() if r.c}
        got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
        assert got == want


def test_edges(edge_docs, no_docs):
    rows = mixing.Mix().taken(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.Mix().taken(no_docs).count() == 0
    assert mixing.Mix().mixed(no_docs).count() == 0


def test_many_identical_rows_are_dealt_apart(spark):
    rows = [(None, "", None)] * 500 + [(1, "a b c", "x")] * 700 + [(i, "w " * i, "y") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mix = mixing.Mix(group_rows=16)
    sized = mix.apart(mix.sized(docs))
    assert sized.count() == len(rows) == sized.select("ord").distinct().count()
    got = mix.taken(docs).groupBy("doc_id", "taken").count().collect()
    assert sorted(got, key=str) == sorted(mix.taken(docs.repartition(5)).groupBy("doc_id", "taken").count().collect(), key=str)
    taken = sum(r.taken * r["count"] for r in got if r.doc_id == 1)
    want = plain_targets({"x": 2100, "y": sum(range(2, 40)), None: 0})["x"]
    assert abs(taken - want) <= 3
    assert mix.mixed(docs).where("doc_id = 1").count() * 3 == taken


def test_small_and_large_rows_are_taken_at_their_rate(spark):
    """Groups of four make four levels: a residual's coins must not depend on one another."""
    from pyspark.sql import functions as F

    docs = spark.range(2000 * 64).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 2000).alias("source"), F.when(F.floor(F.col("id") / 2000) % 2 == 0, F.repeat(F.lit("w "), F.lit(50))).otherwise("w").alias("text"))
    mix = mixing.Mix()
    mix.group_rows = 4
    found = mix.copies(docs).where("source_size > 0").withColumn("due", F.col("target") / F.col("source_size"))
    rows = found.where("due % 1 > 0.01").groupBy("size").agg(F.avg(F.col("copies") - F.col("due")).alias("bias"), F.count(F.lit(1)).alias("n")).collect()
    assert len(rows) == 2 and all(r.n > 30_000 and abs(r.bias) < 0.006 for r in rows), rows
