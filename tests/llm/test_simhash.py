import random

import numpy as np
import pytest
import xxhash

from sedimenta.llm import simhash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s, seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints(edge_docs, documents):
    for docs in (edge_docs, documents):
        texts = [r.text for r in docs.select("text").collect()]
        for t in texts:
            assert simhash.fingerprint(t) == plain_fingerprint(t)


def clustered(n, seed=5):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 40)):
            v = centre
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            out.add(v)
    # One hot value in the lower bits of a third of all.
    out |= {(rng.getrandbits(30) << 34) | 12345 for _ in range(n // 2)}
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_links_match_brute_force(spark, parts):
    fps = clustered(600)
    rows = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    links = simhash.PigeonholeSearch(rows, 2, parts).links().collect()
    got = {frozenset((r.a & (2**64 - 1), r.b & (2**64 - 1))) for r in links}
    want = {frozenset((a, b)) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2}
    assert got == want and len(links) == len(want)


def test_thresholds_always_cover_the_radius():
    rng = np.random.default_rng(1)
    groups = simhash.correlated_groups(np.eye(64), 10, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    plan = simhash.Plan(2, groups, 1000)
    plan.halves = [tuple(rng.integers(0, 9, 1 << w).astype(float) for w in plan.split(i)) for i in range(3)]
    plan.frequent = [(np.array([], dtype=np.uint64), np.array([]))] * 3
    values = plan.values(rng.integers(0, 2, (500, 64)).astype(np.uint8))
    chosen = simhash.thresholds(plan, values, plan.near())
    assert (chosen.sum(axis=1) == 2 - 3 + 1).all() and chosen.min() >= -1


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(50)]
    pairs = [p for p in pairs if p[0] != p[1]]
    want = union(pairs, {n for p in pairs for n in p})
    got = simhash.components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert {r.node: r.root for r in got.collect()} == want
    assert simhash.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_match_brute_force(edge_docs, documents):
    for docs in (edge_docs, documents):
        rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
        fps = sorted({f for _, f in rows})
        root = union([(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2], fps)
        least = {}
        for d, f in rows:
            if d is not None:
                least[root[f]] = min(d, least.get(root[f], d))
        got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits().alias("h"), "component_id").collect()
        assert sorted(((r.doc_id, r.h, r.component_id) for r in got), key=str) == sorted(((d, f"{f:016x}", least.get(root[f])) for d, f in rows), key=str)


def test_one_of_each_group_stays(edge_docs, no_docs):
    kept = simhash.keep_one_of_each_group(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 4, 5, None, 8, 9], key=str)
    assert simhash.keep_one_of_each_group(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
