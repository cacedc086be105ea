import random
from collections import Counter

import corpus_pipeline
from sedimenta.llm import simhash
from tests_llm_plain import jaccard, word_fingerprint

SCHEMA = "doc_id bigint, text string, source string"


def edited(words, at):
    return " ".join([*words[:at], "edit", *words[at + 1 :]])


def stage(spark, rows):
    got = corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    return sorted(r.doc_id for r in got)


def test_near_copies_at_any_distance_go(spark):
    """Copies with small edits, most of them beyond two bits of SimHash."""
    rng = random.Random(5)
    rows, beyond = [], 0
    for g in range(60):
        words = [f"w{rng.randrange(4000)}" for _ in range(100)]
        text = " ".join(words)
        copy = edited(words, 50)
        assert jaccard(text, copy) >= 0.8
        beyond += (simhash.fingerprint(text) ^ simhash.fingerprint(copy)).bit_count() > 2
        rows += [(g, text, "a"), (1000 + g, copy, "a")]
        # Just below the least similarity, and half the text: both stay.
        rows += [(2000 + g, " ".join(words[:40] + [f"x{g}-{i}" for i in range(60)]), "a")]
    assert beyond > 30
    assert stage(spark, rows) == [*range(60), *range(2000, 2060)]


def test_the_least_similarity_itself():
    words = [f"w{i}" for i in range(94)]  # 90 shingles; 80 shared of 100 is 0.8, 79 of 101 is less
    at = lambda n: " ".join(words[: 4 + n] + [f"y{n}-{i}" for i in range(90 - n)])
    assert jaccard(" ".join(words), at(80)) == 0.8 > jaccard(" ".join(words), at(79))
    same = lambda n: simhash.similar(simhash.shingles(" ".join(words)), simhash.shingles(at(n)))
    assert same(80) and not same(79)


def test_word_fingerprints(edge_docs, documents):
    for docs in (edge_docs, documents):
        for r in docs.select("text").collect():
            assert simhash.word_fingerprint(r.text) == word_fingerprint(r.text)


def groups_of(pairs, nodes):
    root = {n: n for n in nodes}
    for a, b in pairs:
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = {n: new if r == old else r for n, r in root.items()}
    return root


def test_large_groups_are_linked(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(4000)}" for _ in range(200)]
    rows = [(i, edited(words, i % 200), "a") for i in range(400)] + [(None, " ".join(words), "a"), (900, None, "a"), (901, " ", "a"), (902, "a b", "a"), (902, "A  b", "a")]
    assert stage(spark, rows) == [0, 900, 902]


def test_all_pairs_within_the_radius_are_linked_and_no_others(spark, monkeypatch):
    """Texts around a few centres, so that many lie within the radius without being similar; large components in small ones' buckets."""
    monkeypatch.setattr(simhash, "LARGE_COMPONENT", 6)
    rng = random.Random(8)
    texts = []
    for _ in range(4):
        words = [f"w{rng.randrange(3000)}" for _ in range(120)]
        for _ in range(40):
            own = list(words)
            for _ in range(rng.choice([1, 1, 2, 6, 9])):
                own[rng.randrange(120)] = f"x{rng.randrange(3000)}"
            texts.append(" ".join(own))
        texts += [" ".join(rng.sample(words, 120)) for _ in range(10)]  # equal fingerprints, other shingles
    fps = [word_fingerprint(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= simhash.NEAR_RADIUS]
    alike = [(i, j) for i, j in near if jaccard(texts[i], texts[j]) >= 0.8]
    assert len(near) > 2 * len(alike) > 200
    want = groups_of(alike, range(len(texts)))
    rows = spark.createDataFrame(list(enumerate(texts)), "_row bigint, _text string")
    marked = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "_row bigint, fp bigint")
    got = {r.node: r.root for r in simhash.SimilarRows(rows).roots(marked).collect()}
    assert {i: got.get(i, i) for i in want} == want


def test_a_crowd_makes_no_pairs_of_what_its_copies_keep(spark, monkeypatch):
    """Copies of one text, half of them similar and half with so many edits that none is: few pairs are left to verify, and all links are found."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(150)]
    texts = []
    for g in range(400):
        own = list(words)
        for at in rng.sample(range(3, 147), 1 if g % 2 else 5):
            own[at] = f"x{g // 5}-{at}"
        texts.append(" ".join(own))
    fps = [word_fingerprint(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= simhash.NEAR_RADIUS]
    want = groups_of([(i, j) for i, j in near if jaccard(texts[i], texts[j]) >= 0.8], range(len(texts)))
    apart = sum(want[i] != want[j] for i, j in near)
    assert apart > 20 * len(texts) and 100 < len(set(want.values())) < 300
    verified, links = [], simhash.SimilarRows.links
    monkeypatch.setattr(simhash.SimilarRows, "links", lambda self, pairs: verified.append(pairs) or links(self, pairs))
    rows = spark.createDataFrame(list(enumerate(texts)), "_row bigint, _text string")
    marked = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "_row bigint, fp bigint")
    got = {r.node: r.root for r in simhash.SimilarRows(rows).roots(marked).collect()}
    assert {i: got.get(i, i) for i in want} == want
    made = [pairs.count() for pairs in verified]
    assert sum(made) < 40 * len(texts) and made[-1] < 4 * len(texts)


def test_near_copies_of_the_given_documents_are_caught(spark):
    """Recall at sf0.1: pairs of the given documents with a similarity of 0.8 or more, among all that share a rare shingle."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = corpus_pipeline.exact_stage(spark, docs, "").collect()
    sets = [set(simhash.shingles(r.text).tolist()) for r in rows]
    holders = {}
    for i, own in enumerate(sets):
        for s in own:
            holders.setdefault(s, []).append(i)
    shared = Counter((i, j) for own in holders.values() if 1 < len(own) <= 50 for k, i in enumerate(own) for j in own[:k])
    pairs = [(i, j) for (i, j) in shared if 5 * (n := len(sets[i] & sets[j])) >= 4 * (len(sets[i]) + len(sets[j]) - n)]
    root = groups_of(pairs, {i for p in pairs for i in p})
    lost = sum(i != r for i, r in root.items())
    kept = corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, docs.schema), "").count()
    assert lost >= 40 and 0.9 * lost <= len(rows) - kept <= lost


def test_given_near_copies_go(spark):
    """All pairs of the given documents with a similarity of 0.8 or more, by comparing each with each other."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = corpus_pipeline.exact_stage(spark, docs, "").collect()
    sets = [set(simhash.shingles(r.text).tolist()) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j]) if not sets[i].isdisjoint(sets[j]) else 0
            if 5 * shared >= 4 * (len(sets[i]) + len(sets[j]) - shared):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if x == old else x for x in root]
    want = {min(rows[k].doc_id for k in range(len(rows)) if root[k] == r) for r in set(root)}
    assert len(rows) - len(want) == 5
    got = corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, docs.schema), "").collect()
    assert len(got) == len(want) and {r.doc_id for r in got} == want
