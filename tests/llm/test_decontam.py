"""Decontamination against a plain version that tries every window at every place."""

import re
from hashlib import sha256

import pytest

from sedimenta.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def windows(text):
    w = words(text)
    return [(s, w[s : s + 10]) for s in range(max(1, len(w) - 9))] if w else []


def plain(docs, items):
    out = []
    for d in docs:
        w, hit, ids = words(d["text"]), set(), set()
        for i in items:
            for _, win in windows(i["text"]):
                for s in range(len(w) - len(win) + 1):
                    if w[s : s + len(win)] == win:
                        hit |= set(range(s, s + len(win)))
                        ids.add(i["item_id"])
        digest = sha256(",".join(sorted(str(i) for i in ids if i is not None)).encode()).hexdigest()
        out.append((d["doc_id"], len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=str)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


LONG = " ".join(f"t{i}" for i in range(30))
DOCS = [
    (1, f"before {LONG} after"),
    (2, f"{LONG} {LONG}"),
    (3, " ".join(f"t{i}" for i in range(9))),
    (4, "Tiny Item, tiny item"),
    (5, None),
    (6, ""),
    (7, "t0 t1 t2 t3 t4"),
    (7, "t5 t6 t7 t8 t9"),
    (8, "a a a a a a a a a a a a a a a"),
    (8, "a a a a a a a a a a a a a a a"),
    (None, f"x {LONG}"),
    (9, " ".join(f"t{i}" for i in range(12)) + " gap " + " ".join(f"t{i}" for i in range(12, 25))),
    (10, "t0 t1 t2 t3 new t4 t5 t6 t7 t8 t9"),
    (11, LONG.upper().replace(" ", " --\n")),
]
ITEMS = [(10, LONG), (11, "tiny ITEM"), (12, None), (13, ""), (14, "a a a a a a a a a a a"), (14, "a a"), (14, "a a"), (None, "x t0 t1"), (2, "nothing of this kind is here at all, not a single word")]


@pytest.fixture
def tables(spark):
    docs = spark.createDataFrame([(*d, "r", "p") for d in DOCS], "doc_id bigint, text string, row string, positions string")
    return docs, spark.createDataFrame([(*i, "s") for i in ITEMS], "item_id bigint, text string, spans string")


@pytest.mark.parametrize("shard_bytes, query_bytes, candidates", [(8_000_000, 4_000_000, 2_000_000), (60, 30, 3)])
def test_equals_plain_version(tables, monkeypatch, shard_bytes, query_bytes, candidates):
    docs, items = tables
    monkeypatch.setattr(decontam, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(decontam, "CANDIDATES", candidates)
    index = decontam.PositionalIndex.build(docs.repartition(2))
    index.query_bytes = query_bytes
    found = index.documents(items)
    assert rows(decontam.contamination(found)) == plain(docs.collect(), items.collect())
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in found.where("doc_id in (1, 2, 9)").collect()}
    assert spans == {1: [(1, 31)], 2: [(0, 60)], 9: [(0, 12), (13, 26)]}


def test_edge_rows_and_empty_tables(spark, edge_docs, no_docs, tables):
    items = spark.createDataFrame([(1, "same text here now"), (2, "only null"), (3, "w0 w2916 w829"), (4, "x")], "item_id bigint, text string")
    assert rows(decontam.decontaminated(edge_docs, items)) == plain(edge_docs.collect(), items.collect())
    assert decontam.decontaminated(no_docs, items).count() == 0
    assert {r.n_items for r in decontam.decontaminated(edge_docs, items.limit(0)).collect()} == {0}


def test_given_documents(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert rows(decontam.decontaminated(documents, items)) == plain(documents.collect(), items.collect())


@pytest.mark.parametrize("slop", [0, 1, 2])
def test_matches_and_proximity(tables, slop):
    docs, items = tables
    got = decontam.PositionalIndex.build(docs).matches(items, slop)
    wanted = set()
    for i in items.distinct().collect():
        for k, win in windows(i["text"]):
            for d in docs.collect():
                w = words(d["text"])
                near = lambda j, at: any(0 <= p < len(w) and w[p] == win[j] for p in range(at + j - slop, at + j + slop + 1))
                at = [s for s in range(-slop, len(w)) if all(near(j, s) for j in range(len(win)))]
                wanted |= {(i["item_id"], k, d["doc_id"], s) for s in (at if not slop else at[:1])}
    assert {tuple(r) for r in got.collect()} == wanted
    if slop == 1:
        assert any(r.doc_id == 10 for r in got.collect())
