"""Fill-in-middle: round trips, cuts against a plain version, checkpoints at any spacing."""

import re
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, cut, order = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or cut % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if order % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \t\nü中🙂", max_size=60), st.integers(1, 5), st.integers(1, 9))
def test_checkpoints(text, every, window):
    data, units = text.encode(), UNIT.findall(text)
    points = fim.Checkpoints(data, every, window)
    assert points.n == len(units)
    assert points.units == list(range(0, len(units) + 1, every))
    for u in range(len(units) + 1):
        head = "".join(units[:u])
        assert points.end(u) == (len(head.encode()), len(head))


def check(docs):
    found = fim.transformed(docs).withColumn("restored", fim.restored())
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    texts = docs.collect()
    got = sorted((str(tuple(r)[:6]) for r in found.collect()))
    assert got == sorted(str((r["doc_id"], *plain(r["doc_id"], r["text"]))) for r in texts)
    assert sorted(r.restored for r in found.collect()) == sorted(r["text"] or "" for r in texts)


def test_edge_rows(edge_docs, no_docs):
    check(edge_docs)
    assert fim.transformed(no_docs).count() == 0


def test_given_documents(documents):
    check(documents)
    forms = {r["form"] for r in fim.transformed(documents).select("form").distinct().collect()}
    assert forms == {"plain", "psm", "spm"}


def test_marks_and_brackets(spark):
    texts = ["a <P> b", "x<S>", "<M>", "< P >", "a <P b<", "<<<S", "M> <", "one <S two", " \n "]
    docs = spark.createDataFrame([(100 * i + j, t) for i, t in enumerate(texts) for j in range(40)], "doc_id bigint, text string")
    check(docs)
    assert fim.transformed(docs).where("doc_id < 300").select("form").distinct().collect()[0][0] == "plain"


def test_very_long_text(spark):
    docs = spark.range(8).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("wörd \n"), 400_000), F.col("id").cast("string")).alias("text"))
    check(docs)
