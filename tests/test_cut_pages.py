"""Pages that are cut off inside a character reference: the queries and their SQL state one rule."""

import duckdb
import pytest

from sedimenta.plans import catalogue

HEAD = "<!DOCTYPE html><html><head><title>t</title></head><body><nav><ul><li><a href='/a'>a</a></li></ul></nav><article><h1>On &quot;it&quot; &copy; all</h1><p>"
STORY = "The story of one &amp; all was long enough to be kept as the text of this page, and it went on for some more words "
TAIL = "</p></article><footer>&copy; 2020 &middot; us</footer></body></html>"


@pytest.fixture(scope="module")
def cut(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("cut"))
    ends = ["&", "&am", "&amp", "&amp;", "&quo", "&quot", "&quot;", "&cop", "&copy", "&middot", "&amp &quot x"]
    con = duckdb.connect()
    con.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(k, f"http://h/{k}", HEAD + STORY + end + TAIL) for k, end in enumerate(ends)])
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(100 + k, f"http://h/{k}", HEAD + STORY + "</p><p>" + STORY + end) for k, end in enumerate(ends)])
    con.sql(f"COPY pages TO '{folder}/pages.parquet' (FORMAT parquet)")
    return folder, con


@pytest.mark.parametrize("name", ["main_text_runs", "sql_page_blocks"])
def test_cut_references(spark, cut, name):
    folder, con = cut
    frame = catalogue.QUERIES[name](spark, folder)
    want = con.sql(catalogue.ORACLES[name])
    columns = list(want.columns)
    rows = want.fetchall()
    assert len(rows) == 22
    assert sorted(tuple(r[c] for c in columns) for r in frame.collect()) == sorted(rows)


def test_cut_references_in_texts(spark, cut):
    """page_texts: its SQL ends an article at the footer, so only whole pages are compared."""
    folder, con = cut
    got = {r.page_id: r.text_sha256 for r in catalogue.QUERIES["page_texts"](spark, folder).collect()}
    want = {k: digest for k, _, digest in con.sql(catalogue.ORACLES["page_texts"]).fetchall()}
    assert len(want) == 11
    assert {k: got[k] for k in want} == want
