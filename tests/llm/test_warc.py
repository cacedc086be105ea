import gzip

import pytest

from sedimenta.llm import warc

ROWS = [(1, "http://a/x", "hé\r\n\r\nllo"), (2, "u", "same"), (3, "u2", "same"), (4, None, None), (5, "v", ""), (6, "w\r\nx", "x" * 2_500_000), (None, "n", "same"), (2, "u", "same"), (None, "q", "only"), (8, "z", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1")]


def plain(rows, least):
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        first = min(same, default=None)
        again = len(raw) >= least and first is not None and page_id != first
        out.append((page_id, len(raw), warc.payload_digest(raw), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_captures(spark, least):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id bigint, url string, html string, record_id string")
    got = warc.captures(pages, least).collect()
    assert sorted(map(tuple, got), key=str) == plain(ROWS, least)


def test_empty_table(spark):
    assert warc.captures(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_archives_are_plain_warc(spark, tmp_path):
    folder = warc.write(spark.createDataFrame(ROWS[:2], "page_id bigint, url string, html string").coalesce(1), folder=f"file://{tmp_path}/w")
    (path,) = (tmp_path / "w").glob("*.gz")
    raw = gzip.decompress(path.read_bytes())
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"\r\n\r\n") and raw.count(b"WARC-Concurrent-To: ") == 4
    assert [r["type"] for r in warc.parse(raw)] == ["response", "request", "metadata"] * 2
    assert [r["type"] for r in warc.parse(gzip.compress(raw[:300]) + gzip.compress(raw[300:]))] == ["response", "request", "metadata"] * 2
    nested = warc.assemble(warc.read(spark, folder)).collect()
    assert {r.metadata.page_id for r in nested} == {"1", "2"} and all(r.request.target_uri == r.target_uri for r in nested)


def test_damage_is_found():
    raw = b"".join(r + b"\r\n\r\n" for r in warc.capture_records(1, "u", b"payload", None, False))
    for bad in (raw.replace(b"payload\r\n\r\n", b"paylxad\r\n\r\n"), raw[:-5], raw[:40]):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_text_ids_come_back_as_they_were(spark):
    ids = ["None", " a ", "a", "x: y\r\nz", "ü%20", ""]
    pages = spark.createDataFrame([(i, "u", f"payload {i}") for i in ids] + [(None, "u", "p")], "page_id string, url string, html string")
    assert sorted(r.page_id or "-" for r in warc.captures(pages).collect() if r.page_id is not None) == sorted(i or "-" for i in ids)


def test_long_archives_are_read_as_a_stream(spark):
    """Payloads that end in, start with or consist of line ends, next to each other in one file."""
    htmls = ["\r\n", "\r\n\r\n", "\r", "x\r\n\r", "\n\r\n\r\nx\r\n", "", None, "\r\n" * 50, "y" * 3_000_000 + "\r\n"] * 3
    rows = [(i, "u", h) for i, h in enumerate(htmls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    assert sorted(map(tuple, warc.captures(pages).collect()), key=str) == plain(rows, 0)
