import hashlib
import math
import zlib

from sedimenta.llm import interleave


def test_elements_stay_in_order_with_their_captions():
    page = """<head><title>no</title></head><h1>T &amp; x</h1><p>one <b>two</b>
      <figure><img src="sha256:ab" alt="q"><img src="y.png"><figcaption>Cap <i>it</i></figcaption></figure>three
      <p>four<img src=x.png alt=Y>five<script>var "</p>"</script>"""
    got = [(e["kind"], e["position"], e["text"] or e["src"], e["digest"], e["caption"]) for e in interleave.parse(page)]
    assert got == [
        ("text", 0, "T & x", None, None),
        ("text", 1, "one two", None, None),
        ("media", 2, "sha256:ab", "ab", "Cap it"),
        ("media", 3, "y.png", None, "Cap it"),
        ("text", 4, "three", None, None),
        ("text", 5, "four", None, None),
        ("media", 6, "x.png", None, "Y"),
        ("text", 7, "five", None, None),
    ]
    assert interleave.parse(None) == [] and interleave.parse("") == []
    assert interleave.parse("<figure><figcaption>before</figcaption><img src=a></figure>")[0]["caption"] == "before"


def test_rasters_are_lossless():
    for raw in (b"", b"x", b"y" * 576, bytes(range(256)) * 9):
        samples = interleave.padded(raw)
        assert len(samples) % 576 == 0 and len(samples) >= 576 and samples.startswith(raw) and set(samples[len(raw) :]) <= {255}
        assert interleave.from_png(interleave.to_png(samples)) == samples


def test_features_from_stored_bytes(documents, edge_docs, no_docs):
    for docs in (documents, edge_docs):
        want = []
        for r in docs.collect():
            raw = (r.text or "").encode()
            samples = interleave.padded(raw)
            png = interleave.to_png(samples)
            want.append((r.doc_id, len(raw), len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(png), hashlib.sha256(png).hexdigest(), interleave.feature(samples)))
        assert sorted(map(tuple, interleave.media_features(docs).collect()), key=str) == sorted(want, key=str)
    assert interleave.media_features(no_docs).count() == 0


def test_unknown_digests_keep_their_place(spark, documents):
    store, _ = interleave.MediaStore.from_texts(documents.limit(2))
    page = spark.createDataFrame([(1, '<p>a<img src="sha256:00">b'), (2, None)], "page_id bigint, html string")
    rows = interleave.resolve(interleave.sequences(page, "page_id"), "page_id", store).orderBy("position").collect()
    assert [(r.kind, r.payload_bytes) for r in rows] == [("text", None), ("media", None), ("text", None)]


def test_bad_html_loses_no_text():
    texts = lambda page: [e["text"] or e["caption"] for e in interleave.parse(page)]
    assert texts("<html><head><title>t</title><body><p>one<p>two") == ["one", "two"]
    assert texts("<head><meta charset=x><p>one") == ["one"] and texts("<head>bare words") == ["bare words"]
    assert texts("<article><figure><img src=a><figcaption>cap</figure>after</article><p>more") == ["cap", "after", "more"]
    assert texts("<article><figure><img src=a><figcaption>cap</article><p>more") == ["cap", "more"]
    assert texts("<figure><img src=a><figcaption>cap <p>and more") == ["cap and more"]
    assert texts("<figcaption>no figure</figcaption>x") == ["no figure", "x"]
    assert texts("<figure><figcaption>no media</figcaption></figure>x") == ["no media", "x"]
    assert texts("<template><p>no</template><p>yes<noscript>no</noscript><br/>x</p></p></div>y") == ["yes", "x", "y"]


def plain_png(png):
    """Width, height, depth, colour type and samples, read by the format's rules."""
    assert png[:8] == bytes([137, 80, 78, 71, 13, 10, 26, 10])
    at, chunks = 8, []
    while at < len(png):
        n = int.from_bytes(png[at : at + 4], "big")
        kind, body, crc = png[at + 4 : at + 8], png[at + 8 : at + 8 + n], png[at + 8 + n : at + 12 + n]
        assert int.from_bytes(crc, "big") == zlib.crc32(kind + body)
        chunks.append((kind, body))
        at += 12 + n
    assert [k for k, _ in chunks] == [b"IHDR", b"IDAT", b"IEND"]
    head = chunks[0][1]
    width, height = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    lines = zlib.decompress(chunks[1][1])
    rows = [lines[i * (width + 1) : (i + 1) * (width + 1)] for i in range(height)]
    assert len(lines) == height * (width + 1) and all(r[0] == 0 for r in rows)
    return width, height, head[8], head[9], b"".join(r[1:] for r in rows)


def plain_feature(samples):
    n = len(samples)
    counts = [samples.count(v) for v in range(256)]
    mean = sum(v * c for v, c in enumerate(counts)) / n
    spread = math.sqrt(sum(c * (v - mean) ** 2 for v, c in enumerate(counts)) / n)
    entropy = -sum(c / n * math.log2(c / n) for c in counts if c)
    spans = [samples[i * n // 65 : (i + 1) * n // 65] for i in range(65)]
    bright = [sum(s) * 1_000_000 // len(s) for s in spans]
    return f"mean={mean:.4f};spread={spread:.4f};entropy={entropy:.4f};dhash={sum(1 << i for i in range(64) if bright[i] > bright[i + 1]):016x}"


def test_stored_rasters_are_plain_png(documents, edge_docs):
    for docs in (documents, edge_docs):
        store, _ = interleave.MediaStore.from_texts(docs)
        rows = store.spark.read.parquet(store.folder).collect()
        want = {t + b"\xff" * (576 - len(t) % 576 if len(t) % 576 or not t else 0) for t in ((r.text or "").encode() for r in docs.collect())}
        got = {}
        for r in rows:
            width, _, depth, colour, samples = plain_png(bytes(r.media))
            assert (width, depth, colour) == (576, 8, 0) and hashlib.sha256(samples).hexdigest() == r.digest
            got[samples] = r
        assert set(got) == want and len(rows) == len(want)  # each different text once
        for samples in list(want)[:20]:
            assert interleave.feature(samples) == plain_feature(samples)


def test_sequences_take_clashing_names_and_empty_tables(spark, documents):
    store, _ = interleave.MediaStore.from_texts(documents.limit(2))
    page = spark.createDataFrame([(1, "<p>a<img src=b>", "x", 3), (1, "<p>a<img src=b>", "x", 3)], "page_id bigint, html string, digest string, position int")
    assert interleave.resolve(interleave.sequences(page, "page_id"), "page_id", store).count() == 4
    assert interleave.resolve(interleave.sequences(page.where("false"), "page_id"), "page_id", store).count() == 0


def test_sequences_of_the_given_pages(spark):
    import hashlib

    from sedimenta.llm.registry import page_sequences

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r.page_id: r for r in page_sequences(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(pages)
    for page in pages:
        elements = interleave.parse(page.html)
        texts = [e["text"] for e in elements if e["kind"] == "text"]
        r = got[page.page_id]
        assert (r.n_elements, r.n_texts, r.text_sha256) == (len(elements), len(texts), hashlib.sha256("\n".join(texts).encode()).hexdigest())
        assert [e["position"] for e in elements] == sorted(e["position"] for e in elements) and texts


def test_sequences_of_empty_and_clashing_tables(spark):
    pages = spark.createDataFrame([(1, None, "e", "d"), (2, "", "e", "d"), (None, "<p>x</p>", "e", "d")], "page_id bigint, html string, elements string, digest string")
    assert {r.page_id: len(r.elements) for r in interleave.sequences(pages, "page_id").collect()} == {1: 0, 2: 0, None: 1}
    assert interleave.sequences(pages.limit(0), "page_id").count() == 0
