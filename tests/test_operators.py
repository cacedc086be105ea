import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import audit, classify, dedupe, extract, merge, metrics, refs, schedule, search
from sedimenta.plans import catalogue
from sedimenta.sources import readers


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_fair_order_alternates(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "a", "a", "b", "c"])], "ord int, host string")
    out = schedule.fair_order(df, F.col("host"), [F.col("ord")]).orderBy(*schedule.turn_columns())
    assert [r.ord for r in out.collect()] == [0, 3, 4, 1, 2]
    big = spark.createDataFrame([(i, "x" if i < 100 else "y" if i < 140 else "rare") for i in range(141)], "ord int, host string")
    out = schedule.fair_order(big, schedule.route(F.lit(""), F.col("host")), [F.col("ord")], by_size=True).orderBy(*schedule.turn_columns(True))
    assert "general:rare" in [r.bucket for r in out.limit(3).collect()]
    assert schedule.fair_order(df, F.lit(None).cast("string"), [F.col("ord")]).first().bucket == "_unknown"


def test_pages_number_in_order(spark):
    df = spark.range(1050).select((F.col("id") * 7919 % 1050).alias("k"))
    out = schedule.pages(df, [F.col("k")], 100)
    assert rows(out.select("k", "position", "page"), "k") == [(k, k + 1, k // 100 + 1) for k in range(1050)]


def test_numbers_within_hot_groups(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), (F.col("id") * 7919 % 3001).alias("k"))
    out = schedule.numbered(df, ["g"], [F.col("k")], "n", 16)
    seen = {}
    for r in df.collect():
        seen.setdefault(r.g, []).append(r.k)
    assert sorted(((r.g, r.k, r.n) for r in out.collect()), key=str) == sorted(((g, k, i + 1) for g, ks in seen.items() for i, k in enumerate(sorted(ks))), key=str)


def test_job_snapshot(spark):
    t = "2024-01-01 00:00:"
    items = spark.createDataFrame([("ok", t + "10"), ("ok", t + "50"), ("bad", t + "55"), ("ok", t + "58")], "status string, at string").withColumn("updated_at", F.to_timestamp("at"))
    now, started = F.to_timestamp(F.lit("2024-01-01 00:01:00")), F.to_timestamp(F.lit(t + "00"))
    row = metrics.job_snapshot(items, now, started, F.lit(10), {"successful": ["ok"], "failed": ["bad"]}).first()
    assert (row.total, row.successful, row.failed, row.successful_pct, row.count_30, row.count_60, row.stalled) == (4, 3, 1, 75.0, 3, 4, False)
    assert row.eta_seconds == 60.0 * 6 / 4.0
    late = metrics.job_snapshot(items, F.to_timestamp(F.lit("2024-01-01 00:10:00")), started, F.lit(10), {"successful": ["ok"]}).first()
    assert late.stalled and late.eta_seconds is None


def test_gcra(spark):
    arrivals = [(0.0,), (0.1,), (0.2,), (5.0,), (5.1,)]
    df = spark.createDataFrame([("h", a) for (a,) in arrivals], "h string, a double")
    due, want = None, []
    for (a,) in arrivals:
        start = a if due is None else max(a, due)
        want.append(start)
        due = start + 1.0
    assert [round(r.start, 6) for r in schedule.gcra(df, "h", "a", 1.0, 1).orderBy("a").collect()] == want


def test_work_selection(spark):
    work = spark.createDataFrame([(1, False), (2, True), (3, False), (4, True)], "id int, part boolean")
    done = spark.createDataFrame([(4,)], "id int")
    assert [r.id for r in schedule.select_work(work, done, "id", F.col("part"), F.col("id"), start_after=1).collect()] == [2, 3]


def test_reference_matching_prefers_raw(spark):
    sources = spark.createDataFrame([("s2", ["http://a"], "http://n"), ("s1", ["http://b"], "http://n"), ("s0", ["http://z"], "")], "source_id string, raw_urls array<string>, normalized_url string")
    refs_ = spark.createDataFrame([(1, "http://a", "http://n"), (2, "http://q", "http://n"), (3, "http://q", "http://none"), (4, None, None)], "i int, raw_url string, normalized_url string")
    assert rows(refs.match_sources(refs_, sources).select("i", "source_id"), "i") == [(1, "s2"), (2, "s1"), (3, None), (4, None)]


def test_entities_keep_raw_variants(spark):
    df = spark.createDataFrame([(1, "http://A.org/x"), (2, "http://a.org/x#f"), (3, "not a url"), (4, "http://A.org/x")], "id int, url string")
    out = refs.roll_up_entities(df, "url", "id", "id").orderBy("n_references").collect()
    assert [(r.raw_urls, r.reference_ids, r.status) for r in out] == [(["not a url"], [3], "malformed"), (["http://A.org/x", "http://a.org/x#f"], [1, 2, 4], "normalized")]


def test_stages_add_only_unseen_pairs(spark):
    s = "record_id string, raw_url string, ord int"
    a = spark.createDataFrame([("r", "u", 1), ("r", "u", 2)], s)
    b = spark.createDataFrame([("r", "u", 1), ("r", "v", 2), ("r", "v", 3), (None, "w", 4)], s)
    c = spark.createDataFrame([("r", "v", 1), ("r", "w", 2), ("r", "", 3)], s)
    out = refs.collect_references(a, b, c).select("origin", "occurrence", "raw_url", "is_repeat")
    assert rows(out, "origin", "occurrence") == [("embedded", 1, "w", False), ("historical", 1, "u", False), ("historical", 2, "u", True), ("provenance", 1, "v", False)]


def test_a_repeat_never_comes_before_what_it_repeats(spark):
    s = "record_id string, raw_url string, ord int"
    tied = spark.createDataFrame([("r", "u", 1), ("r", "v", 1), ("r", "u", 1), ("r", "v", 1)], s).repartition(4)
    out = refs.collect_references(tied, tied.where("false"), tied.where("false")).collect()
    for url in "uv":
        assert [r.is_repeat for r in sorted(out, key=lambda r: r.occurrence) if r.raw_url == url] == [False, True]


def test_link_evidence_and_digests(spark):
    declared = spark.createDataFrame([(1, "http://a")], "id int, url string")
    docs = spark.createDataFrame([(1, '{"t": ["see http://b, and http://c."]}'), (2, None)], "id int, j string")
    assert rows(refs.link_evidence(declared, docs, "id", "j").select("url", "path", "kind"), "url") == [("http://a", None, "declared"), ("http://b", "$.t[0]", "embedded"), ("http://c", "$.t[0]", "embedded")]
    digest = lambda df: refs.worklist_digest(df).first().digest
    work = spark.range(100)
    assert digest(work) == digest(work.repartition(7).orderBy(F.desc("id"))) != digest(work.where("id > 0"))
    assert digest(work.where("false")) == digest(work.where("id < 0"))


def test_merge_lists_conflicts(spark):
    df = spark.createDataFrame([("r", "f", "A", "api", 1), ("r", "f", "a ", "live", 2), ("r", "f", "b", "archive", 9), ("r", "g", "", "api", 1), ("r", "g", "x", "historical", 1)], "record_id string, field string, value string, origin string, captured_at int")
    chosen, conflicts = merge.merge_fields(df)
    assert rows(chosen.select("field", "value", "origin"), "field") == [("f", "A", "api"), ("g", "x", "historical")]
    assert rows(conflicts.select("field", "preferred_value", "other_value", "other_source"), "field") == [("f", "A", "b", "archive")]
    cell = spark.range(1).select(merge.apply_verified(F.lit("old"), F.lit("api"), F.lit("new"), F.lit("live")).alias("x"), merge.apply_verified(F.lit("old"), F.lit("api"), F.lit(""), F.lit("live")).alias("y")).first()
    assert (cell.x.value, cell.x.provenance, cell.x.conflict.other_value) == ("new", "live", "old") and (cell.y.value, cell.y.conflict) == ("old", None)


def test_previous_state_stays(spark):
    s = "id int, text string, links array<string>"
    out = merge.merge_state(spark.createDataFrame([(1, "kept", ["old"])], s), spark.createDataFrame([(1, "", ["new", "old"]), (2, "t", None)], s), "id", ["text"], ["links"])
    assert rows(out, "id") == [(1, "kept", ["old", "new"]), (2, "t", [])]


def test_promotion_and_cache(spark):
    p = lambda *a: spark.range(1).select(merge.promote(*[F.lit(x) for x in a]).alias("p")).first().p
    assert p(None, None, None, "new", 50, "news_article").promoted
    assert p("old", False, 90, "new", 50, "news_article").promoted
    assert not p("old text", True, 90, "new", 95, "news_article").promoted
    assert p("old", True, 90, "newer", 95, "news_article").promoted
    assert p("o" * 300, True, 90, "n" * 450, 10, "news_article").promoted
    kept = p("o" * 300, True, 90, "n" * 450, 10, "public_x_post")
    assert not kept.promoted and kept.review
    h = lambda t: F.sha2(F.lit(t), 256)
    admit = lambda text, digest, resolved, score, held, held_score: spark.range(1).select(merge.admit_to_cache(F.lit(text), digest, F.lit(resolved), F.lit(score), F.lit("successful"), F.lit(held), F.lit(held_score), F.lit("successful")).alias("a")).first().a
    assert admit("t", h("t"), True, 90, False, 0)
    assert not admit("t", h("other"), True, 90, False, 0)
    assert not admit("t", h("t"), True, 50, True, 90)
    assert not admit("", h(""), False, 0, True, 10)


def test_duplicates_are_labelled(spark):
    df = spark.createDataFrame([(1, "h"), (2, "h"), (3, "i"), (4, None)], "id int, h string")
    out = dedupe.duplicate_groups(df, "h", "id")
    assert rows(out.select("id", "canonical", "is_canonical"), "id") == [(1, 1, True), (2, 1, False), (3, None, None), (4, None, None)]
    assert tuple(dedupe.duplicate_counts(df, "h").first()) == (1, 2, 1)


def test_evidence_spreads_in_a_batch(spark):
    df = spark.createDataFrame([("b", 1, 403), ("b", 2, None), ("c", 3, None)], "batch string, id int, status int")
    assert rows(dedupe.spread_evidence(df, "batch", "status").select("id", "effective_status"), "id") == [(1, 403), (2, 403), (3, None)]


def test_mirrored_observations_count_once(spark):
    from sedimenta.functions.urls import normalize_source_url

    s = "original_url string, ext string"
    h = spark.createDataFrame([("http://x.org/a", "1"), ("http://x.org/a", "2")], s)
    n = spark.createDataFrame([("http://x.org/a#f", "1"), ("http://x.org/b", "9")], s)
    out = dedupe.url_observations(h, n, "original_url", "ext", normalize_source_url("original_url"))
    assert rows(out.groupBy("normalized_original_url").count(), "normalized_original_url") == [("http://x.org/a", 2), ("http://x.org/b", 1)]


def test_percentiles_of_two_kinds(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "duration double")
    assert tuple(metrics.linear_percentiles(df, ["duration"]).first()) == (2.0, 8.4)
    assert metrics.timing_report(df.withColumn("g", F.lit(None).cast("string")), "duration", ["g"]).first().p90 == 10.0


def test_bottleneck_needs_waiting(spark):
    s = "host string, total int, q double, p double, p90 double"
    df = spark.createDataFrame([("a", 5, 1.0, 2.0, 9.0), ("b", 9, 0.5, None, 99.0)], s)
    assert tuple(metrics.bottleneck(df, "q", "p", "p90").first()) == ("a", 3.0, "pacing")
    assert metrics.bottleneck(df.withColumn("q", F.lit(0.0)).withColumn("p", F.lit(0.0)), "q", "p", "p90").count() == 0


def test_partials_and_rest(spark):
    df = spark.createDataFrame([("k", 1, 2, "old"), ("k", 5, 3, "new")], "k string, at int, n int, state string")
    assert tuple(metrics.merge_partials(df, ["k"], ["n"], "state", "at").first()) == ("k", 5, "new")
    maps = spark.createDataFrame([({"h": {"ok": 1}},), ({"h": {"ok": 2, "bad": 1}},)], "host_status map<string, map<string, int>>")
    assert rows(metrics.merge_host_maps(maps), "status") == [("h", "bad", 1), ("h", "ok", 3)]
    projected = metrics.projections(spark.createDataFrame([("u", 3.0)], "unit string, size double"), "size", {"low": 0.5, "high": 2.0}, [10, 100])
    assert sorted((r.scenario, r.records, r.bytes) for r in projected.collect()) == [("high", 10, 60.0), ("high", 100, 600.0), ("low", 10, 15.0), ("low", 100, 150.0)]
    one = spark.range(1).select(metrics.unattributed(F.lit(10.0), F.lit(3.0), F.lit(None).cast("double")).alias("a"), metrics.unattributed(F.lit(10.0), F.lit(None).cast("double")).alias("b"), metrics.speedup(F.lit(2.0), F.lit(10), F.lit(4.0)).alias("c")).first()
    assert tuple(one) == (7.0, None, 5.0)
    assert {r.key for r in metrics.key_sizes(df).collect()} == {"k", "at", "n", "state"}


BODIES = [
    ("html", '<html><head><title>T</title><meta name="author" content="A"><meta property="og:description" content="A description that is long enough"></head><body><nav>menu</nav><article><h1>Head</h1><p>First part.</p><p>First part.</p><p>Second.</p></article></body></html>', "semantic_dom", "Head\n\nFirst part.\n\nSecond."),
    ("html", '<html><script type="application/ld+json">{"headline": "H", "articleBody": "The body of the article, in structured data."}</script><body></body></html>', "jsonld:articlebody", "The body of the article, in structured data."),
    ("html", "<p>Only a paragraph</p>", "body_text", "Only a paragraph"),
    ("json", json.dumps({"data": [{"article_body": "Nested <b>text</b> of some length here"}]}), "json:article_body", "Nested text of some length here"),
    ("json", '{"a": {"b": [1, "x"]}}', "json_text_fallback", "$.a.b[0]: 1\n$.a.b[1]: x"),
    ("xml", "<rss><channel><item><title>I</title><description><![CDATA[<p>Feed text</p>]]></description></item></channel></rss>", "feed_items", "Feed text"),
    ("xml", '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><content>Atom text</content></entry></feed>', "feed_items", "Atom text"),
    ("csv", "a,b\nalpha,1\n", "delimited_rows", "a | b\nalpha | 1"),
    ("text", "plain\ntext", "plain_text", "plain\ntext"),
    ("text", "{\\rtf1 Hello\\par W\\'e9}", "rtf_text", "Hello\nWé"),
    ("pdf", "%PDF", "none", ""),
    ("unsupported", "", "none", ""),
]


@pytest.mark.parametrize(("kind", "body", "method", "found"), BODIES)
def test_extraction(kind, body, method, found):
    got = extract.extract(body.encode(), None, kind)
    assert (got["method"], got["text"]) == (method, found)


def test_office_documents_and_charsets(spark):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="w"><w:body><w:p><w:r><w:t>Para </w:t></w:r><w:r><w:t>one</w:t></w:r></w:p><w:p><w:r><w:t>two</w:t></w:r></w:p></w:body></w:document>')
    assert extract.extract(held.getvalue(), None, "office_open_xml")["text"] == "Para one\ntwo"
    assert extract.extract(b"PK broken", None, "office_open_xml")["text"] == ""
    assert extract.extract("<p>مرحبا</p>".encode("windows-1256"), "text/html; charset=windows-1256", "html")["text"] == "مرحبا"
    df = spark.createDataFrame([(1, bytearray(b"<p>x y</p>"), "text/html"), (2, None, None)], "id int, body binary, mime string")
    out = extract.extract_bodies(df, "id", "body", F.col("mime"), classify.body_format("body", "mime", F.lit("")))
    assert rows(out.select("id", "text", "method"), "id") == [(1, "x y", "body_text"), (2, "", "none")]


def test_json_leaves(spark):
    df = spark.createDataFrame([(1, '{"a": [{"status": 403}, {"status": 200}], "api_key": "k"}'), (2, "broken"), (3, None)], "id int, j string")
    assert rows(extract.json_leaves(df, "id", "j"), "path") == [(1, "$.a[0].status", "403"), (1, "$.a[1].status", "200"), (1, "$.api_key", "k")]
    assert sorted(extract.json_values(df, "id", "j", ["status"]).first()["values"]) == ["200", "403"]
    assert [r.path for r in extract.credential_like(df, "id", "j").collect()] == ["$.api_key"]


CATALOGUE = [
    ("http://c/1", '<article data-accession="A1"><h1 class="entry-title">One <i>x</i></h1><time class="published" datetime="2024-01-01"></time><section class="abstract">Text</section><a class="reference-link" href="http://s/1">r</a></article>'),
    ("http://c/2", '<article data-accession="A2"><h1 class="entry-title">Two</h1><section class="abstract">Text</section><a class="reference-link" href="http://s/1">r</a><a class="reference-link" href="not a url">r</a></article>'),
    ("http://c/3", "<article></article>"),
    ("http://c/4", '<article data-accession="A4"><h1 class="entry-title">Four</h1></article>'),
]


def test_catalogue_connector_end_to_end(spark):
    pages = spark.createDataFrame(CATALOGUE, "url string, body string")
    found = readers.connector("catalogue")
    parsed = found.parse(pages)
    assert rows(parsed.select("url", "record_id", "error"), "url") == [("http://c/1", "A1", None), ("http://c/2", "A2", None), ("http://c/3", None, "catalogue_entry_missing"), ("http://c/4", "A4", "missing_required_field:abstract")]
    assert parsed.where("record_id = 'A1'").first().fields["title"] == "One x"
    each = parsed.where("error is null").select("record_id", F.posexplode("references").alias("ord", "url")).withColumn("id", F.concat_ws("-", "record_id", "ord"))
    entities = refs.roll_up_entities(each, "url", "id", "id").collect()
    assert each.count() == 3 and len(entities) == 2 and sorted(len(e.reference_ids) for e in entities) == [1, 2]
    assert sum(e.status != "malformed" for e in entities) == 1
    assert found.discover(pages).count() == 4 and found.record_types() == ["catalogue_entry"]
    assert {r.field: r.n for r in found.analyze(pages).collect()}["title"] == 3
    with pytest.raises(KeyError):
        readers.connector("nothing")


def test_rules_become_issues(spark):
    t = {
        "records": spark.createDataFrame([("r1", "35", "36"), ("r1", "35", "36"), ("r2", None, None)], "record_id string, latitude string, longitude string"),
        "sources": spark.createDataFrame([("s1", "FULL_TEXT_DIRECT", "", 200, "FETCHED"), ("s2", "BLOCKED", None, 403, "FETCHED")], "source_id string, content_status string, text string, http_status int, reachability string"),
        "references": spark.createDataFrame([("f1", "r1", "s1"), ("f2", "gone", "s9")], "source_reference_id string, record_id string, source_id string"),
    }
    found = audit.issues(t, audit.record_rules())
    assert {r.code: r["count"] for r in found.groupBy("code").count().collect()} == {"record_id_repeated": 1, "reference_without_record": 1, "reference_without_source": 1, "full_text_without_text": 1, "blocked_as_success": 1, "record_without_reference": 1, "coordinates_not_drawable": 1}
    assert tuple(audit.verdict(found).first()) == (5, 1, 1, False)
    assert tuple(audit.verdict(found.where("false")).first()) == (0, 0, 0, True)


def test_release_gates(spark):
    t = {
        "records": spark.createDataFrame([("r1", "35", "36"), ("r2", None, None)], "record_id string, latitude string, longitude string"),
        "sources": spark.createDataFrame([("s1", "FULL_TEXT_DIRECT", "text", 200, "FETCHED", "unchanged"), ("s2", "DEAD", None, 404, "DEAD", "unchanged")], "source_id string, content_status string, text string, http_status int, reachability string, url_status string"),
        "references": spark.createDataFrame([("f1", "r1", "s1", "http://a", "http://a/"), ("f2", "r2", "s2", "http://b", "http://b/")], "source_reference_id string, record_id string, source_id string, raw_url string, normalized_url string"),
    }
    t["index"] = spark.createDataFrame([("r1", "record"), ("r2", "record"), ("s1", "source"), ("s2", "source")], "id string, kind string")
    t["points"] = spark.createDataFrame([("r1",)], "record_id string")
    t["pages"] = t["records"].select("record_id")
    t["exports"] = t["references"].select("raw_url", "normalized_url")
    gates = audit.release_gates(t)
    assert tuple(audit.acceptance(gates).first()) == (gates.count(), 0, True) and gates.count() > 20
    broken = t | {"points": spark.createDataFrame([("r2",)], "record_id string"), "pages": spark.createDataFrame([("r1",), ("r9",)], "record_id string"), "sources": t["sources"].withColumn("reachability", F.lit("FETCHED"))}
    assert {r.name for r in audit.release_gates(broken).where("not ok").collect()} == {"dead_without_evidence", "point_missing", "point_not_drawable", "page_missing", "page_orphaned"}


def test_links_resolve_and_break(spark):
    pages = spark.createDataFrame([("/a/b.html", '<a href="c.html"><a href="../d/"><a href="../../x"><a href="http://o/"><a href="#t"><img src="/no.png"><a href="/a/b.html?q#f">')], "path string, html string")
    files = spark.createDataFrame([("/a/b.html",), ("/a/c.html",), ("/d/index.html",)], "path string")
    assert rows(audit.link_audit(pages, files).select("href", "problem"), "href") == [("../../x", "escapes"), ("/no.png", "broken")]


def test_audit_tables(spark):
    df = spark.createDataFrame([("r1", "A"), ("r2", "A"), ("r3", "B")], "record_id string, s string")
    assert rows(audit.summary_report(spark, df, "s", ["A", "B", "C"]), "value") == [("A", 2, ["r1", "r2"]), ("B", 1, ["r3"]), ("C", 0, [])]
    assert tuple(audit.acceptance(spark.createDataFrame([("a", True), ("b", False)], "name string, ok boolean")).first()) == (2, 1, False)
    assert rows(audit.contiguity(spark.createDataFrame([(2,), (3,), (6,), (200_000,)], "s int"), "s"), "first_missing") == [(1, 1), (4, 5), (7, 199_999)]
    values = audit.metrics(df, {"rows": F.count(F.lit(1))})
    assert tuple(audit.described(values, {"rows": ("all rows", "df", "count")}).first()) == ("rows", "all rows", "df", "count", 3.0)


def test_search(spark):
    records = spark.createDataFrame([("1", "Café report", "open", "in Aleppo"), ("2", "Other", "closed", "text")], "id string, title string, status string, text string")
    index = search.index_rows(records, records.where("id = '2'"))
    assert index.count() == 3
    hits = search.search(index, search.matches("cafe", "search_text"), [F.col("id")])
    assert [(r.id, r.total) for r in hits.collect()] == [("1", 1)]
    points = spark.createDataFrame([("a", 1.0, 1.0), ("b", 5.0, 5.0)], "id string, x double, y double")
    assert search.nearest_marker(points, 4.0, 4.0).first().id == "b" and search.nearest_marker(points, 400.0, 4.0).count() == 0


def test_capture_payloads(spark):
    payload = json.dumps([["urlkey", "timestamp", "mimetype"], ["k", "2020", "text/html"], ["k", "2022", "application/pdf"], ["k", "2021", "text/html"]])
    df = spark.createDataFrame([(1, payload), (2, "[]"), (3, None)], "id int, p string")
    assert [r.capture["timestamp"] for r in readers.latest_capture(df, "id", "p").collect()] == ["2022"]
    assert sorted(r.capture["timestamp"] for r in readers.capture_rows(df, "id", "p", 1, ["text/html"]).collect()) == ["2021"]
    first = readers.capture_by_provider(spark.createDataFrame([(1, None, "b"), (2, "a", "b")], "id int, p1 string, p2 string"), "id", ["p1", "p2"])
    assert rows(first, "id") == [(1, "p2", "b"), (2, "p1", "a")]
    api = spark.createDataFrame([('[{"id": 1}, {"id": 2}]',), ('{"id": 3}',), ('{"x": 1}',), ("bad",)], "p string").select(readers.api_payload("p", "struct<id: int>").alias("a"))
    assert [r.a.id if r.a else None for r in api.collect()] == [1, 3, None, None]


def test_every_query_is_registered_with_a_callable():
    assert len(catalogue.QUERIES) > 50 and set(catalogue.ORACLES) <= set(catalogue.QUERIES)


RECORD_PAGE = """<!doctype html><html><head><title>Record</title><script type="application/ld+json">{"b": 1, "a": 2}</script></head><body><article>
  <div class="meta-block code"><h4>Incident Code</h4><p>TEST001</p></div>
  <div class="meta-block"><h4>Incident date</h4><p>June 19, 2017</p></div>
  <div class="meta-block location"><h4>Location</h4><p>الرقة, Raqqa, Syria</p></div>
  <div class="info-left"><h4>Geolocation</h4><p>35.9, 4239.00416</p></div>
  <div><h2>Assessment</h2><p>A narrative.</p><figure><img src="/m.jpg"><figcaption>A view</figcaption></figure></div>
  <div class="sources"><h2>Sources (1)</h2><ul><li><div><a href="https://example.org/report">Example</a></div>
    <div class="source-tags"><ul><li class="tag">Arabic</li></ul></div><div><a class="archive" href="https://web.archive.org/example">Archive</a></div></li></ul></div>
</article></body></html>"""


def test_record_pages(spark):
    from sedimenta.functions.values import coordinate_pair, parsed_date
    from sedimenta.operators.record_pages import parse_pages

    df = spark.createDataFrame([(1, bytearray(RECORD_PAGE.encode())), (2, None)], "id int, body binary")
    out = {r.id: r for r in parse_pages(df, "id", "body").collect()}
    page = out[1]
    fields = {f.label: f.value for f in page.fields}
    assert fields == {"Incident Code": "TEST001", "Incident date": "June 19, 2017", "Location": "الرقة, Raqqa, Syria", "Geolocation": "35.9, 4239.00416"}
    assert (page.sources_section_present, page.sources_declared, len(page.sources)) == (True, 1, 1)
    source = page.sources[0]
    assert (source.name, source.url, source.archive_url, source.tags) == ("Example", "https://example.org/report", "https://web.archive.org/example", ["Arabic"])
    assert [(m.kind, m.url, m.caption) for m in page.media] == [("image", "/m.jpg", "A view")] and page.json_ld == ['{"a": 2, "b": 1}']
    assert out[2].fields == [] and not out[2].sources_section_present
    cell = spark.createDataFrame([(fields["Geolocation"], fields["Incident date"])], "g string, d string").select(coordinate_pair("g").alias("p"), parsed_date("d").alias("d")).first()
    assert (cell.p.lon, cell.d) == (4239.00416, "2017-06-19")
    from sedimenta.operators.classify import coordinate_reasons

    assert spark.createDataFrame([("35.9", "4239.00416")], "a string, b string").select(coordinate_reasons("a", "b").alias("r")).first().r == ["invalid_longitude"]


def test_platform_answers(spark):
    long = "A post of some length that says a thing or two about what was seen there."
    rows = [("x", f'{{"html": "<blockquote><p>{long}</p></blockquote>", "author_name": "An Author"}}'), ("youtube", '{"title": "A video of the morning in the town", "author_name": "Chan"}'), ("facebook", f"<div><p>{long}</p></div>"), ("telegram", "<p>Log in to Facebook</p>"), ("x", "no json")]
    df = spark.createDataFrame(rows, "p string, b string")
    got = [tuple(r.t) for r in df.select(classify.platform_text("p", "b").alias("t")).collect()]
    assert got[0] == (long, "An Author", "full", True, "successful")
    assert got[1] == ("A video of the morning in the town\nChan", "Chan", "partial", True, "successful_partial")
    assert got[2][0] == long and got[2][4] == "successful"
    assert got[3][3] is False and got[3][4] is None and got[4][4] is None


def test_entities_beyond_the_bound_keep_their_pairs(spark):
    df = spark.createDataFrame([(i, "http://h/a" if i < 6 else "http://h/b") for i in range(8)], "id int, url string")
    got = {r.normalized_url: r for r in refs.roll_up_entities(df, "url", "id", "id", most=5).collect()}
    assert got["http://h/a"].n_references == 6 and got["http://h/a"].reference_ids is None and got["http://h/b"].reference_ids == [6, 7]
    assert refs.entity_references(df, "url", "id", "id").count() == 8


def test_overlaps_of_ranges_of_any_width(spark):
    import random

    rng = random.Random(4)
    jobs = [(rng.randrange(3), i, a, a + rng.choice([0, 1, 5, 900, 10**7])) for i in range(150) for a in [rng.randrange(10**6)]]
    want = {(k, min(i, j), max(i, j)) for k, i, a, b in jobs for k2, j, c, d in jobs if k == k2 and i < j and a <= d and b >= c}
    got = metrics.job_overlaps(spark.createDataFrame(jobs, "k int, j int, a bigint, b bigint"), "k", "j", "a", "b").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
