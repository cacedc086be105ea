import pytest
from pyspark.sql import functions as F

from sedimenta.functions import text, urls, values
from sedimenta.operators import classify


def one(spark, column, **cells):
    row = spark.createDataFrame([tuple(cells.values())], ", ".join(f"`{k}` {'string' if not isinstance(v, tuple) else v[1]}" for k, v in cells.items())) if not any(isinstance(v, tuple) for v in cells.values()) else None
    if row is None:
        row = spark.createDataFrame([tuple(v[0] if isinstance(v, tuple) else v for v in cells.values())], ", ".join(f"`{k}` {v[1] if isinstance(v, tuple) else 'string'}" for k, v in cells.items()))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("url", "normalized", "status", "reason", "domain"),
    [
        ("HTTPS://Example.COM:443/a?b=1#fragment", "https://example.com/a?b=1", "normalized", "transport_syntax_normalized", "example.com"),
        ("http://www.a.org/x", "http://www.a.org/x", "unchanged", "", "a.org"),
        ("http://user:pw@A.org.:8080", "http://a.org:8080/", "normalized", "transport_syntax_normalized", "a.org"),
        ("not a url", "not a url", "malformed", "unsupported_or_missing_scheme", ""),
        ("ftp://a.org/x", "ftp://a.org/x", "malformed", "unsupported_or_missing_scheme", ""),
        ("http:///x", "http:///x", "malformed", "missing_hostname", ""),
        ("http://a.org:99999/", "http://a.org:99999/", "malformed", "ValueError:Port out of range 0-65535", ""),
        ("  ", "", "missing", "empty_url", ""),
        (None, "", "missing", "empty_url", ""),
    ],
)
def test_normalize_url(spark, url, normalized, status, reason, domain):
    got = one(spark, urls.normalize_url("u"), u=url)
    assert (got.normalized, got.status, got.reason, got.domain, got.raw) == (normalized, status, reason, domain, url or "")


def test_ids_of_equal_urls(spark):
    assert one(spark, urls.source_id("u"), u="HTTPS://Example.COM:443/a?b=1#f") == one(spark, urls.source_id("u"), u="https://example.com/a?b=1")
    assert one(spark, urls.source_id("u"), u="x").startswith("source-") and len(one(spark, urls.source_id("u"), u="x")) == 31
    assert one(spark, urls.internal_id("c", "s"), c="CS123", s="7") == "record-123"
    assert one(spark, urls.internal_id("c", "s"), c="none", s="7") == "legacy-seq-0007"


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("https://www.example.org/article?s=section&t=edition&ref=primary&utm_source=campaign", "https://example.org/article?s=section&t=edition&ref=primary"),
        ("https://twitter.com/u/status/1?s=20&t=abc", "https://x.com/u/status/1"),
        ("https://mobile.twitter.com/u", "https://x.com/u"),
        ("http://a.org:8080/?q=a%20b&empty=&FBCLID=1", "http://a.org/?q=a+b&empty="),
        ("plain", "plain"),
    ],
)
def test_fetch_key(spark, url, key):
    assert one(spark, urls.fetch_key("u"), u=url) == key


def test_proxies_and_platforms(spark):
    assert one(spark, urls.unwrap_proxy("u"), u="https://translate.google.com/translate?sl=ar&u=https%3A%2F%2FA.org%2Fx") == "https://a.org/x"
    assert one(spark, urls.unwrap_proxy("u"), u="https://my--site-example-org.translate.goog/x?y=1") == "https://my-site.example.org/x"
    assert "publish.twitter.com" in one(spark, urls.platform_endpoints("u"), u="https://x.com/a/status/1")
    assert one(spark, urls.platform_endpoints("u"), u="https://a.org") is None
    assert one(spark, urls.is_archive_host("u"), u="https://web.archive.org/web/1/x") is True
    assert one(spark, urls.archive_path("u"), u="https://archive.ph/wip/abc") == "https://archive.ph/abc"
    assert one(spark, urls.archive_key("u"), u=(["http://a.org", "https://archive.ph/x"], "array<string>")) == "archive.ph"
    assert one(spark, urls.archive_key("u"), u=([], "array<string>")) == "web.archive.org"
    assert one(spark, urls.domain_allowed("u", ["a.org"]), u="http://b.a.org/") is True
    assert one(spark, urls.domain_allowed("u", ["a.org"]), u="http://ba.org/") is False
    assert one(spark, urls.urls_in("u"), u="see https://a.org/x, (http://b.org/y).") == ["https://a.org/x", "http://b.org/y"]


@pytest.mark.parametrize(
    ("url", "publisher", "kind"),
    [
        ("https://m.facebook.com/x", None, "public_facebook_post"),
        ("https://youtu.be/x", None, "youtube_page"),
        ("https://a.org/f.PDF", None, "pdf_document"),
        ("https://a.org/f.jpeg?x=1", None, "direct_image_url"),
        ("https://a.org/f.mp4", None, "direct_video_url"),
        ("https://family.org/", None, "government_or_military_statement"),
        ("https://a.org/", "Amnesty", "ngo_report"),
        ("https://x.wordpress.com/", None, "blog_post"),
        ("https://daily-news.org/", None, "news_article"),
        ("https://a.org/", None, "other_web_page"),
        ("nothing", None, "unknown"),
    ],
)
def test_source_type(spark, url, publisher, kind):
    assert one(spark, urls.source_type("u", "p"), u=url, p=publisher) == kind


def test_clean_text(spark):
    assert one(spark, text.clean_text("t"), t=" a  b\r\nc\t \td\n\n\n\n e  f\x0bg ") == "a b\nc d\n\ne\nf\ng"
    assert one(spark, text.clean_text("t"), t=None) == ""
    assert one(spark, text.clean_text("t"), t="a" + "\u3000" * 100_000 + "\nb" + "\u3000" * 100_000 + "c").startswith("a\nb\u3000")


def test_same_value(spark):
    for a, b, same in [(None, "", True), ("1.0", "1.00000001", True), ("1", "2", False), (" A  b", "a b", True), ("x", None, False)]:
        assert one(spark, text.same_value("a", "b"), a=a, b=b) is same


def test_folds(spark):
    assert one(spark, text.search_fold("t"), t="ﬁ  Café ÀÉ") == "fi cafe ae"
    assert one(spark, text.search_fold("t"), t="إسلامى مدرسة مُحَمَّد") == "اسلامي مدرسه محمد"
    assert one(spark, text.casefold("t"), t="Straße") == "strasse"
    assert one(spark, text.search_text("a", "b"), a="Über", b=None) == "uber"


@pytest.mark.parametrize(
    ("body", "label", "code"),
    [("مرحبا بالعالم", None, "ar"), ("שלום עולם", None, "he"), ("Привет мир", None, "ru"), ("hello world", None, "en"), ("123 !", None, "und"), ("日本語", None, "und"), ("x", "Modern Arabic", "ar"), ("x", "fr", "fr"), (None, None, "und")],
)
def test_language(spark, body, label, code):
    assert one(spark, text.detect_language("t", "l"), t=body, l=label) == code


@pytest.mark.parametrize(
    ("body", "kind", "accepted", "score", "reasons"),
    [
        ("Log in to Facebook to start sharing and connecting with your friends", "public_facebook_post", False, 30, ["access_or_platform_shell"]),
        ("مرحبا بكم في صفحتنا", "public_facebook_post", True, 100, []),
        ("short", "news_article", False, 45, ["text_too_short"]),
        ("word " * 40, "news_article", False, 55, ["highly_repetitive_text"]),
        ("captcha", "", False, 0, ["text_too_short", "access_or_platform_shell"]),
        ("x captcha " + "different words here and there " * 3 + " ".join(f"w{i}" for i in range(500)), "", True, 100, []),
    ],
)
def test_quality(spark, body, kind, accepted, score, reasons):
    got = one(spark, text.content_quality("t", None, "k"), t=body, k=kind)
    assert (got.accepted, got.score, got.reasons) == (accepted, score, reasons)


def test_chunks_lose_nothing(spark):
    body = "first\n\n" + "x" * 8000 + "\n\nlast one"
    got = one(spark, text.text_chunks("t", 1000), t=body)
    assert len(got) > 2 and max(map(len, got)) <= 1000
    assert "".join(got).replace("\n", "") == body.replace("\n", "")
    assert one(spark, text.text_chunks("t", 100), t="a\n\nb\n\nc") == ["a\n\nb\n\nc"]
    assert one(spark, text.text_chunks("t", 100), t=None) == []


def test_small_text_functions(spark):
    assert one(spark, text.slug("t"), t="https://a.org/x/My Page_1/?q") == "my-page-1"
    assert one(spark, text.declared_count("t"), t="Sources (1,234)") == 1234
    assert one(spark, text.escape_html("t"), t="<a b=\"c\">&'") == "&lt;a b=&quot;c&quot;&gt;&amp;&#x27;"
    assert one(spark, text.strip_input_marker("t"), t=" [input] x") == "x"
    assert one(spark, text.strip_tags("t"), t="<p>a &amp; b</p><script>no</script>c<br>d") == "a & b\nc\nd"
    assert one(spark, text.repair_mojibake("t"), t="CafÃ©\nok") == "Café\nok"
    assert one(spark, text.unique_paragraphs("t"), t=(["A b", " a  B ", "c", ""], "array<string>")) == "A b\n\nc"
    assert one(spark, text.capture_text("a", "b"), a="x" * 30, b="y" * 50) == "y" * 50
    assert one(spark, text.capture_text("a", "b"), a="please log in now to go on reading", b="") is None
    assert text.decode_bytes("مرحبا".encode("windows-1256"), "text/html; charset=windows-1256") == "مرحبا"
    assert text.decode_bytes("é".encode(), None) == "é"


def test_values(spark):
    for raw, number in [("1.5", 1.5), (" 2 ", 2.0), ("NaN", None), ("inf", None), ("x", None), (None, None), ("1e400", None)]:
        assert one(spark, values.as_number("v"), v=raw) == number
    assert one(spark, values.first_present("a", "b"), a="", b="x") == "x"
    assert one(spark, values.missing_names(code=F.col("a"), place=F.col("b")), a="", b="x") == ["code"]
    pair = one(spark, values.coordinate_pair("v"), v="at 35.9, 4239.00416 or so")
    assert (pair.lat, pair.lon) == (35.9, 4239.00416)
    assert one(spark, values.coordinate_pair("v"), v="35.9") is None
    for raw, day in [("on 2017-06-19 at", "2017-06-19"), ("June 19, 2017", "2017-06-19"), ("19 June 2017", "2017-06-19"), ("Jun 9, 2017", "2017-06-09"), ("some day", "some day"), (None, None)]:
        assert one(spark, values.parsed_date("v"), v=raw) == day
    assert one(spark, values.clock("v"), v=(3725.9, "double")) == "01:02:05"
    now = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    assert one(spark, values.retry_after("v", now), v="300") == 120.0
    assert one(spark, values.retry_after("v", now), v="Mon, 1 Jan 2024 00:00:30 GMT") == 30.0
    assert one(spark, values.retry_after("v", now), v="soon") in (None, 0.0)
    assert one(spark, values.backoff("v", 8), v=(5, "int")) == 8.0
    assert one(spark, values.sequence_numbers("v"), v="1,4,480-482,4") == [1, 4, 480, 481, 482]
    assert one(spark, values.sorted_unique("v"), v=(["b", "a", "b"], "array<string>")) == ["a", "b"]
    assert one(spark, values.percent(F.lit(1), F.lit(0)), v="x") == 0.0
    f = F.lit(False)
    for reason, seconds in [("not_found", 604800), ("login_required", 43200), ("other", 21600)]:
        assert one(spark, values.retry_seconds(f, F.lit(reason), f, f), v="x") == seconds
    assert one(spark, values.retry_seconds(f, F.lit("x"), f, F.lit(True)), v="x") == 900


@pytest.mark.parametrize(("status", "error", "result"), [(403, None, "BLOCKED"), (404, None, "DEAD"), (200, None, "FETCHED"), (503, None, "RETRYABLE_FAILURE"), (None, "TimeoutError: timed out", "RETRYABLE_FAILURE"), (418, None, "FINAL_FAILURE"), (None, None, "FINAL_FAILURE")])
def test_http_result(spark, status, error, result):
    assert one(spark, classify.http_result("s", "e"), s=(status, "int"), e=error) == result


@pytest.mark.parametrize(
    ("lat", "lon", "kind", "reasons"),
    [
        (None, None, "missing", ["missing_latitude", "missing_longitude"]),
        ("35.9", "4239.0", "malformed", ["invalid_longitude"]),
        ("not-a-number", "36", "malformed", ["invalid_latitude", "parsing_error"]),
        ("36.6", "45", "outside_accepted_range", ["outside_expected_region"]),
        ("35.9", "36.0", "drawable", []),
        ("31", "43", "drawable", []),
    ],
)
def test_coordinates(spark, lat, lon, kind, reasons):
    assert one(spark, classify.coordinate_class("a", "b"), a=lat, b=lon) == kind
    assert one(spark, classify.coordinate_reasons("a", "b"), a=lat, b=lon) == reasons


TRUTH = [
    # text, accepted, completeness, method, kind, provenance, statuses, title -> status, reason
    (None, False, None, None, "news_article", None, [], "T", "METADATA_ONLY", "empty_text"),
    ("text " * 30, True, "partial", "semantic_dom", "news_article", "live", [], "T", "PARTIAL_TEXT", "legacy_quality_not_full"),
    ("text " * 30, True, "full", "semantic_dom", "public_x_post", "x_oembed", [], "T", "FULL_TEXT_DIRECT", "structured_extractor_validated"),
    ("text " * 30, True, "full", "semantic_dom", "public_x_post", "listed_archive", [], "T", "FULL_TEXT_ARCHIVED", "structured_extractor_validated"),
    ("Log in to Facebook " * 5, True, "full", "trafilatura", "public_facebook_post", "source_live", [], "T", "PARTIAL_TEXT", "facebook_login_shell"),
    ("text " * 30, True, "full", "trafilatura", "news_article", "local_snapshot", [], None, "FULL_TEXT_LOCAL_SNAPSHOT", "main_text_extractor_validated"),
    ("text " * 30, True, "full", "other", "news_article", "live", [], None, "PARTIAL_TEXT", "completeness_not_independently_established"),
    (None, False, None, None, "news_article", None, [403], "T", "BLOCKED", "empty_text"),
    (None, False, None, None, "news_article", None, [404], None, "DEAD", "empty_text"),
    (None, False, None, None, "news_article", None, [], None, "URL_PRESERVED", "empty_text"),
]


@pytest.mark.parametrize("case", TRUTH)
def test_source_truth(spark, case):
    body, accepted, whole, method, kind, provenance, statuses, title, status, reason = case
    schema = "text string, accepted boolean, whole string, method string, kind string, provenance string, statuses array<int>, title string"
    row = spark.createDataFrame([(body, accepted, whole, method, kind, provenance, statuses, title)], schema)
    check = classify.full_text_check("text", "accepted", "whole", "method", "kind", "provenance")
    reach = classify.reachability(F.lit(""), "statuses", F.array().cast("array<string>"))
    found = row.select(check.alias("c"), classify.content_status("text", check["passed"], F.lit("http://a.org/"), reach, ~values.is_missing("title"), "provenance", F.lit(None).cast("string")).alias("s"), reach.alias("r")).first()
    assert (found.c.reason, found.s) == (reason, status)
    if 403 in statuses:
        assert found.r == "BLOCKED"


def test_other_classifiers(spark):
    lit = F.lit
    assert one(spark, classify.direct_verification(lit(False), lit(403)), v="x") == "BLOCKED_HTTP_403"
    assert one(spark, classify.record_origin(lit(False), lit(True)), v="x") == "mixed_historical_and_archived"
    assert one(spark, classify.fetch_failure(lit(410)), v="x") == "gone"
    assert one(spark, classify.resolution(lit("cached")), v="x") == "content_resolved"
    none = F.array().cast("array<int>")
    status = lambda **k: classify.completeness_status(**({"conflicts": lit(0), "encoding_review": lit(False), "extracted": lit(True), "missing": lit(0), "any_ok": lit(True), "statuses": none, "circuit_statuses": none} | k))
    for change, want in [
        ({}, "complete"),
        ({"conflicts": lit(1)}, "conflicting_sources"),
        ({"encoding_review": lit(True)}, "pending_review"),
        ({"missing": lit(1)}, "partial"),
        ({"extracted": lit(False), "any_ok": lit(False), "statuses": F.array(lit(404), lit(404))}, "unavailable"),
        ({"extracted": lit(False), "any_ok": lit(False), "circuit_statuses": F.array(lit(403))}, "blocked"),
        ({"extracted": lit(False), "any_ok": lit(False)}, "failed"),
        ({"extracted": lit(False)}, "partial"),
    ]:
        assert one(spark, status(**change), v="x") == want
    for body, mime, url, kind in [(b"%PDF-1", "", "", "pdf"), (b"PK\x03\x04x", "", "", "office_open_xml"), (b" <!DOCTYPE html><p>", "", "", "html"), (b"{}", "", "", "json"), (b"a,b", "text/csv; x", "", "csv"), (b"a", "", "http://a.org/x.txt", "text"), (b"<rss>", "", "", "xml"), (b"\x00", "", "", "unsupported")]:
        assert one(spark, classify.body_format("b", "m", "u"), b=(bytearray(body), "binary"), m=mime, u=url) == kind
