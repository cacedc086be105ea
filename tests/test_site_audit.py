"""The site validator against sites with one fault of each kind, and its links against a plain version."""

import html
import random
import re
from posixpath import normpath
from urllib.parse import unquote, urlsplit

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import site_audit

RULES = site_audit.SiteRules("2", "p1", required_fields=("record_id", "public_code"), provenance_fields=("place",), statuses=("successful", "blocked"), expected_cases=2)
RECORD = "record_id string, path string, public_code string, schema_version string, parser_version string, canonical_url string, completeness_status string, missing_sections array<string>, provenance array<string>, sources_section_present boolean, source_urls array<string>, media_urls array<string>, place string"
SOURCE = "source_id string, normalized_url string, content_hash string, status string, text_original string, text_translated string, duplicate_group string, record_ids array<string>"


def record(i, **more):
    own = {"record_id": i, "path": f"data/incidents/{i}.json", "public_code": f"c{i}", "schema_version": "2", "parser_version": "p1", "canonical_url": "https://a.org/1", "completeness_status": "complete", "missing_sections": [], "provenance": ["place"], "sources_section_present": True, "source_urls": ["https://b.org"], "media_urls": [], "place": "here"}
    return tuple((own | more)[c.split()[0]] for c in RECORD.split(", "))


def source(i, **more):
    own = {"source_id": i, "normalized_url": f"https://b.org/{i}", "content_hash": f"h{i}", "status": "successful", "text_original": "x", "text_translated": "", "duplicate_group": None, "record_ids": ["r1"]}
    return tuple((own | more)[c.split()[0]] for c in SOURCE.split(", "))


FILES = [
    ("cases/0001/index.html", "<a href='../0002/'>"), ("cases/0001/data.json", "{}"), ("cases/0002/index.html", "<a href='../../index.html?x=1#y'>"), ("cases/0002/data.json", "[1]"),
    ("pages/page-001.html", '<a data-href="/no" href="#top">'), ("index.html", '<a href="pages/page-001.html"><a href="mailto:a@b"><img src="m/a%20b.svg"><a href="cases/0001"><a href="HTTPS://a.org">'), ("m/a b.svg", None),
    ("data/incidents/r1.json", "{}"), ("data/incidents/r2.json", "{}"), ("sources/s1/index.html", "<p class=source-provenance>"), ("sources/s2/index.html", "source-provenance"),
]


def site(spark, records=(), sources=(), relationships=(), files=(), media=(), points=None, coverage=None, stored=()):
    made = lambda rows, schema: spark.createDataFrame(list(rows), schema).coalesce(1)
    return {
        "records": made([record("r1"), record("r2"), *records], RECORD),
        "sources": made([source("s1"), source("s2"), *sources], SOURCE),
        "relationships": made([("r1", "s1"), ("r1", "s2"), *relationships], "record_id string, source_id string"),
        "files": made([f for f in FILES if f[0] not in dict(files)] + [f for f in files if f[1] != "gone"], "path string, content string"),
        "media": made(media, "media_id string, local_path string, sha256 string"),
        "points": made([("r1", "35.0", "38.0")] if points is None else points, "record_id string, lat string, lon string"),
        "coverage": made([(1, 1, 2)] if coverage is None else coverage, "included int, excluded int, total int"),
        "stored": made([("data/raw/a.html",), *[(s,) for s in stored]], "path string"),
    }


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


#: Tables whose rules a change can touch.
BESIDE = {"records": ("records", "files"), "sources": ("sources", "relationships", "records"), "relationships": ("sources", "relationships", "records"), "media": ("media",), "points": ("points", "coverage"), "coverage": ("points", "coverage"), "files": ("files",), "stored": ("stored",)}


def codes(spark, **more):
    whole = site(spark, **more)
    tables = {k: v for k, v in whole.items() if not more or any(k in BESIDE[m] for m in more)}
    if "sources" in more:
        tables["files"] = whole["files"]
    return sorted((r.code, r.value) for r in site_audit.site_issues(tables, RULES).collect())


def test_sound_site_has_no_issue(spark):
    assert codes(spark) == []
    assert site_audit.site_verdict(site(spark), RULES).first().asDict() == {"critical": 0, "warning": 0, "info": 0, "unchecked": "", "passed": True}


@pytest.mark.parametrize(
    "more, want",
    [
        ({"records": [record("r1", path="z", public_code="cr1")]}, [("duplicate_internal_id", "r1")]),
        ({"records": [record("r2", path="z", public_code="cr1")]}, [("duplicate_internal_id", "r2"), ("duplicate_public_incident_code", "cr1")]),
        ({"records": [record(None, completeness_status=None)]}, [("duplicate_internal_id", ""), ("missing_internal_id", None)]),
        ({"records": [record("r3")]}, [("normalized_json_not_published", None)]),
        ({"files": [("data/incidents/r3.json", "{}")], "records": [record("r3", schema_version="1", parser_version=None, canonical_url="a.org", missing_sections=["x"], public_code="", provenance=None, source_urls=[], media_urls=["data:image/png;base64,AA", "m/a b.svg", "m/none.svg", "../x", ""])]},
         [("complete_record_missing_requirements", "public_code,x"), ("embedded_media_binary", None), ("empty_source_section", None), ("invalid_primary_source_url", "a.org"), ("missing_field_provenance", "place"), ("missing_local_media_file", "../x"), ("missing_local_media_file", "m/none.svg"), ("unexpected_parser_version", None), ("unexpected_schema_version", "1")]),
        ({"files": [("data/incidents/r3.json", "{}")], "records": [record("r3", source_urls=["ftp://x", "", "http://", None], missing_sections=None, media_urls=None)]}, [("invalid_source_url", "ftp://x"), ("invalid_source_url", "http://")]),
        ({"sources": [source("s2", normalized_url="https://b.org/s1", content_hash="h1")]}, [("duplicate_normalized_source_url", "https://b.org/s1"), ("duplicate_stable_source_id", "s2")]),
        ({"files": [("sources/s3/index.html", "bare")], "relationships": [("r1", "s3")], "sources": [source("s3", status="odd", text_translated=None, content_hash="hs1", duplicate_group="g")]}, [("source_page_missing_provenance", None), ("source_text_not_separated", None), ("unknown_source_retrieval_status", "odd"), ("unrecorded_exact_content_duplicate", "hs1")]),
        ({"sources": [source("s3", normalized_url=None, status=None, record_ids=["r2", "r9"])]}, [("duplicate_normalized_source_url", ""), ("missing_incident_source_relationship", "r2"), ("missing_incident_source_relationship", "r9"), ("missing_source_page", None), ("unknown_source_retrieval_status", None)]),
        ({"relationships": [("r1", "s1"), ("r8", "s1"), ("r1", None)]}, [("duplicate_incident_source_relationship", "r1|s1"), ("orphan_incident_source_relationship", "r1"), ("orphan_incident_source_relationship", "r8|s1")]),
        ({"media": [("m1", None, None), ("m2", "x", None)]}, [("media_placeholder_has_local_binary", None)]),
        ({"points": []}, [("map_point_count_mismatch", "1|0")]),
        ({"coverage": []}, [("missing_map_coverage_report", None)]),
        ({"coverage": [(1, 1, 3)], "points": [("r1", "95", "38")]}, [("invalid_coordinate_in_map", "r1|invalid_latitude"), ("map_coverage_total_mismatch", None)]),
        ({"files": [("cases/0002/data.json", "{"), ("cases/0009/data.json", "{"), ("pages/page-001.html", "gone"), ("index.html", "")]}, [("invalid_case_json", None), ("missing_pagination_page", None)]),
        ({"files": [("cases/0001/data.json", "gone"), ("cases/0001/index.html", "gone")]}, [("broken_internal_link", "cases/0001"), ("missing_case_json", None), ("missing_case_page", None)]),
        ({"files": [("index.html", "<a href=\"/x\"><a href='//'><a href='http:'><a href='../../x'><a HREF = 'none.html'><a href='//ok.org'>")]}, [("absolute_repository_root_path", "/x"), ("broken_internal_link", "none.html"), ("internal_link_escapes_site", "../../x"), ("invalid_external_url", "//"), ("invalid_external_url", "//ok.org"), ("invalid_external_url", "http:")]),
        ({"stored": ["data/raw/x.PNG", "a.png/b", "v.mp4"]}, [("committed_media_binary", None), ("committed_media_binary", None)]),
    ],
)
def test_one_fault_of_a_kind(spark, more, want):
    assert codes(spark, **more) == sorted(want, key=lambda x: (x[0], x[1] or ""))


def test_every_code_has_a_severity(spark):
    found = site_audit.site_issues(site(spark, records=[record("r1", path="z")], stored=["a.gif"]), RULES)
    assert found.where("severity is null").count() == 0 and {r.severity for r in found.collect()} == {"critical"}


def test_what_was_not_checked_does_not_pass(spark):
    whole = site(spark)
    part = site_audit.site_verdict({k: whole[k] for k in ("records", "sources")}, RULES).first()
    assert (part.critical, part.passed, part.unchecked) == (0, False, "files,internal_links,map,media,relationships")
    with pytest.raises(ValueError):
        site_audit.site_issues({}, RULES)


def test_empty_tables_and_other_columns(spark):
    whole = {k: v.limit(0) for k, v in site(spark).items()}
    assert sorted(r.code for r in site_audit.site_issues(whole, RULES).collect()) == ["missing_case_json"] * 2 + ["missing_case_page"] * 2 + ["missing_map_coverage_report", "missing_pagination_page"]
    clashing = {k: v.withColumns({c: F.lit(1) for c in ("code", "value", "severity", "n", "k", "p", "_have") if c not in v.columns}) for k, v in site(spark).items()}
    assert site_audit.site_issues(clashing, RULES).count() == 0


def plain_links(files):
    """What the validator says of each link, one page at a time."""
    known, out = {p for p, _ in files}, []
    folders = {p[: -len("/index.html")] for p in known if p.endswith("/index.html")}
    for path, text in files:
        for raw in re.findall(r"(?<![-\w])(?:href|src)\s*=\s*[\"']([^\"']+)[\"']", text or "", re.I) if path.endswith(".html") else []:
            v = html.unescape(raw.strip(" "))
            if not v or v.startswith("#"):
                continue
            if v.startswith("/") and not v.startswith("//"):
                out.append(("absolute_repository_root_path", path, v))
                continue
            u = urlsplit(v)
            if u.scheme or v.startswith("//"):
                sound = bool(u.path) if u.scheme in ("mailto", "tel") else u.scheme in ("http", "https") and bool(u.netloc)
                out += [] if sound else [("invalid_external_url", path, v)]
                continue
            if not u.path:
                continue
            way = normpath("/".join(["root", *path.split("/")[:-1], unquote(u.path)]))
            if not (way == "root" or way.startswith("root/")):
                out.append(("internal_link_escapes_site", path, v))
                continue
            target = "index.html" if way == "root" else way[5:] + ("/index.html" if unquote(u.path).endswith("/") or way[5:] in folders else "")
            if target not in known:
                out.append(("broken_internal_link", path, v))
    return sorted(out)


def test_links_against_a_plain_version(spark):
    rng = random.Random(11)
    words = ["a", "b", "a%20b", "..", ".", "index.html", "c.html", "", "x+y", "?q=1", "#f", "&amp;"]
    links = lambda: "".join(f"<a {rng.choice(['href', 'SRC', 'data-href'])}={rng.choice(['', ' '])}\"{rng.choice(['', '', '', '/', '//h.org/', 'http://', 'https://h.org/', 'mailto:', 'tel:1', 'javascript:x', '#'])}{'/'.join(rng.choice(words) for _ in range(rng.randrange(5)))}\">" for _ in range(6))
    paths = ["index.html", "a/index.html", "a/b/index.html", "a/c.html", "a b/index.html", "x+y/c.html", "b/c.html", "c.html", "a/b/c.html"]
    for _ in range(4):
        files = [(p, links()) for p in paths] + [("data.json", links()), ("a/empty.html", ""), ("a/null.html", None)]
        got = [df.collect() for df in site_audit.link_issues({"files": spark.createDataFrame(files, "path string, content string")})]
        assert sorted((r.code, r.path, r.value) for rows in got for r in rows) == plain_links(files)
