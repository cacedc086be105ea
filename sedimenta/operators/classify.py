"""Classifiers: each gives exactly one class, by the first rule that holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions import fixed
from sedimenta.functions.text import clean_text, content_quality, strip_tags
from sedimenta.functions.urls import normalize_url
from sedimenta.functions.values import ColumnLike, as_number, case, col, contains_any, first_present, is_missing, let


def _or_null(c: ColumnLike | None) -> Column:
    return F.lit(None) if c is None else col(c)


def _lower(c: ColumnLike | None) -> Column:
    return F.lower(F.coalesce(_or_null(c).cast("string"), F.lit("")))


def http_result(status: ColumnLike, error: ColumnLike | None = None) -> Column:
    """What a fetch came to, by its status and error text. No status between is a success: 403 never is."""
    s, e = col(status).cast("int"), _lower(error)
    return case(
        ((s >= 200) & (s < 300), "FETCHED"),
        (s.isin(*fixed.BLOCKED_HTTP), "BLOCKED"),
        (s.isin(*fixed.DEAD_HTTP), "DEAD"),
        (s >= 500, "RETRYABLE_FAILURE"),
        (contains_any(e, ["timeout", "timed out", "tempor"]), "RETRYABLE_FAILURE"),
        otherwise="FINAL_FAILURE",
    )


def fetch_failure(status: ColumnLike, error: ColumnLike | None = None) -> Column:
    s, e = col(status).cast("int"), _lower(error)
    return case(
        (s == 404, "not_found"),
        (s == 410, "gone"),
        (s == 401, "login_required"),
        (s.isin(403, 429, 451), "blocked"),
        (contains_any(e, ["timeout", "timed out"]), "timed_out"),
        otherwise="unavailable",
    )


def in_world(lat: Column, lon: Column) -> Column:
    return lat.between(-90, 90) & lon.between(-180, 180)


def in_region(lat: Column, lon: Column) -> Column:
    return lat.between(*fixed.REGION["lat"]) & lon.between(*fixed.REGION["lon"])


def coordinate_class(lat: ColumnLike, lon: ColumnLike) -> Column:
    """missing, malformed, outside_accepted_range or drawable."""
    kind = lambda y, x: case(
        (is_missing(lat) | is_missing(lon), "missing"),
        (y.isNull() | x.isNull() | ~in_world(y, x), "malformed"),
        (~in_region(y, x), "outside_accepted_range"),
        otherwise="drawable",
    )
    return let(as_number(lat), lambda y: let(as_number(lon), lambda x: kind(y, x)))


def coordinate_reasons(lat: ColumnLike, lon: ColumnLike, with_parsing: bool = True) -> Column:
    """All faults in order: latitude's, longitude's, and the region only if there are none before."""
    y, x = as_number(lat), as_number(lon)

    def faults(raw: ColumnLike, value: Column, name: str, most: int) -> Column:
        unread = F.array(F.lit(f"invalid_{name}"), F.lit("parsing_error")) if with_parsing else F.array(F.lit(f"invalid_{name}"))
        return case(
            (is_missing(raw), F.array(F.lit(f"missing_{name}"))),
            (value.isNull(), unread),
            (~value.between(-most, most), F.array(F.lit(f"invalid_{name}"))),
            otherwise=F.array().cast("array<string>"),
        )

    found = F.array_distinct(F.concat(faults(lat, y, "latitude", 90), faults(lon, x, "longitude", 180)))
    return F.when((F.size(found) == 0) & ~in_region(y, x), F.array(F.lit("outside_expected_region"))).otherwise(found)


def reachability(retrieval: ColumnLike, statuses: ColumnLike, evidence: ColumnLike) -> Column:
    """By the retrieval status, then all HTTP statuses seen, then the words of all errors.

    statuses is an array of numbers, evidence an array of texts; json_values() collects both from nested attempts.
    """
    kept = [*fixed.RESOLVED_STATUSES, *fixed.POLICY_COMPLETE_STATUSES]
    seen = F.coalesce(col(statuses), F.array().cast("array<int>"))
    words = F.lower(F.array_join(F.coalesce(col(evidence), F.array().cast("array<string>")), " "))
    any_of = lambda group: F.exists(seen, lambda s: s.isin(*group))
    r = F.coalesce(col(retrieval), F.lit(""))
    return case(
        (r.isin(*kept), "FETCHED"),
        (any_of(fixed.BLOCKED_HTTP), "BLOCKED"),
        (any_of(fixed.DEAD_HTTP), "DEAD"),
        (contains_any(words, fixed.BLOCKED_WORDS), "BLOCKED"),
        (contains_any(words, fixed.RETRY_WORDS), "RETRYABLE_FAILURE"),
        (r == "recovery_deferred", "NEEDS_MANUAL_REVIEW"),
        otherwise="DISCOVERED",
    )


def full_text_check(text: ColumnLike, accepted: ColumnLike, completeness: ColumnLike, method: ColumnLike, kind: ColumnLike, provenance: ColumnLike) -> Column:
    """passed and reason: whether a text is known to be whole."""
    t = F.coalesce(col(text), F.lit(""))
    m, k, p = (F.coalesce(col(c), F.lit("")) for c in (method, kind, provenance))
    structured = reduce(lambda a, b: a | b, [m.startswith(s) for s in ("semantic_dom", "jsonld:", "embedded:json:", "pypdf", "json_text_fallback")])
    article = (m == "trafilatura") & k.isin("news_article", "blog_post", "government_or_military_statement", "ngo_report") & (F.length(t) >= 100)
    post = (m == "trafilatura") & (k == "public_facebook_post") & p.isin("facebook_public_embed", "source_live") & (F.length(t) >= 20)
    reason = case(
        (F.trim(t) == "", "empty_text"),
        (~(F.coalesce(col(accepted), F.lit(False)) & (F.coalesce(col(completeness), F.lit("")) == "full")), "legacy_quality_not_full"),
        *[(t.rlike(pattern), name) for name, pattern in fixed.SHELL_PATTERNS],
        (structured, "structured_extractor_validated"),
        (article, "main_text_extractor_validated"),
        (post, "public_post_text_validated"),
        otherwise="completeness_not_independently_established",
    )
    return F.struct(reason.endswith("_validated").alias("passed"), reason.alias("reason"))


def content_status(text: ColumnLike, full: Column, url: ColumnLike, reach: Column, has_metadata: Column, provenance: ColumnLike, preservation: ColumnLike) -> Column:
    """The one primary status of a source's content."""
    p = F.lower(F.coalesce(col(provenance), F.lit("")))
    local = p.isin("existing_preserved_text", "local_snapshot", "historical_local") | (F.coalesce(col(preservation), F.lit("")) == "existing_text_preserved")
    link = normalize_url(url)
    has_text = ~is_missing(text)
    return case(
        (has_text & ~full, "PARTIAL_TEXT"),
        (has_text & contains_any(p, ["archive", "wayback"]), "FULL_TEXT_ARCHIVED"),
        (has_text & local, "FULL_TEXT_LOCAL_SNAPSHOT"),
        (has_text, "FULL_TEXT_DIRECT"),
        (link["status"] == "malformed", "MALFORMED"),
        (reach == "BLOCKED", "BLOCKED"),
        (reach == "DEAD", "DEAD"),
        (has_metadata, "METADATA_ONLY"),
        (reach.isin("RETRYABLE_FAILURE", "NEEDS_MANUAL_REVIEW"), "NEEDS_MANUAL_REVIEW"),
        (link["normalized"] != "", "URL_PRESERVED"),
        otherwise="REFERENCE_ONLY",
    )


def direct_verification(ok: ColumnLike, status: ColumnLike, circuit_status: ColumnLike | None = None) -> Column:
    s, c = F.coalesce(col(status).cast("int"), F.lit(0)), F.coalesce(_or_null(circuit_status).cast("int"), F.lit(0))
    return case((F.coalesce(col(ok), F.lit(False)), "SUCCESS"), ((s == 403) | (c == 403), "BLOCKED_HTTP_403"), (s.isin(*fixed.DEAD_HTTP), "DEAD"), otherwise="OTHER")


def record_origin(direct_ok: Column, archive_ok: Column) -> Column:
    return case((direct_ok, "mixed_historical_and_direct"), (archive_ok, "mixed_historical_and_archived"), otherwise="historical_snapshot")


def completeness_status(conflicts: Column, encoding_review: Column, extracted: Column, missing: Column, any_ok: Column, statuses: Column, circuit_statuses: Column) -> Column:
    """conflicting > pending > complete > partial > why nothing came. missing counts fields and sections."""
    known = F.filter(statuses, lambda s: s.isNotNull())
    return case(
        (conflicts > 0, "conflicting_sources"),
        (encoding_review, "pending_review"),
        (extracted & (missing == 0), "complete"),
        (extracted, "partial"),
        (~any_ok & (F.size(known) > 0) & F.forall(known, lambda s: s == 404), "unavailable"),
        (~any_ok & F.exists(F.concat(known, circuit_statuses), lambda s: s == 403), "blocked"),
        (~any_ok, "failed"),
        otherwise="partial",
    )


def missing_sections(narrative: ColumnLike, has_sources_section: Column, api_sources: Column, declared: Column, extracted: Column) -> Column:
    sources = (~has_sources_section & (api_sources == 0)) | (F.coalesce(declared, F.lit(0)) > extracted)
    return F.array_compact(F.array(F.when(is_missing(narrative), "narrative"), F.when(sources, "sources")))


def resolution(status: ColumnLike) -> Column:
    s = F.coalesce(col(status), F.lit(""))
    return case((s.isin(*fixed.RESOLVED_STATUSES), "content_resolved"), (s.isin(*fixed.POLICY_COMPLETE_STATUSES), "policy_complete"), (s == "recovery_deferred", "recovery_deferred"), otherwise="operational_error")


def body_format(body: ColumnLike, content_type: ColumnLike, url: ColumnLike, kind: ColumnLike | None = None) -> Column:
    """By the first bytes, the media type and the suffix."""
    head = F.hex(F.substring(col(body), 1, 64))
    start = F.lower(F.regexp_replace(F.decode(F.substring(col(body), 1, 64), "ISO-8859-1"), r"^\s+", ""))
    mime = F.lower(F.trim(F.substring_index(F.coalesce(col(content_type), F.lit("")), ";", 1)))
    path = F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1))
    suffix = F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)
    return case(
        (head.startswith("255044462D") | mime.contains("pdf") | (_lower(kind) == "pdf_document"), "pdf"),
        (head.startswith("504B0304") | suffix.isin(".docx", ".xlsx", ".pptx"), "office_open_xml"),
        (mime.isin("application/json", "application/ld+json", "application/geo+json") | (suffix == ".json"), "json"),
        (mime.isin("application/xml", "text/xml", "application/rss+xml", "application/atom+xml") | suffix.isin(".xml", ".rss", ".atom"), "xml"),
        (mime.contains("html") | start.startswith("<!doctype html") | start.startswith("<html"), "html"),
        (mime.isin("text/csv", "application/csv") | (suffix == ".csv"), "csv"),
        ((mime == "text/tab-separated-values") | (suffix == ".tsv"), "tsv"),
        (mime.startswith("text/") | suffix.isin(".txt", ".md", ".markdown", ".log"), "text"),
        (start.startswith("{") | start.startswith("["), "json"),
        (start.startswith("<"), "xml"),
        otherwise="unsupported",
    )


def is_login_wall(text: ColumnLike) -> Column:
    return contains_any(F.lower(F.coalesce(col(text), F.lit(""))), fixed.LOGIN_WALL_MARKERS)


def has_text(text: ColumnLike, variants: ColumnLike) -> Column:
    """A text of its own, or a variant with one. variants is an array of structs with a text."""
    return ~is_missing(text) | F.coalesce(F.exists(col(variants), lambda v: ~is_missing(v["text"])), F.lit(False))


def has_archived_text(variants: ColumnLike) -> Column:
    held = lambda v: ~is_missing(v["text"]) & contains_any(F.lower(F.coalesce(v["provenance"], F.lit(""))), ["archive", "wayback"])
    return F.coalesce(F.exists(col(variants), held), F.lit(False))


def policy_complete(status: ColumnLike) -> Column:
    return F.coalesce(col(status), F.lit("")).isin(*fixed.POLICY_COMPLETE_STATUSES)


def summary_columns(record: dict[str, ColumnLike]) -> list[Column]:
    """A record's summary: its columns under their names, its number in four digits and its page's path."""
    number = F.lpad(F.coalesce(col(record["sequence"]).cast("string"), F.lit("0")), 4, "0")
    return [*[col(c).alias(name) for name, c in record.items()], number.alias("number"), F.concat(F.lit("incidents/"), number, F.lit("/")).alias("path")]


def title_of(*candidates: ColumnLike) -> Column:
    return first_present(*candidates, F.lit("Untitled"))


def platform_text(platform: ColumnLike, body: ColumnLike) -> Column:
    """What a platform's public answer says of a post: text, author, completeness, accepted and status.

    platform is x, youtube, facebook or telegram. The first two answer with an object (oEmbed): a post's fragment, or a
    title, which is only partial. The others answer with a page. A text that isn't good enough gives the status null.
    """
    answer = F.from_json(col(body), "struct<html: string, title: string, author_name: string>")
    p = col(platform)
    title = F.array_join(F.array_compact(F.array(answer["title"], answer["author_name"])), "\n")
    text = clean_text(case((p == "x", strip_tags(answer["html"])), (p == "youtube", title), otherwise=strip_tags(body)))
    partial = p == "youtube"
    quality = content_quality(text, None, F.lit("public_post"))
    accepted = quality["accepted"] & (text != "")
    status = F.when(accepted, F.when(partial, "successful_partial").otherwise("successful"))
    author = F.when(p.isin("x", "youtube"), clean_text(answer["author_name"]))
    return F.struct(text.alias("text"), author.alias("author"), F.when(partial, "partial").otherwise("full").alias("completeness"), accepted.alias("accepted"), status.alias("status"))
