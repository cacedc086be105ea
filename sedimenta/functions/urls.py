"""URL identity: three normalisers of increasing reach, ids, kinds of sources, and hosts.

The syntax is taken apart by one regular expression, as Spark's parse_url raises on bad input and keeps case and port.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import parse_qsl, urlencode

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sedimenta.functions import fixed
from sedimenta.functions.values import ColumnLike, case, col, contains_any, let

#: Scheme, host, port, path and query of an HTTP URL.
PARTS = r"^([Hh][Tt][Tt][Pp][Ss]?)://(?:[^/?#@]*@)?([^/?#:@]+)(?::([0-9]*))?(/[^?#]*)?(\?[^#]*)?(#.*)?$"


def _raw(url: ColumnLike) -> Column:
    return F.coalesce(col(url).cast("string"), F.lit(""))


def _trimmed(url: ColumnLike) -> Column:
    return F.regexp_replace(_raw(url), r"(?U)^\s+|(?<!\s)\s+$", "")


def _part(value: Column, group: int) -> Column:
    return F.regexp_extract(value, PARTS, group)


def _host(value: Column) -> Column:
    return F.regexp_replace(F.lower(_part(value, 2)), r"\.$", "")


def _port(value: Column) -> Column:
    return F.coalesce(F.nullif(_part(value, 3), F.lit("")).try_cast("bigint"), F.lit(-1))


def _taken_apart(v: Column) -> Column:
    """An HTTP URL's parts; whole says whether it has them."""
    return F.struct(
        v.alias("v"),
        v.rlike(PARTS).alias("whole"),
        F.lower(_part(v, 1)).alias("scheme"),
        _host(v).alias("host"),
        _port(v).alias("port"),
        _part(v, 4).alias("path"),
        _part(v, 5).alias("query"),
    )


def _joined(p: Column) -> Column:
    default = (p["port"] < 0) | ((p["scheme"] == "http") & (p["port"] == 80)) | ((p["scheme"] == "https") & (p["port"] == 443))
    port = F.when(default, "").otherwise(F.concat(F.lit(":"), p["port"].cast("string")))
    return F.concat(p["scheme"], F.lit("://"), p["host"], port, F.when(p["path"] == "", "/").otherwise(p["path"]), p["query"])


def normalize_url(url: ColumnLike) -> Column:
    """raw, normalized, status, reason and domain. The fragment and a default port go; nothing else of the identity does."""

    def judged(p: Column) -> Column:
        v = p["v"]
        http, ported = v.rlike(r"^(?i)https?:"), p["whole"] & (p["port"] > 65535)

        def named(joined: Column) -> Column:
            status = case((v == "", "missing"), (~http | ~p["whole"] | ported, "malformed"), (joined == v, "unchanged"), otherwise="normalized")
            reason = case(
                (v == "", "empty_url"),
                (~http, "unsupported_or_missing_scheme"),
                (~p["whole"], "missing_hostname"),
                (ported, "ValueError:Port out of range 0-65535"),
                (joined == v, ""),
                otherwise="transport_syntax_normalized",
            )
            good = http & p["whole"] & ~ported
            return F.struct(
                _raw(url).alias("raw"),
                F.when(good, joined).otherwise(v).alias("normalized"),
                status.alias("status"),
                reason.alias("reason"),
                F.when(good, bare_domain(p["host"])).otherwise("").alias("domain"),
            )

        return let(_joined(p), named)

    return let(let(_trimmed(url), _taken_apart), judged)


def normalize_source_url(url: ColumnLike) -> Column:
    """The same transformation without a status; what isn't an HTTP URL stays as it is."""
    return let(let(_trimmed(url), _taken_apart), lambda p: F.when(p["whole"] & (p["port"] <= 65535), _joined(p)).otherwise(p["v"]))


def unwrap_proxy(url: ColumnLike) -> Column:
    """The URL behind a translation proxy's `u` or `url` key or host, else the normalised URL."""
    v = _trimmed(url)
    inner = F.regexp_extract(v, r"[?&](?:u|url)=([^&#]+)", 1)
    behind = F.when(_host(v).rlike(r"^translate\.google\.") & (inner != ""), F.try_url_decode(inner))
    direct = F.regexp_extract(v, r"^https?://([a-z0-9-]+)\.translate\.goog(/[^?#]*)?", 1)
    # Such a proxy writes dots as hyphens, and hyphens twice.
    dotted = F.replace(F.replace(F.replace(direct, F.lit("--"), F.lit("\x00")), F.lit("-"), F.lit(".")), F.lit("\x00"), F.lit("-"))
    moved = F.when(direct != "", F.concat(F.lit("https://"), dotted, F.regexp_extract(v, r"\.translate\.goog(/[^?#]*)", 1)))
    return normalize_source_url(F.coalesce(behind, moved, v))


def bare_domain(host: Column) -> Column:
    return F.regexp_replace(host, r"^www\.", "")


def host_of(url: ColumnLike) -> Column:
    """The host without www., or an empty text."""
    return bare_domain(_host(_trimmed(url)))


@F.pandas_udf(StringType())
def _clean_query(queries: pd.Series, on_x: pd.Series) -> pd.Series:
    def one(query: str | None, x: bool) -> str:
        kept = []
        for key, value in parse_qsl(query or "", keep_blank_values=True):
            low = key.casefold()
            if low in fixed.TRACKING_KEYS or low.startswith(fixed.TRACKING_PREFIX) or (x and low in fixed.X_TRACKING_KEYS):
                continue
            kept.append((key, value))
        return urlencode(kept)

    return pd.Series([one(q, bool(x)) for q, x in zip(queries, on_x, strict=True)])


def fetch_key(url: ColumnLike) -> Column:
    """The key under which fetches of one page meet: no www., no tracking keys, one name for a renamed site. The port is lost."""
    v = normalize_source_url(url)
    host = host_of(v)
    host = F.when((host == "twitter.com") | host.endswith(".twitter.com"), "x.com").otherwise(host)
    query = F.regexp_replace(_part(v, 5), r"^\?", "")
    # Only queries need Python's re-encoding; the others stay in the plan's generated code.
    clean = F.when(query == "", F.lit("")).otherwise(_clean_query(query, host == "x.com"))
    path = _part(v, 4)
    key = F.concat(_part(v, 1), F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(clean == "", "").otherwise(F.concat(F.lit("?"), clean)))
    return F.when(v.rlike(PARTS), key).otherwise(v)


def hash_id(prefix: str, text: Column, digits: int = 24) -> Column:
    """prefix- and the first digits of the text's SHA-256."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(text, 256), 1, digits))


def source_id(url: ColumnLike) -> Column:
    return hash_id("source", normalize_source_url(url))


def internal_id(code: ColumnLike, sequence: ColumnLike, prefix: str = "record") -> Column:
    """prefix-N from a code's digits, else legacy-seq- and the sequence in four digits."""
    digits = F.regexp_extract(F.coalesce(col(code).cast("string"), F.lit("")), r"(\d+)", 1)
    return F.when(digits != "", F.concat(F.lit(f"{prefix}-"), digits)).otherwise(F.concat(F.lit("legacy-seq-"), F.lpad(col(sequence).cast("string"), 4, "0")))


def shard(key: ColumnLike, shards: int) -> Column:
    """The first 64 bits of the key's SHA-256, modulo the number of shards."""
    head = F.conv(F.substring(F.sha2(col(key), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % F.lit(shards).cast("decimal(20,0)")).cast("int")


def urls_in(text: ColumnLike) -> Column:
    """URLs in a text without the punctuation behind them."""
    found = F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(r"https?://[^\s<>\"']+"), F.lit(0))
    return F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?)\]}]+$", ""))


def on_domain(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith(f".{domain}")


def domain_allowed(url: ColumnLike, domains: list[str]) -> Column:
    host = host_of(url)
    return reduce(lambda a, b: a | b, [on_domain(host, d) for d in domains], F.lit(False))


def is_archive_host(url: ColumnLike) -> Column:
    return host_of(url).isin(*fixed.ARCHIVE_HOSTS)


def archive_key(urls: ColumnLike) -> Column:
    """The host of the first URL on a web archive, else the default archive."""
    hosts = F.transform(F.coalesce(col(urls), F.array().cast("array<string>")), host_of)
    return F.coalesce(F.try_element_at(F.filter(hosts, lambda h: h.isin(*fixed.ARCHIVE_HOSTS)), F.lit(1)), F.lit(fixed.DEFAULT_ARCHIVE_HOST))


def archive_path(url: ColumnLike) -> Column:
    """An archive's address of a page in progress is that of the page."""
    return F.regexp_replace(_trimmed(url), r"^(https?://[^/]+)/wip/", "$1/")


def link_kind(url: ColumnLike, own_domain: str) -> Column:
    host = host_of(url)
    video = reduce(lambda a, b: a | b, [on_domain(host, d) for d in ("youtube.com", "youtu.be", "vimeo.com")])
    return case((host.isin(*fixed.ARCHIVE_HOSTS), "archive"), (on_domain(host, own_domain), "internal"), (video, "video"), otherwise="external")


def is_external_url(url: ColumnLike) -> Column:
    return _trimmed(url).rlike(r"(?i)^https?://[^/?#\s]+")


def source_type(url: ColumnLike, publisher: ColumnLike | None = None) -> Column:
    """The kind of a source by its site, suffix, and words in host and publisher."""
    host, v = host_of(url), _trimmed(url)
    path = F.lower(F.regexp_extract(v, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1))
    ends = lambda suffixes: reduce(lambda a, b: a | b, [path.endswith(s) for s in suffixes])
    who = F.lower(F.concat(host, F.lit(" "), F.coalesce(col(publisher), F.lit("")) if publisher is not None else F.lit("")))
    return case(
        *[(on_domain(host, d), kind) for d, kind in fixed.SOCIAL_DOMAINS.items()],
        (path.endswith(".pdf"), "pdf_document"),
        (ends(fixed.IMAGE_SUFFIXES), "direct_image_url"),
        (ends(fixed.VIDEO_SUFFIXES), "direct_video_url"),
        (ends(fixed.AUDIO_SUFFIXES), "direct_audio_url"),
        (contains_any(who, fixed.GOVERNMENT_TOKENS), "government_or_military_statement"),
        (contains_any(who, fixed.NGO_TOKENS), "ngo_report"),
        (contains_any(who, fixed.BLOG_TOKENS), "blog_post"),
        (host == "", "unknown"),
        (contains_any(who, fixed.NEWS_TOKENS), "news_article"),
        otherwise="other_web_page",
    )


def platform_endpoints(url: ColumnLike) -> Column:
    """Endpoints that give a post's text: two oEmbed services and two embed pages, by site; null elsewhere."""
    host, v, quoted = host_of(url), normalize_source_url(url), F.url_encode(normalize_source_url(url))
    return case(
        (on_domain(host, "x.com") | on_domain(host, "twitter.com"), F.concat(F.lit("https://publish.twitter.com/oembed?omit_script=1&url="), quoted)),
        (on_domain(host, "youtube.com") | on_domain(host, "youtu.be"), F.concat(F.lit("https://www.youtube.com/oembed?format=json&url="), quoted)),
        (on_domain(host, "facebook.com"), F.concat(F.lit("https://www.facebook.com/plugins/post.php?href="), quoted)),
        (on_domain(host, "t.me"), F.concat(v, F.lit("?embed=1"))),
    )
