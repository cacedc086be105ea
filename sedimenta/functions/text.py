"""Cleaning, folding, language, quality, and the few text operations that need Python, as column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sedimenta.functions import fixed
from sedimenta.functions.values import ColumnLike, case, col, contains_any, let

#: Python's line ends, and its white space (Java's (?U)\s lacks the four separators \x1c-\x1f).
LINE_ENDS = r"\r\n|[\r\n\x0b\x0c\x1c\x1d\x1e\x85  ]"
WIDE_BLANK = r"[\s\x1c-\x1f]"
#: Runs are tried from their first character only, so long ones take linear time.
INLINE_BLANK = r"[\s\x1c-\x1f&&[^\n]]"


def _text(c: ColumnLike | None) -> Column:
    return F.lit("") if c is None else F.coalesce(col(c).cast("string"), F.lit(""))


def stripped(c: ColumnLike) -> Column:
    return F.regexp_replace(_text(c), rf"(?U)^{WIDE_BLANK}+|(?<!{WIDE_BLANK}){WIDE_BLANK}+$", "")


def clean_text(c: ColumnLike) -> Column:
    """Lines trimmed, blanks within them single, and one blank line at most between two others."""
    t = F.replace(_text(c), F.lit(" "), F.lit(" "))
    t = F.regexp_replace(t, LINE_ENDS, "\n")
    t = F.regexp_replace(t, r"[ \t\f\x0b]+", " ")
    t = F.regexp_replace(t, rf"(?U)(?:(?<!{INLINE_BLANK}){INLINE_BLANK}+)?\n{INLINE_BLANK}*", "\n")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return stripped(t)


@F.pandas_udf(StringType())
def casefold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


def folded(c: Column) -> Column:
    """Lower case, and letters with a folded form of their own as that: texts that differ in case only are equal."""
    out = F.lower(c)
    for letter, form in fixed.FOLDED_LETTERS.items():
        out = F.replace(out, F.lit(letter), F.lit(form))
    return F.when(c.rlike("[^\\x00-\\x7f]"), out).otherwise(F.lower(c))


def same_value(a: ColumnLike, b: ColumnLike) -> Column:
    """Both missing, numbers within 1e-7, or texts that are equal when cleaned and folded."""
    x, y = _text(a), _text(b)
    number = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    gap = F.abs(F.trim(x).try_cast("double") - F.trim(y).try_cast("double"))
    return case(
        ((x == "") & (y == ""), True),
        ((x == "") | (y == ""), False),
        (x.rlike(number) & y.rlike(number), F.coalesce(gap < 1e-7, F.lit(False))),
        otherwise=folded(clean_text(x)) == folded(clean_text(y)),
    )


def unique_paragraphs(blocks: ColumnLike) -> Column:
    """Blocks joined by a blank line, without those that repeat one before, case and white space aside."""
    named = F.transform(col(blocks), lambda b: let(clean_text(b), lambda t: F.struct(folded(F.regexp_replace(t, r"(?U)\s+", " ")).alias("k"), t.alias("t"))))
    kept = F.filter(named, lambda b: b["k"] != "")
    # The first block of each key: keys and places in one map, so that long lists take linear time.
    numbered = F.transform(kept, lambda b, i: F.struct(b["k"].alias("k"), i.alias("i"), b["t"].alias("t")))
    firsts = let(F.array_sort(numbered), lambda s: F.filter(s, lambda b, i: (i == 0) | (b["k"] != F.try_element_at(s, F.greatest(i, F.lit(1)))["k"])))
    return F.array_join(F.transform(F.array_sort(F.transform(firsts, lambda b: F.struct(b["i"].alias("i"), b["t"].alias("t")))), lambda b: b["t"]), "\n\n")


def _letters(c: Column, ranges: str) -> Column:
    """How many characters are of the ranges: only their runs are replaced, which is little work for foreign scripts."""
    return F.length(c) - F.length(F.regexp_replace(c, f"[{ranges}]+", ""))


def detect_language(text: ColumnLike, declared: ColumnLike | None = None) -> Column:
    """A declared label's language, else that of the script with enough of the letters, else und."""
    t = _text(text)
    counts = F.struct(
        _letters(t, r"\p{L}\p{Nl}\p{No}").cast("double").alias("all"),
        _letters(t, "\u0600-\u06ff\u0750-\u077f").alias("ar"),
        _letters(t, "\u0590-\u05ff").alias("he"),
        _letters(t, "\u0400-\u04ff").alias("ru"),
        _letters(t, "A-Za-z").alias("en"),
    )
    by_script = let(
        counts,
        lambda n: case(
            (n["all"] == 0, "und"),
            (n["ar"] >= fixed.SCRIPT_SHARE * n["all"], "ar"),
            (n["he"] >= fixed.SCRIPT_SHARE * n["all"], "he"),
            (n["ru"] >= fixed.SCRIPT_SHARE * n["all"], "ru"),
            (n["en"] >= fixed.LATIN_SHARE * n["all"], "en"),
            otherwise="und",
        ),
    )
    if declared is None:
        return by_script
    label = F.lower(F.trim(_text(declared)))
    codes = sorted({code for _, code in fixed.DECLARED_LANGUAGES})
    return case(*[(F.contains(label, F.lit(token)), code) for token, code in fixed.DECLARED_LANGUAGES], *[(label == code, code) for code in codes], otherwise=by_script)


def content_quality(text: ColumnLike, title: ColumnLike | None = None, kind: ColumnLike | None = None) -> Column:
    """accepted, score and reasons of a text."""
    k = _text(kind)
    least = F.when(k.startswith("public_") | (k == "youtube_page"), fixed.LEAST_LENGTH_PUBLIC).otherwise(fixed.LEAST_LENGTH)

    def repeats(words: Column) -> Column:
        ratio = F.try_divide(F.size(F.array_distinct(words)).cast("double"), F.size(words).cast("double"))
        return F.coalesce((F.size(words) >= fixed.REPETITION_FROM_WORDS) & (ratio < fixed.REPETITION_RATIO), F.lit(False))

    def faults(t: Column) -> Column:
        folded = F.lower(F.concat(_text(title), F.lit("\n"), t))
        return F.struct(
            (F.length(t) < least).alias("short"),
            ((F.length(t) < fixed.SHELL_BELOW_LENGTH) & contains_any(folded, fixed.SHELL_MARKERS)).alias("shell"),
            let(F.regexp_extract_all(F.lower(t), F.lit(r"(?U)[^\W_]+"), F.lit(0)), repeats).alias("repetitive"),
        )

    def judged(f: Column) -> Column:
        cost = F.when(f["short"], fixed.COST_SHORT).otherwise(0) + F.when(f["shell"], fixed.COST_SHELL).otherwise(0) + F.when(f["repetitive"], fixed.COST_REPETITIVE).otherwise(0)
        reasons = F.array_compact(F.array(F.when(f["short"], "text_too_short"), F.when(f["shell"], "access_or_platform_shell"), F.when(f["repetitive"], "highly_repetitive_text")))
        return F.struct((F.size(reasons) == 0).alias("accepted"), F.greatest(F.lit(0), 100 - cost).alias("score"), reasons.alias("reasons"))

    return let(let(clean_text(text), faults), judged)


def completeness(quality: Column, truncated: Column, method: ColumnLike) -> Column:
    """partial for cut texts and summaries, whose score has a cap; else full."""
    partial = truncated | (col(method) == "meta_description") | col(method).rlike(r":(description|summary)$")
    return F.struct(
        quality["accepted"].alias("accepted"),
        F.when(partial, F.least(quality["score"], F.lit(fixed.PARTIAL_SCORE_CAP))).otherwise(quality["score"]).alias("score"),
        quality["reasons"].alias("reasons"),
        F.when(partial, "partial").otherwise("full").alias("completeness"),
    )


def capture_text(body: ColumnLike, meta: ColumnLike) -> Column:
    """The longer of a capture's body and description if it isn't an error or login page, else null."""
    a, b = clean_text(body), clean_text(meta)
    best = F.when(F.length(b) > F.length(a), b).otherwise(a)
    low = F.lower(best)
    bad = (F.length(best) < 25) | contains_any(low, fixed.SHELL_MARKERS) & (F.length(best) < fixed.SHELL_BELOW_LENGTH) | (F.contains(low, F.lit("log in")) & (F.length(best) < 100))
    return F.when(~bad, best)


def search_text(*cs: ColumnLike) -> Column:
    """What is present, joined by blanks and folded as queries are."""
    return search_fold(F.array_join(F.array_compact(F.array(*[F.when(_text(c) != "", _text(c)) for c in cs])), " "))


@F.pandas_udf(StringType())
def search_fold(texts: pd.Series) -> pd.Series:
    """NFKD without marks, lower case, single blanks; Arabic letters of one sound are one. Texts and queries alike."""

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
        return " ".join(plain.translate(_ARABIC).split())

    return texts.map(one)


_ARABIC = str.maketrans({"أ": "ا", "إ": "ا", "آ": "ا", "ى": "ي", "ة": "ه", "ـ": None})


def strip_input_marker(c: ColumnLike) -> Column:
    return F.regexp_replace(_text(c), r"(?i)^\s*\[Input\]\s*", "")


def slug(url: ColumnLike) -> Column:
    last = F.regexp_extract(F.regexp_replace(_text(url), r"[?#].*$", ""), r"([^/]+)/*$", 1)
    return F.regexp_replace(F.regexp_replace(F.lower(last), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def declared_count(c: ColumnLike) -> Column:
    """The number of a label such as Sources (1,234)."""
    return F.replace(F.regexp_extract(_text(c), r"\(\s*([\d,]+)\s*\)", 1), F.lit(","), F.lit("")).try_cast("int")


def escape_html(c: ColumnLike) -> Column:
    t = _text(c)
    for plain, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        t = F.replace(t, F.lit(plain), F.lit(name))
    return t


def thousands(c: ColumnLike) -> Column:
    return F.format_number(col(c), 0)


def snippet(c: ColumnLike, length: int = 300) -> Column:
    return F.substring(_text(c), 1, length)


def text_chunks(c: ColumnLike, most: int = 7000) -> Column:
    """Pieces of at most so many characters, cut at paragraph ends where possible; joined, they are the text again."""
    # A paragraph that is too long is cut into pieces first; the fold then packs pieces while they fit.
    pieces = F.flatten(
        F.transform(
            F.split(_text(c), "\n\n"),
            lambda p: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(p) / most).cast("int") - 1, F.lit(0))), lambda i: F.struct(F.substring(p, i * most + 1, F.lit(most)).alias("t"), (i == 0).alias("opens"))),
        )
    )
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def pack(acc: Column, piece: Column) -> Column:
        joined = F.concat(acc["open"], F.when(piece["opens"], "\n\n").otherwise(""), piece["t"])
        fits = acc["open"].isNotNull() & (F.length(joined) <= most)
        done = F.when(fits | acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        return F.struct(done.alias("done"), F.when(fits, joined).otherwise(piece["t"]).alias("open"))

    packed = F.aggregate(pieces, start, pack, lambda acc: F.concat(acc["done"], F.array(acc["open"])))
    return F.filter(packed, lambda t: F.trim(t) != "")


_MOJIBAKE = re.compile("[Â-ô][\u0080-¿]+|[ØÙÃÂ][^\\s]")


@F.pandas_udf(StringType())
def repair_mojibake(texts: pd.Series) -> pd.Series:
    """UTF-8 that was read as Latin-1, set right line by line where that is possible."""

    def line(text: str) -> str:
        if not _MOJIBAKE.search(text):
            return text
        try:
            return text.encode("latin-1").decode("utf-8")
        except UnicodeError:
            return text

    return texts.map(lambda t: None if t is None else "\n".join(line(s) for s in t.split("\n")))


_DECLARED = re.compile(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.IGNORECASE)


def decode_bytes(body: bytes, content_type: str | None) -> str:
    """By the declared charset of header or page, then UTF-8, windows-1256 for Arabic, windows-1252."""
    named = _DECLARED.search((content_type or "").encode("utf-8", "replace")) or _DECLARED.search(body[:4096])
    tries = [named[1].decode("ascii", "replace")] if named else []
    for name in [*tries, "utf-8-sig", "windows-1256", "windows-1252"]:
        try:
            return body.decode(name)
        except (LookupError, UnicodeError):
            continue
    return body.decode("utf-8", "replace")


@F.pandas_udf(StringType())
def decoded(bodies: pd.Series, content_types: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else decode_bytes(bytes(b), t) for b, t in zip(bodies, content_types, strict=True)])


def strip_tags(c: ColumnLike) -> Column:
    """A fragment's text: tags away, the usual entities read."""
    t = F.regexp_replace(_text(c), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)<(br|/p|/div|/li|/h[1-6])\b[^>]*>", "\n"), r"<[^>]+>", " ")
    for name, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(plain))
    return clean_text(t)


def register(spark) -> None:
    """The functions that need Python, for SQL."""
    spark.udf.register("search_fold", search_fold)
    spark.udf.register("casefold", casefold)
    spark.udf.register("repair_mojibake", repair_mojibake)
    spark.udf.register("decoded", decoded)
    from sedimenta.functions import tables

    tables.register(spark)


