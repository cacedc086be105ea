"""Missing values, numbers, dates, arrays and small arithmetic, as column expressions.

Null and the empty string both count as missing; a raw value is never overwritten, only given derived columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions import fixed

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: ColumnLike) -> Column:
    return col(c).isNull() | (col(c).cast("string") == "")


def first_present(*cs: ColumnLike) -> Column:
    """The first value that isn't missing."""
    return F.coalesce(*[F.when(~is_missing(c), col(c)) for c in cs])


def missing_names(**required: Column) -> Column:
    """Names of those that are missing, in the order given."""
    return F.array_compact(F.array(*[F.when(is_missing(c), F.lit(name)) for name, c in required.items()]))


def case(*branches: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first branch whose condition holds; an unknown condition doesn't."""
    first, *rest = branches
    out = reduce(lambda acc, b: acc.when(b[0], _value(b[1])), rest, F.when(first[0], _value(first[1])))
    return out.otherwise(_value(otherwise))


def _value(v: object) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it: branches don't share common parts otherwise."""
    return F.transform(F.array(value), body)[0]


def contains_any(c: ColumnLike, words: Sequence[str]) -> Column:
    """Whether the text holds any of the words, as plain substrings; false for null. The text is read once."""
    return F.coalesce(col(c).rlike("|".join(re.escape(w) for w in words)), F.lit(False))


def as_number(c: ColumnLike) -> Column:
    """A finite double, else null."""
    text = F.regexp_replace(col(c).cast("string"), r"(?U)^\s+|(?<!\s)\s+$", "")
    plain = r"^[+-]?(\d[\d_]*\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    finite = lambda number: ~F.isnan(number) & (F.abs(number) != float("inf"))
    return let(text, lambda t: let(t.try_cast("double"), lambda number: F.when(t.rlike(plain) & finite(number), number)))


def coordinate_pair(c: ColumnLike) -> Column:
    """lat and lon: the first two numbers in a text, if it has two."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"[-+]?\d+(?:\.\d+)?"), F.lit(0))
    pair = F.struct(found[0].cast("double").alias("lat"), F.try_element_at(found, F.lit(2)).cast("double").alias("lon"))
    return F.when(F.size(found) >= 2, pair)


def parsed_date(c: ColumnLike) -> Column:
    """YYYY-MM-DD where a date can be read, else the text as it was."""
    text = F.trim(F.coalesce(col(c), F.lit("")))
    iso = F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1)
    named = [F.date_format(F.try_to_timestamp(text, F.lit(p)), "yyyy-MM-dd") for p in ("MMMM d, yyyy", "d MMMM yyyy", "MMM d, yyyy")]
    return F.when(is_missing(c), col(c)).otherwise(F.coalesce(F.when(iso != "", iso), *named, col(c)))


def clock(seconds: ColumnLike) -> Column:
    """HH:MM:SS."""
    s = F.floor(F.greatest(col(seconds), F.lit(0))).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("bigint"), F.floor(s % 3600 / 60).cast("bigint"), s % 60)


def retry_after(header: ColumnLike, now: Column) -> Column:
    """Seconds of a Retry-After header, a number or an HTTP date, within 0 and 120; null if unreadable."""
    text = F.trim(col(header))
    seconds = F.when(text.rlike(r"^\d+(\.\d+)?$"), text.try_cast("double"))
    at = F.try_to_timestamp(F.regexp_replace(text, r"^[A-Za-z]{3}, ", ""), F.lit("d MMM yyyy HH:mm:ss 'GMT'"))
    wait = F.coalesce(seconds, at.cast("double") - now.cast("double"))
    return F.when(wait.isNotNull(), F.least(F.lit(120.0), F.greatest(F.lit(0.0), wait)))


def backoff(attempt: ColumnLike, cap: float) -> Column:
    """Seconds before the next attempt, without jitter: doubled each time up to a cap."""
    return F.least(F.pow(F.lit(2.0), col(attempt) - 1), F.lit(float(cap)))


def retry_seconds(has_text: Column, reason: ColumnLike, policy_complete: Column, operational: Column) -> Column:
    """How long a failed source is left alone."""
    r = F.lower(F.coalesce(col(reason), F.lit("")))
    return case(
        (has_text | policy_complete, 0),
        (contains_any(r, ["not_found", "gone", "no_wayback_capture"]), 7 * 86400),
        (contains_any(r, ["login", "blocked", "forbidden"]), 12 * 3600),
        (operational, 15 * 60),
        otherwise=6 * 3600,
    )


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """A share in [0, 100]; 0 of nothing."""
    share = F.coalesce(F.try_divide(part.cast("double") * 100, whole.cast("double")), F.lit(0.0))
    return F.bround(F.least(F.lit(100.0), F.greatest(F.lit(0.0), share)), digits)


def ordered_union(a: ColumnLike, b: ColumnLike) -> Column:
    """Items of both, first occurrences first."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(col(a), empty), F.coalesce(col(b), empty)))


def sorted_unique(c: ColumnLike) -> Column:
    return F.array_sort(F.array_distinct(c if isinstance(c, Column) else F.col(c)))


def first_match(c: ColumnLike, holds) -> Column:
    """The first item for which holds(item) is true, else null."""
    return F.try_element_at(F.filter(col(c), holds), F.lit(1))


def rows_by_header(header: Column, rows: Column) -> Column:
    """An array of maps of rows whose cells follow a header; short rows lack the last keys."""
    return F.transform(rows, lambda r: F.map_from_arrays(F.slice(header, 1, F.least(F.size(header), F.size(r))), F.slice(r, 1, F.least(F.size(header), F.size(r)))))


def map_point(lat: Column, lon: Column, width: float, height: float) -> Column:
    """x and y of a position in the expected region on a canvas."""
    (south, north), (west, east) = fixed.REGION["lat"], fixed.REGION["lon"]
    return F.struct(((lon - west) / (east - west) * width).alias("x"), ((north - lat) / (north - south) * height).alias("y"))


def sequence_numbers(text: ColumnLike) -> Column:
    """The numbers of a list such as 1,4,480-481, each once, in its order."""
    parts = F.filter(F.transform(F.split(col(text), ","), lambda p: F.trim(p)), lambda p: p != "")
    each = F.transform(parts, lambda p: F.sequence(F.regexp_extract(p, r"^(\d+)", 1).cast("int"), F.regexp_extract(p, r"(\d+)$", 1).cast("int")))
    return F.array_distinct(F.flatten(each))
