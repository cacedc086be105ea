"""Secrets in texts: fixed patterns, and strings that pass a battery of randomness tests.

A candidate is a run of at least MIN_LENGTH characters of the usual encodings with a letter. Its encoding is the smallest
alphabet that holds it. A run with + or / as well as - or _, which no alphabet holds, is cut at + and / and, for
itself, at - and _; each part of MIN_LENGTH is one. Three tests ask whether its symbols look drawn at random from that alphabet: chi-squared
over parts of the alphabet, the number of runs below and above the middle, and the correlation of neighbours. A Cauchy
combination makes one p-value of the three; small ones mean structure (words, slugs, counters). A string of n symbols has
no p-value above 1 - 1 / n, so that counters and alphabets, which are perfectly even, can't make up for the other two tests.

What is reported as a span `random` passes two limits, apart for each encoding and length class over the whole corpus, as
long strings give their structure away at smaller p-values than short ones:

    rejected    Benjamini-Hochberg at RATE: random strings are held to be structured at most that often
    mixed       among those at or above the limit, the share of structured strings is estimated as RATE at most. Random
                strings have even p-values, so those above one half, doubled, say how many there are in all

So the second limit controls false secrets, the first lost ones. Spans of fixed patterns stay, also those that a `random` lies in.

Defined results: a null text counts as empty and has no spans; an empty table gives an empty result. Texts of any length are
read whole. Rows that repeat are scanned each on its own and count each in the control. Other columns are left alone.
Positions are in code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import atan, erfc, log10, pi, sqrt, tan

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, written

#: The fixed patterns, and the least length of what they find. Fixed values.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
#: A text without any of these, in lower case, has no assignment.
ASSIGN_HINTS = ("passw", "secret", "token", "api")

MIN_LENGTH = 24
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % MIN_LENGTH)
#: What a run of both base64 alphabets is cut into: parts of either.
PARTS = tuple(re.compile(r"[A-Za-z0-9%s]{%d,}" % (more, MIN_LENGTH)) for more in ("_-", "+/"))
#: Encodings from the smallest alphabet on: symbols in order, cut where the parts of the chi-squared test end.
ENCODINGS = (
    ("hex", ("0123", "4567", "89ab", "cdef")),
    ("HEX", ("0123", "4567", "89AB", "CDEF")),
    ("base32", ("ABCDEFGH", "IJKLMNOP", "QRSTUVWX", "YZ234567")),
    ("base36", ("abcdefghi", "jklmnopqr", "stuvwxyz", "0123456789")),
    ("BASE36", ("ABCDEFGHI", "JKLMNOPQR", "STUVWXYZ", "0123456789")),
    ("base62", ("ABCDEFGHIJKLM", "NOPQRSTUVWXYZ", "abcdefghijklm", "nopqrstuvwxyz", "0123456789")),
    ("base64", ("ABCDEFGHIJKLM", "NOPQRSTUVWXYZ", "abcdefghijklm", "nopqrstuvwxyz", "0123456789+/")),
    ("base64url", ("ABCDEFGHIJKLM", "NOPQRSTUVWXYZ", "abcdefghijklm", "nopqrstuvwxyz", "0123456789-_")),
)
_PARTS = [{c: i for i, part in enumerate(parts) for c in part} for _, parts in ENCODINGS]
_ORDER = [{c: i for i, c in enumerate("".join(parts))} for _, parts in ENCODINGS]
_SETS = [frozenset(order) for order in _ORDER]
LENGTH_CLASSES = 16
#: The false-discovery rate, and the steps of -log10(p) in which p-values are counted; those before HALF_STEP are above one half.
RATE = 0.05
STEPS_A_DECADE = 20
STEPS = 20 * STEPS_A_DECADE
HALF_STEP = 6


def _two_sided(z: float) -> float:
    return erfc(abs(z) / sqrt(2))


def chi_squared_tail(x: float, dof: int) -> float:
    """Wilson and Hilferty's normal approximation."""
    if x <= 0:
        return 1.0
    z = ((x / dof) ** (1 / 3) - (1 - 2 / (9 * dof))) / sqrt(2 / (9 * dof))
    return 0.5 * erfc(z / sqrt(2))


def battery(symbols: str, encoding: int) -> tuple[float, float, float]:
    """p-values of the chi-squared, runs and serial-correlation tests."""
    parts, order, n = _PARTS[encoding], _ORDER[encoding], len(symbols)
    counts = [0] * len(ENCODINGS[encoding][1])
    for c in symbols:
        counts[parts[c]] += 1
    size = len(order)
    expected = [n * len(part) / size for part in ENCODINGS[encoding][1]]
    chi = chi_squared_tail(sum((o - e) ** 2 / e for o, e in zip(counts, expected, strict=True)), len(counts) - 1)
    x = [order[c] for c in symbols]
    high = [2 * v >= size for v in x]
    above = sum(high)
    below = n - above
    if above and below:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
        mean = 1 + 2 * above * below / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        wald = _two_sided((runs - mean) / sqrt(spread)) if spread > 0 else 1.0
    else:
        wald = 2.0 ** (1 - n)
    mean = sum(x) / n
    spread = sum((v - mean) ** 2 for v in x)
    if spread > 0:
        serial = _two_sided((sum((a - mean) * (b - mean) for a, b in zip(x, x[1:], strict=False)) / spread + 1 / n) * sqrt(n))
    else:
        serial = 0.0
    return chi, wald, serial


def combined(ps: tuple[float, ...], n: int) -> float:
    """The Cauchy combination of the p-values of a string of n symbols."""
    clipped = [min(max(p, 1e-15), 1 - 1 / n) for p in ps]
    return min(1.0, max(10.0 ** (-STEPS / STEPS_A_DECADE), 0.5 - atan(sum(tan((0.5 - p) * pi) for p in clipped) / len(clipped)) / pi))


def runs(text: str) -> Iterator[tuple[int, int]]:
    """start and end of the strings to test; parts that overlap are tested each."""
    for m in CANDIDATE.finditer(text):
        own = m[0]
        if ("+" in own or "/" in own) and ("-" in own or "_" in own):
            found = {(m.start() + p.start(), m.start() + p.end()) for part in PARTS for p in part.finditer(own)}
            yield from sorted(found)
        else:
            yield m.span()


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """start, end, stratum (encoding and length class) and step of -log10(p) of every candidate."""
    out = []
    for start, end in runs(text):
        own = text[start:end]
        seen = set(own)
        if not any(c.isalpha() for c in seen):
            continue
        for k, allowed in enumerate(_SETS):
            if seen <= allowed:
                p = combined(battery(own, k), len(own))
                length = min(LENGTH_CLASSES - 1, len(own).bit_length())
                out.append((start, end, k * LENGTH_CLASSES + length, min(STEPS - 1, int(-log10(p) * STEPS_A_DECADE))))
                break
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, kind and end of what the fixed patterns find, by start and then kind."""
    out = []
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def tested(docs: DataFrame) -> DataFrame:
    """doc_id, base (start, kind, end) and tried (start, end, stratum, step) of every row."""
    bounded_batches(docs.sparkSession)
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    tried_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("stratum", pa.int32()), ("step", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, tried = [], []
            for text in batch.column(1).to_pylist():
                found = base_spans(text or "")
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
                tried.append([{"start": s, "end": e, "stratum": h, "step": p} for s, e, h, p in candidates(text or "")])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, base_type), pa.array(tried, tried_type)], ["doc_id", "base", "tried"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, base array<struct<start: int, kind: int, end: int>>, tried array<struct<start: int, end: int, stratum: int, step: int>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def limit_of(seen: list[int], rate: float = RATE) -> int:
    """The least step (of -log10(p)) whose strings aren't reported, from the counts of all steps of a stratum."""
    total = sum(seen)
    rejected, beyond = STEPS, 0
    for step in range(STEPS - 1, -1, -1):
        beyond += seen[step]
        # All p-values of a step are at most 10 ** (-step / STEPS_A_DECADE).
        if beyond and total * 10.0 ** (-step / STEPS_A_DECADE) <= rate * beyond:
            rejected = step
    half = 10.0 ** (-HALF_STEP / STEPS_A_DECADE)
    random = min(total, (sum(seen[:HALF_STEP]) + 1) / (1 - half))  # one more, as no estimate is sure
    mixed, reported = 0, 0
    for step in range(STEPS):
        reported += seen[step]
        expected = random * (1 - 10.0 ** (-(step + 1) / STEPS_A_DECADE))
        if reported - expected <= rate * reported:
            mixed = step + 1
    return min(rejected, mixed)


def limits_from(rows: DataFrame, rate: float = RATE) -> dict[int, int]:
    """limit_of() each stratum; strata and steps are few, whatever the corpus."""
    counts: dict[int, list[int]] = {}
    steps = rows.select(F.explode("tried").alias("t")).groupBy("t.stratum", "t.step").agg(F.count(F.lit(1)).alias("n"))
    for row in steps.collect():  # 8 encodings, 16 length classes and 400 steps at most
        counts.setdefault(row["stratum"], [0] * STEPS)[row["step"]] += row["n"]
    return {stratum: limit_of(seen, rate) for stratum, seen in counts.items()}


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_random of every row."""
    rows = written(tested(docs), "secret-tests")
    limits = limits_from(rows, rate)
    limit = F.create_map(*[F.lit(v) for pair in sorted(limits.items()) for v in pair]) if limits else F.create_map(F.lit(0), F.lit(STEPS))
    kept = F.filter("tried", lambda t: t["step"] < limit[t["stratum"]])
    more = F.transform(kept, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", more)).alias("spans"),
        F.size(more).cast("bigint").alias("n_random"),
    )


def digest_of(spans: list[tuple[int, int, int]]) -> str:
    """base_sha256 of spans given as start, kind, end."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)).encode()).hexdigest()
