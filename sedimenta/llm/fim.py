"""Fill-in-middle: a text is cut at two places and its middle moved to the end, between marks, so that it can be put back.

A unit is a run of other characters with the white space before it, or white space at the end of the text. Both cuts are drawn
by the document's digest. Units are counted once over the text's bytes, window by window; every EVERY-th unit leaves a
checkpoint with its number, byte offset and code-point offset. A cut finds the last checkpoint before it by binary search
and scans from there, EVERY units at most. However long a text is, counting holds a window and the checkpoints beside it.

Defined results: null and empty texts are plain and have no units. Texts that contain a mark are plain, so that every output
can be taken apart. A null doc_id is digested as an empty one. Rows that repeat give equal rows, an empty table gives an empty
result, other columns are left alone.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import BLANKS, bounded_batches

#: Units between checkpoints, and bytes that are counted at once.
EVERY = 64
WINDOW = 1 << 20
#: The marks of the three parts, and how the draws decide.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_PERCENT, SPM_PERCENT = 50, 80

_UNIT = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in BLANKS]] = True


class Checkpoints:
    """The units of a text: how many there are, and where each of them ends."""

    def __init__(self, data: bytes, every: int = EVERY, window: int = WINDOW):
        self.data, self.n = data, 0
        self.units, self.bytes, self.points = [0], [0], [0]
        points = 0
        for low in range(0, len(data), window):
            part = np.frombuffer(data, np.uint8, min(window + 1, len(data) - low), low)
            own = min(window, len(part))
            blank = _BLANK[part]
            end = ~blank[:own]
            end[: len(part) - 1] &= blank[1 : own + 1] if len(part) > own else blank[1:own]
            if own == len(part):
                end[-1] = True  # the text's last unit, of whatever kind
            ends = np.flatnonzero(end) + 1
            leads = (part[:own] & 0xC0) != 0x80
            marked = ends[(-self.n - 1) % every :: every]
            if len(marked):
                self.units += range(self.n + (-self.n - 1) % every + 1, self.n + len(ends) + 1, every)
                self.bytes += (low + marked).tolist()
                self.points += (points + np.cumsum(leads)[marked - 1]).tolist()
            self.n += len(ends)
            points += int(np.count_nonzero(leads))

    def end(self, unit: int) -> tuple[int, int]:
        """Byte and code-point offset at which so many units end."""
        k = bisect_right(self.units, unit) - 1
        at = self.bytes[k]
        for _ in range(unit - self.units[k]):
            at = _UNIT.match(self.data, at).end()
        between = np.frombuffer(self.data, np.uint8, at - self.bytes[k], self.bytes[k])
        return at, self.points[k] + int(np.count_nonzero((between & 0xC0) != 0x80))


def draws(doc_id: object, seed: int = 42) -> list[int]:
    """Four numbers of 32 bits from a document's digest."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def transformed(docs: DataFrame, seed: int = 42) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points, null if plain) and output of every row."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def one(doc_id: object, data: bytes) -> tuple:
        units = Checkpoints(data)
        a, b, cut, order = draws(doc_id, seed)
        if not data or any(mark in data for mark in (p, s, m)) or cut % 100 >= CUT_PERCENT:
            return units.n, "plain", None, None, data
        first, last = sorted((a % (units.n + 1), b % (units.n + 1)))
        (at, before), (to, until) = units.end(first), units.end(last)
        prefix, middle, suffix = data[:at], data[at:to], data[to:]
        if order % 100 < SPM_PERCENT:
            return units.n, "spm", before, until - before, b"".join((s, suffix, p, prefix, m, middle))
        return units.n, "psm", before, until - before, b"".join((p, prefix, s, suffix, m, middle))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            made = [one(i, t or b"") for i, t in zip(ids.to_pylist(), texts, strict=True)]
            n, form, before, middle, output = (list(c) for c in zip(*made, strict=True)) if made else ([],) * 5
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of. Each mark stands once in it, as texts that contain one are plain."""
    text = F.col(output)
    between = lambda mark, after: F.substring_index(F.substring_index(text, mark, -1), after, 1)
    middle = F.substring_index(text, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(text)
