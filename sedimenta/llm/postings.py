"""What the two word indexes share: words of whole texts, shards of documents, and query texts in blocks.

A word is a longest run of ASCII letters and digits and of characters beyond ASCII; A-Z are lower-cased, nothing else is
changed. All such characters are told by their bytes in UTF-8, so words are cut by numpy over the bytes of a whole block.

A shard is a block of some SHARD_BYTES of whole documents (a longer document is a shard of its own). It is one row: the
different words in order of their bytes, and for each of them a slice of the postings, as compressed sparse rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sedimenta.llm.common import written

#: Bytes of texts in a shard, and of query texts that are sent to the tasks at once.
SHARD_BYTES = 8_000_000
QUERY_BYTES = 4_000_000

#: Each byte's lower-cased self if it is part of a word, else 0.
_WORD = np.zeros(256, np.uint8)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _WORD[_low : _high + 1] = np.arange(_low, _high + 1)
_WORD[0x41:0x5B] += 0x20


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and how many each text has. Null counts as empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, values = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, wide)
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    bounds = offsets.astype(np.int64) - offsets[0]
    low = _WORD[data]
    own = low != 0
    edge = np.zeros(len(own) + 1, bool)
    edge[bounds] = True  # texts don't run into each other
    first, last = own.copy(), own.copy()
    first[1:] &= ~own[:-1] | edge[1:-1]
    last[:-1] &= ~own[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts + 1, out=at[1:])
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(low[own])])
    return found, np.diff(np.searchsorted(starts, bounds))


def numbered(found: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different words in order of their bytes, and the number of each word among them."""
    coded = found.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return coded.dictionary.take(pa.array(order)), rank[codes] if len(order) else np.zeros(0, np.int64)


def slices(numbers: np.ndarray, n: int) -> np.ndarray:
    """Where the postings of each of n words begin and end, if they stand in order of their words' numbers."""
    return np.searchsorted(numbers, np.arange(n + 1)).astype(np.int32)


def shard_name(k: int) -> str:
    return f"{TaskContext.get().partitionId()}-{k}"


def shard_row(**columns: str | np.ndarray | pa.Array) -> pa.RecordBatch:
    """One row: numpy arrays as their bytes, Arrow arrays as lists."""

    def cell(value: str | np.ndarray | pa.Array) -> pa.Array:
        if isinstance(value, pa.Array):
            return pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value)
        return pa.array([value.tobytes() if isinstance(value, np.ndarray) else value])

    return pa.RecordBatch.from_pydict({name: cell(value) for name, value in columns.items()})


def places(wanted: pa.Array, terms: pa.Array) -> np.ndarray:
    """The number of each wanted word among a shard's, -1 if it has none."""
    return pc.fill_null(pc.index_in(wanted, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def query_blocks(items: DataFrame, columns: list[str], text: str, size: int = QUERY_BYTES) -> Iterator[list[Row]]:
    """The different rows of a stated query set, in blocks of some size in bytes, whatever the number of rows. One block at least, if empty."""
    rows = written(items.select(*columns).distinct(), "query-texts")
    total = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = total // size + 1
    for k in range(n):
        found = rows.where(F.pmod(F.xxhash64(*columns), F.lit(n)) == k).orderBy(*columns).collect()
        if found or k == 0:
            yield found
