"""Byte-level BPE by dynamic programming over prefixes.

A sequence of tokens is the encoding of its bytes exactly if every two neighbours are the encoding of theirs. So each byte
prefix of a piece has one valid last token, the one that fits behind the last token of the prefix it leaves; storing it for
every prefix gives the encoding of all prefixes in time proportional to the length. Bytes appended later extend the table
and change nothing before (PrefixEncoder.append), and after an edit only the prefixes near it are computed anew
(PrefixEncoder.edit).

A piece that is a token as a whole encodes to it, as the tiktoken library does. Ids decode by joining their bytes.

Defined results: null counts as empty and has no ids; a text of any length is encoded whole, in memory that grows with its
longest piece. Rows that repeat are encoded each on its own; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sedimenta.llm.common import bounded_batches

#: Pieces, and pairs of tokens, whose results a worker keeps; older halves go first.
CACHED_PIECES = 1_000_000
CACHED_PAIRS = 2_000_000
#: What stands before a piece's first token.
START = -1


class Vocabulary:
    """Ranks of byte strings; lower ranks merge first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.bytes}
        self.longest = max(map(len, ranks), default=1)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def merged(self, piece: bytes, below: float = float("inf")) -> list[int]:
        """The encoding by merging the lowest rank first, ranks below a limit only; used for single tokens."""
        get = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = get(parts[i] + parts[i + 1])
                if rank is not None and rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def half(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte and for a token that merging never makes."""
        if token not in self.halves:
            text, found = self.bytes[token], None
            if len(text) > 1:
                parts = self.merged(text, token)
                found = (parts[0], parts[1]) if len(parts) == 2 else None
            self.halves[token] = found
        return self.halves[token]

    def makeable(self, token: int) -> bool:
        return len(self.bytes[token]) == 1 or self.half(token) is not None

    def fits(self, left: int, right: int) -> bool:
        """Whether right can follow left, or begin a piece if left is START: both stay apart when their bytes are encoded."""
        return self.makeable(right) and (left == START or self._apart(left, right))

    def extend(self, piece: bytes, last: list[int], until: int | None = None) -> None:
        """Appends the valid last tokens of the prefixes of piece that last doesn't have yet.

        Exactly one token is valid at each end; short ones are tried first, as most are short.
        """
        get, pairs, longest = self.ranks.get, self.pairs, self.longest
        for end in range(len(last), (len(piece) if until is None else until) + 1):
            for start in range(end - 1, max(0, end - longest) - 1, -1):
                token = get(piece[start:end])
                if token is None:
                    continue
                key = last[start] << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= CACHED_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self.fits(last[start], token)
                if fits:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def tokens(self, piece: bytes, last: list[int]) -> list[int]:
        """The encoding that a whole table holds, read from its end."""
        out, at, text = [], len(piece), self.bytes
        while at:
            out.append(last[at])
            at -= len(text[last[at]])
        out.reverse()
        return out

    def _apart(self, left: int, right: int) -> bool:
        """The merges of both are undone from the latest on. At each point in time, the tokens that then touch at the border
        must not have been mergeable with a rank below the merge that followed.
        """
        ranks, text = self.ranks, self.bytes
        # A merge on the left wins a tie of ranks, as it comes first in the text; on the right it loses.
        horizon = float("inf")
        while True:
            joint = ranks.get(text[left] + text[right])
            if joint is not None and joint < horizon:
                return False
            a, b = self.half(left), self.half(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                horizon, left = left, a[1]
            else:
                horizon, right = right + 0.5, b[0]


class PrefixEncoder:
    """The table of one piece: the valid last token of every prefix."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = [START]
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.vocabulary.extend(self.piece, self.last)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace piece[start:end]; gives the number of prefixes computed anew.

        Behind the edit, once as many prefixes in a row as the longest token has bytes have their old last token, all
        later ones keep theirs: a last token depends on no others.
        """
        vocabulary, old, shift = self.vocabulary, self.last, len(new) - (end - start)
        piece = self.piece[:start] + new + self.piece[end:]
        last, same, done = old[: start + 1], 0, 0
        while len(last) <= len(piece):
            at = len(last)
            if same >= vocabulary.longest:
                last.extend(old[at - shift :])
                break
            vocabulary.extend(piece, last, at)
            done += 1
            before = at - shift
            # A token that reaches back into the edit is the old one by chance only.
            same = same + 1 if before > end and last[at] == old[before] and at - len(vocabulary.bytes[last[at]]) >= start + len(new) else 0
        self.piece, self.last = piece, last
        return done

    def ids(self) -> list[int]:
        return self.vocabulary.tokens(self.piece, self.last)


class Codec:
    """Encodes and decodes whole texts; keeps the ids of pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pieces = regex.compile(pattern)
        self.new: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def piece(self, piece: str) -> tuple[int, ...]:
        found = self.old.get(piece)
        if found is None:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = self.vocabulary.ranks.get(raw)
            if whole is not None:
                found = (whole,)
            else:
                last = [START]
                self.vocabulary.extend(raw, last)
                found = tuple(self.vocabulary.tokens(raw, last))
        if len(self.new) >= CACHED_PIECES // 2:
            self.old, self.new = self.new, {}
        self.new[piece] = found
        return found

    def encode(self, text: str | None) -> list[int]:
        pieces = self.pieces.findall(text or "")
        found = list(map(self.new.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self.piece(pieces[i])
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a vocabulary file, one for each worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(Vocabulary.from_file(path), pattern)
    return _codecs[path, pattern]


def round_trips(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        names = own.vocabulary.names.__getitem__
        for batch in batches:
            n, ids_sha, decoded_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids = own.encode(text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(names, ids)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids of every row."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            ids = pa.array([own.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")
