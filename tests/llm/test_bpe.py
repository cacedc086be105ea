import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from sedimenta.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.vocabulary.ranks, special_tokens={})


def test_equals_tiktoken(codec, reference, documents):
    rng = random.Random(4)
    texts = [r.text for r in documents.collect()]
    ranges = [(32, 126), (0x80, 0x24F), (0x370, 0x5FF), (0x4E00, 0x9FFF), (0x1F300, 0x1F6FF)]
    texts += ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "\n\n  x", "a" * 5000, "ab" * 3000, "<|endoftext|>", "don't  we'll"]
    for text in texts:
        ids = codec.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_appends_and_edits(codec):
    rng = random.Random(5)
    piece = lambda n: bytes(rng.choice(b"abcdeinthrou ") for _ in range(n))
    for _ in range(300):
        a, b = piece(rng.randint(0, 60)), piece(rng.randint(0, 10))
        grown = bpe.PrefixEncoder(codec.vocabulary, a)
        before = list(grown.last)
        grown.append(b)
        assert grown.last[: len(before)] == before
        assert grown.last == bpe.PrefixEncoder(codec.vocabulary, a + b).last
        i = rng.randint(0, len(a))
        j = rng.randint(i, len(a))
        changed = bpe.PrefixEncoder(codec.vocabulary, a)
        changed.edit(i, j, b)
        assert changed.last == bpe.PrefixEncoder(codec.vocabulary, a[:i] + b + a[j:]).last


def test_an_edit_in_a_long_piece_is_local(codec):
    rng = random.Random(6)
    raw = bytes(rng.choice(b"abcdeinthrou") for _ in range(20000))
    table = bpe.PrefixEncoder(codec.vocabulary, raw)
    assert table.edit(10000, 10001, b"zz") < 500
    assert table.last == bpe.PrefixEncoder(codec.vocabulary, raw[:10000] + b"zz" + raw[10001:]).last


def test_rows(edge_docs, no_docs, reference):
    got = bpe.round_trips(edge_docs, PATH, public_tokenizers.PATTERN).collect()
    want = []
    for r in edge_docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trips(no_docs, PATH, public_tokenizers.PATTERN).count() == 0
    assert bpe.encoded(edge_docs.limit(3), PATH, public_tokenizers.PATTERN).count() == 3
