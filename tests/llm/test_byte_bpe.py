"""Overlapping chunk encoding against the library on whole texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm import byte_bpe

PATTERN = regex.compile(byte_bpe.default_pattern())


@pytest.fixture(scope="module")
def library():
    return byte_bpe.ByteEncoder(byte_bpe.default_path(), byte_bpe.default_pattern())


def whole(library, text):
    ids = np.array(library.encoding.encode_ordinary(text or ""), dtype="<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


TEXTS = [
    None,
    "",
    " ",
    "It's we've   it''s 'REs\x1c\x1d x\x85\n\n\n  12345abc ☃☃ naïve <|endoftext|>",
    "a" * 900,
    " " * 700 + "x",
    "word " * 300,
    "'s" * 400 + " end 'll 've" * 60,
    "x\n \n  \t y" * 90,
    "שלום 世界 " * 120 + "é" * 200,
    "　" * 333 + "ab1" * 333,
]


def test_digests_equal_the_library_whatever_the_chunk(spark, library):
    docs = spark.createDataFrame([(k, t, "old") for k, t in enumerate(TEXTS)] + [(2**53 + 1, TEXTS[7], "old")] * 2 + [(None, TEXTS[6], "old")], "doc_id long, text string, n_tokens string")
    want = Counter([(k, *whole(library, t)) for k, t in enumerate(TEXTS)] + [(2**53 + 1, *whole(library, TEXTS[7]))] * 2 + [(None, *whole(library, TEXTS[6]))])
    for chunk, overlap in ((7, 3), (64, 16), (10**6, 256)):
        assert Counter(map(tuple, byte_bpe.digests(docs, chunk=chunk, overlap=overlap).collect())) == want
    assert byte_bpe.digests(docs.limit(0)).count() == 0


def test_pieces_decode_to_the_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = byte_bpe.decode(byte_bpe.encode(docs, chunk=50, overlap=10)).collect()
    for k, text in enumerate(TEXTS):
        mine = sorted((r for r in rows if r.doc_id == k), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(mine[0].n_pieces))
        assert b"".join(r.bytes for r in mine).decode() == (text or "")
    assert max(r.n_pieces for r in rows) > 3


def test_very_long_blanks_and_words(library):
    for text in ("\n" * 1_500_000 + "x", "ab" * 300_000, " a" * 100_000):
        found = library.ids(text)
        assert library.text_bytes(found) == text.encode()
    blank = " " * 60_000 + "x y"
    assert library.ids(blank).tolist() == library.encoding.encode_ordinary(blank)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab 's'l1.\n\t \x1cé☃"), max_size=120), st.integers(1, 12), st.integers(0, 8))
def test_stitches_are_boundaries_of_the_whole_text(text, chunk, overlap):
    true = {0, *(m.end() for m in PATTERN.finditer(text))}
    points, last = [p for p, _ in byte_bpe.grid(text, chunk)], 0
    for k, (begin, end, after) in enumerate(byte_bpe.windows(text, chunk, overlap)):
        if after is None:
            assert end == len(text)
            continue
        at = begin + byte_bpe.stitch(PATTERN, text[begin:end], after - begin, points[k] - begin, end == len(text))
        assert at in true and at >= max(last, points[k])
        last = at
