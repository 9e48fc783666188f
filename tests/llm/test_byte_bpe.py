import base64
import functools

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given
from hypothesis import strategies as st

from wardlake.llm import byte_bpe
from wardlake.llm.queries import BYTE_BPE, PIECE_PATTERN


@functools.cache
def both():
    with open(BYTE_BPE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=PIECE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.Encoder(byte_bpe.Vocabulary(ranks), PIECE_PATTERN), library


def test_pattern_is_the_published_one():
    assert PIECE_PATTERN == public_tokenizers.PATTERN


@given(st.one_of(st.text(max_size=200), st.text(alphabet="abß 日\n'sre.,12", max_size=400)))
def test_ids_are_those_of_the_merges(text):
    own, library = both()
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", "a" * 20_000, "ab" * 10_000, " " * 5000, "é" * 3000])
def test_long_pieces(text):
    own, library = both()
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_small_vocabulary_with_an_entry_no_merges_reach():
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"abc": 4, b"aab": 5}
    own = byte_bpe.Encoder(byte_bpe.Vocabulary(ranks), r"\w+")
    library = tiktoken.Encoding("small", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    for text in ("aab", "aabc", "abcabc", "aabaab", "cab"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_table_round_trip(odd):
    documents, rows = odd
    _, library = both()
    found = byte_bpe.decode(byte_bpe.encode(documents, BYTE_BPE, PIECE_PATTERN), BYTE_BPE).collect()
    got = sorted((str(r.doc_id), bytes(r.decoded), r.n_tokens) for r in found)
    assert got == sorted((str(i), (t or "").encode(), len(library.encode_ordinary(t or ""))) for i, t in rows)


def test_empty_table(nothing):
    assert byte_bpe.encode(nothing, BYTE_BPE, PIECE_PATTERN).count() == 0
