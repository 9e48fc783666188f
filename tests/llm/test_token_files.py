import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wardlake.fs import work_dir
from wardlake.llm import token_files
from wardlake.llm.encode import WordEncoder
from wardlake.llm.queries import WORD_BPE, op3_token_files


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(WORD_BPE)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=3000), st.data())
def test_levels_round_trip_and_random_access(ids, data):
    ids = np.array(ids, np.uint32)
    levels, bitmaps, ranks = token_files.pack_levels(ids)
    assert (token_files.unpack_levels(levels, bitmaps) == ids).all()
    if len(ids):
        where = np.array(data.draw(st.lists(st.integers(0, len(ids) - 1), max_size=20)), np.int64)
        assert (token_files.read_at(levels, bitmaps, ranks, where) == ids[where]).all()


@given(st.lists(st.text(alphabet=st.sampled_from("aAzZ'sS 1²2.,:$#ñß\n\t\x0b\x1c\x85̈İΣςé日<|>-"), max_size=60), max_size=8))
def test_words_encode_like_whole_texts(library, encoder, texts):
    found = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert found == [library(t) for t in texts]


SPECIAL = ["<|startoftext|>", "<|endoftext|>"]


@given(st.lists(st.lists(st.sampled_from([*SPECIAL, "<|ENDOFTEXT|>", "a", "B.", " ", "é", "\u0301", "<|", "|>", "endoftext", "\n", "x1"]), max_size=12), max_size=6))
def test_special_tokens_as_the_plain_library_has_them(library, encoder, texts):
    texts = ["".join(parts) for parts in texts]
    found = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert found == [library(t) for t in texts]
    assert library("abc<|endoftext|>") == [*library("abc"), 49407]


def test_special_tokens_survive_a_new_generation(library, monkeypatch):
    from wardlake.llm import encode

    monkeypatch.setattr(encode, "REMEMBERED_WORDS", 5)
    small = WordEncoder(WORD_BPE)
    for k in range(10):
        text = " ".join(f"w{k}x{i}" for i in range(4)) + "<|endoftext|>a<|startoftext|>"
        assert np.frombuffer(small.encode([text.encode()])[0], small.kind).tolist() == library(text)


def test_files_hold_every_document_in_order(spark, odd, library):
    documents, rows = odd
    path = work_dir(spark, "tokens")
    token_files.write_tokens(documents, path, WORD_BPE, 1)
    found = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, None, 1, 1, 1, 2, 3, 4, 5, 6]
    expected = sorted((-1 if i is None else i, library(t) + [1]) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found) == expected
    everything = np.concatenate([np.frombuffer(r.ids, "<u4") for r in found])
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    wanted = [0, 1, 5, 1000, len(everything) - 1, len(everything), -1]
    at = {r.position: r.token_id for r in token_files.tokens_at(spark, path, spark.createDataFrame([(w,) for w in wanted], "position long")).collect()}
    assert at == {w: int(everything[w]) for w in wanted[:5]}


def test_empty_table(spark, nothing):
    path = work_dir(spark, "tokens")
    token_files.write_tokens(nothing, path, WORD_BPE, 1)
    assert token_files.read_tokens(spark, path).count() == 0


def test_query_agrees_with_the_library(spark, corpus, library):
    start = 0
    found = {r.doc_id: r for r in op3_token_files(spark, "/root/testdata/sf0.001").collect()}
    for row in corpus.orderBy("doc_id").collect():
        ids = np.array(library(row.text) + [1], "<u4")
        r = found.pop(row.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found
