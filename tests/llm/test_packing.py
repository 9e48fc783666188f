import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from wardlake.llm import common, packing
from wardlake.llm.queries import WORD_BPE


def test_curve_visits_every_cell_by_single_steps():
    for dimensions, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
        key = packing.hilbert_key(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def check(rows, pieces, length, end_id):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens, tuple(np.frombuffer(p.ids, "<u4"))))
    expected = {}
    for doc_id, text in rows:
        expected.setdefault(doc_id, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id])
    for doc_id, texts in expected.items():
        got = sorted(by_doc[doc_id])
        assert sum(n for _, n, _, _ in got) == sum(map(len, texts))
        if len(texts) == 1:
            assert [x for _, _, _, ids in got for x in ids] == texts[0]
            assert [s for s, *_ in got] == np.cumsum([0, *(n for _, n, _, _ in got)])[:-1].tolist()
            assert {t for _, _, t, _ in got} == {len(texts[0])}
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    assert [s * length + o for s, o, _ in places] == np.cumsum([0, *(n for _, _, n in places)])[:-1].tolist()


def test_odd_rows(odd):
    documents, rows = odd
    pieces = packing.pack(documents, WORD_BPE, 2, length=64).collect()
    check(rows, pieces, 64, 2)


def test_special_tokens_in_texts(frame):
    rows = [(1, "one <|endoftext|> two"), (2, "<|startoftext|><|endoftext|>"), (3, "x<|ENDOFTEXT|>")]
    check(rows, packing.pack(frame(*rows), WORD_BPE, 2, length=8).collect(), 8, 2)


def test_corpus_and_whole_sequences(corpus):
    packed = packing.pack(corpus, WORD_BPE, 2)
    pieces = packed.collect()
    check([(r.doc_id, r.text) for r in corpus.collect()], pieces, 4096, 2)
    whole = sorted(packing.sequences(packed).collect())
    assert [r.sequence_id for r in whole] == list(range(len(whole)))
    assert all(len(r.ids) == 4 * 4096 and r.n_tokens == 4096 for r in whole[:-1])
    last = whole[-1]
    assert len(last.ids) == 4 * (last.n_tokens if last.n_tokens & (last.n_tokens - 1) == 0 else 4096)


def test_neighbours_on_the_curve_are_alike(corpus):
    languages = {r.doc_id: r.lang for r in corpus.collect()}
    pieces = sorted((p.sequence_id, p.offset, p.doc_id) for p in packing.pack(corpus, WORD_BPE, 2).collect() if p.start == 0)
    order = [languages[d] for _, _, d in pieces]
    same = np.mean([a == b for a, b in zip(order, order[1:])])
    share = [order.count(x) / len(order) for x in set(order)]
    assert same > sum(s * s for s in share) + 0.2


def test_empty_table(nothing):
    assert packing.pack(nothing, WORD_BPE, 2).count() == 0


def test_workers_give_freed_memory_back_while_and_after_they_read(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(len(seen)))
    monkeypatch.setattr(common, "GIVEN_BACK_BYTES", 10)
    seen = []
    for _, texts in common.chunks(iter([pa.RecordBatch.from_pydict({"text": ["aaaa", None, "bbbb", "cccccc", ""]})] * 2), size=4):
        seen += texts
    assert seen == [b"aaaa", b"", b"bbbb", b"cccccc", b""] * 2
    assert given == [4, 9, 10]


def test_giving_memory_back_keeps_what_is_in_use():
    kept = pa.array([b"x" * 1000] * 1000)
    common.give_back()
    assert kept.to_pylist() == [b"x" * 1000] * 1000
