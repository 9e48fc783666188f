import hashlib

import numpy as np

from wardlake.llm import fingerprint


def expected(rows):
    """Rows must have distinct ids."""
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, following = (fingerprint.digests([t.encode()]) for t in (text, edited, after))
        out[i] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), own.tobytes().hex(), changed.tobytes().hex(),
            fingerprint.likeness(own, changed)[0], fingerprint.likeness(own, following)[0],
        )
    return out


def found(df):
    return {r[0]: tuple(r[1:]) for r in fingerprint.edited_pairs(df).collect()}


def test_corpus_against_plain_python(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    got = found(corpus)
    assert got == expected(rows)
    assert np.mean([r[4] > r[5] for r in got.values()]) > 0.97


def test_counts_against_plain_python():
    text = "abcabcé日".encode() * 3
    slot = lambda t: ((t[0] | t[1] << 8 | t[2] << 16) * 2654435761 % 2**32) >> 22
    counts = np.bincount([slot(text[i : i + 3]) for i in range(len(text) - 2)], minlength=fingerprint.BUCKETS)
    ranked = np.sort(counts)
    quartiles = [ranked[fingerprint.BUCKETS * q // 4 - 1] for q in (1, 2, 3)]
    codes = [sum(c > q for q in quartiles) for c in counts]
    packed = bytes(codes[i] | codes[i + 1] << 2 | codes[i + 2] << 4 | codes[i + 3] << 6 for i in range(0, len(codes), 4))
    assert fingerprint.digests([b"x", text, b""])[1, 1:].tobytes() == packed


def test_odd_rows(odd, frame, nothing):
    documents, rows = odd
    got = fingerprint.edited_pairs(documents).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert {r.fingerprint for r in got if r.doc_id == 1 and r.n_chars == 13} and all(0 <= r.near_next <= 1 for r in got)
    assert fingerprint.fingerprints(documents).count() == len(rows)
    assert found(frame((7, "only one"))) == expected([(7, "only one")])
    assert fingerprint.edited_pairs(nothing).count() == 0


def test_equal_texts_have_equal_prints(frame):
    a, b = fingerprint.fingerprints(frame((1, "same text here"), (2, "same text here"))).collect()
    assert a.fingerprint == b.fingerprint
