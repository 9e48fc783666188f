import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from wardlake.llm import periodic_runs


def brute(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def check(texts):
    runs, kept, sizes = periodic_runs.search([t.encode() for t in texts])
    for text, some, rest, n in zip(texts, runs, kept, sizes):
        words = [w for w in text.encode().split()]
        assert some == brute(words) and n == len(words)
        assert rest == b" ".join(collapse(words, some))


@given(st.lists(st.lists(st.sampled_from("abc"), max_size=120), max_size=4))
def test_random_words(documents):
    check([" ".join(words) for words in documents])


@given(st.lists(st.tuples(st.text("abcd", min_size=1, max_size=30), st.integers(1, 9), st.integers(0, 29)), max_size=6))
def test_planted_periods(parts):
    check([" ".join("".join(unit * k + unit[:rest] for unit, k, rest in parts))])


def test_long_periods_and_noise():
    rng = random.Random(5)
    words = [f"w{rng.randrange(3000)}" for _ in range(9000)]
    texts = []
    for period, times, at in ((1, 50, 3), (2, 4, 700), (3, 40, 0), (64, 4, 5000), (63, 5, 17), (65, 6, 100), (511, 5, 200), (700, 4, 6), (1000, 7, 900)):
        block = words[at : at + period]
        texts.append(" ".join(words[:at] + block * times + block[: period // 3] + words[at + period : at + period + 400]))
    check(texts)
    # a change in one period cuts the run
    broken = (words[:50] * 8)[:]
    broken[201] = "other"
    check([" ".join(broken), " ".join(["x"] * 5), " ".join(["x"] * 6), " ".join("xy" * 4), " ".join("xy" * 3 + "x")])


def test_transforms_are_exact():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        x = rng.integers(0, 1 << 31, 40 + 8 * size).astype(np.uint64) % periodic_runs.PRIME
        starts = np.array([0, 3, 17, 40 + 5 * size])
        got = periodic_runs.mismatches(x, starts, size)
        for k, s in enumerate(starts):
            for d in range(size, 2 * size):
                sums = sum((int(x[s + i]) - int(x[s + i + d])) ** 2 for i in range(size))
                assert int(got[d - size, k]) == sums % periodic_runs.PRIME


def test_odd_rows(odd):
    documents, rows = odd
    found, names = periodic_runs.periodic_runs(documents)
    assert found.columns == [*documents.columns, *names.values()] and names["n_words"] == "n_words_"
    got = sorted((r.doc_id or -1, r.text or "", [tuple(x) for x in r[names["runs"]]], r[names["collapsed"]]) for r in found.collect())
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        runs = brute(words) if len(words) < 1000 else []
        want.append((i or -1, t or "", runs, b" ".join(collapse(words, runs)).decode()))
    assert got == sorted(want)


def test_empty_table(nothing):
    assert periodic_runs.periodic_runs(nothing)[0].count() == 0


def test_white_space_is_ascii_only():
    text = "a b\x85 \x1fx\x1cy z\tq\x0bw\x0cv\rr\ns"
    assert text.encode().split() == [w.encode() for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]


def test_one_text_of_many_repeats_stays_fast():
    texts = [b"x " * 200_000, b"a b c " * 60_000, b" ".join(b"%d" % (i % 977) for i in range(150_000))]
    runs, kept, _ = periodic_runs.search(texts)
    assert [r[0][2] for r in runs] == [1, 3, 977] and [len(k.split()) for k in kept] == [1, 3, 977]


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_on_table(spark, sf):
    from wardlake.llm.queries import op13_periodic_runs, table

    folder = f"/root/testdata/sf{sf}"
    got = {r.doc_id: r for r in op13_periodic_runs(spark, folder).collect()}
    rows = table(spark, folder, "documents").collect()
    assert len(got) == len(rows)
    planted = 0
    for r in rows:
        words = (r.text or "").encode().split()
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute(words) if n < 1500 else [tuple(map(int, x)) for x in periodic_runs.runs_of(np.unique(words, return_inverse=True)[1])]
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        digest = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        wanted = (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, digest, hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest())
        assert tuple(got[r.doc_id])[1:] == wanted
    assert planted > 5
