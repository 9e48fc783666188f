import random
from collections import Counter

import numpy as np
import pytest

from wardlake.llm import near_dedup
from wardlake.llm.common import Scratch
from wardlake.llm.components import components


def common(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
    return best[-1, -1]


def expected(rows):
    """Classes by comparing all pairs of distinct word sequences."""
    texts = [(float("inf") if i is None else i, " ".join((t or "").split())) for i, t in rows]
    distinct = sorted({t for _, t in texts})
    grams = [[tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)] for t in distinct]
    counts = [Counter(g) for g in grams]
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(distinct)):
        for j in range(i):
            n, m = len(grams[i]), len(grams[j])
            if n and m and sum((counts[i] & counts[j]).values()) * 1.8 >= 0.8 * (n + m) - 1e-9:
                c = common(grams[i], grams[j])
                if c / (n + m - c) >= 0.8 - 1e-12:
                    parent[find(i)] = find(j)
    first = {}
    for i, t in texts:
        root = find(distinct.index(t))
        first[root] = min(i, first.get(root, i))
    return sorted((i, first[find(distinct.index(t))]) for i, t in texts)


def check(df, rows):
    found = near_dedup.near_duplicates(df).collect()
    far = lambda x: float("inf") if x is None else x
    assert sorted((far(r.doc_id), far(r.class_id)) for r in found) == expected(rows)
    kept = [(far(r.doc_id), far(r.class_id)) for r in found if r.kept]
    assert sorted(kept) == sorted({(c, c) for _, c in expected(rows)})
    once = near_dedup.keep_one(df)
    assert once.columns == df.columns
    assert sorted(far(r.doc_id) for r in once.collect()) == sorted(c for c, _ in kept)


@pytest.mark.parametrize("seed", range(30))
def test_alignment_in_a_wide_band_is_the_longest_common_subsequence(seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(0, 6, rng.integers(1, 30)).astype(np.uint64) for _ in range(2))
    assert near_dedup.banded_common(a, b, 40) == common(a, b)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], [f"new{rng.randrange(99)}"], [words[at], "more"]])
    return words


def test_planted_copies_against_all_pairs(frame):
    rng = random.Random(5)
    rows, number = [], iter(range(1000))
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 260))]
        for n in (0, 0, 1, 1, 2, 3, 6, 12):
            rows.append((next(number), " ".join(edited(rng, base, n))))
    for _ in range(20):
        rows.append((next(number), " ".join(f"w{rng.randrange(3000)}" for _ in range(80))))
    rows += [(2000, "two words"), (2001, "two words"), (2002, "two  words"), (2003, "two words more"), (2004, "z " * 300), (2005, "z " * 301)]
    rng.shuffle(rows)
    check(frame(*rows), rows)


def test_pairs_in_the_crowd_of_one_template(frame):
    """Pairs at 0.82, among documents of one template that are at 0.77 to each other."""
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    template, rows = [word() for _ in range(91)], []
    for _ in range(75):
        mine = [word() for _ in range(3)]
        rows += [(len(rows) + i, " ".join([*template, *mine, *(word() for _ in range(10))])) for i in (0, 1)]
    assert len({c for _, c in expected(rows)}) == 75
    check(frame(*rows), rows)


@pytest.mark.parametrize("block, grams", [(2048, 1 << 20), (20, 1 << 20), (2048, 3000)])
def test_large_groups_meet_in_blocks(spark, frame, monkeypatch, block, grams):
    """One group of 90 in several classes: links join what is similar, and fewer than there are pairs."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_GRAMS", grams)
    rng = random.Random(3)
    cores = [[f"w{k}x{i}" for i in range(150)] for k in range(6)]
    rows = [(i, " ".join([*cores[i % 6], *(f"own{rng.randrange(10**6)}" for _ in range(5))])) for i in range(90)]
    scratch = Scratch(spark, "blocks")
    marks = scratch.keep(near_dedup._marks(frame(*rows)), "marks")
    place = {r.row: r.place for r in marks.collect()}
    row = {p: r for r, p in place.items()}
    sketches = spark.createDataFrame([(r, 1) for r in place], "row long, band long")
    # two classes are known already, and half of the others are joined to nobody
    roots = spark.createDataFrame([(row[i], row[i % 6]) for i in range(60) if i % 6 < 2], "node long, root long")
    links = near_dedup._joined_blocks(sketches, sketches.select("band").distinct(), marks, frame(*rows), roots, scratch)
    found = [(place[r.a], place[r.b]) for r in links.collect()]
    assert all(a % 6 == b % 6 for a, b in found) and len(found) < (90 if block == 2048 and grams > 3000 else 90 * 25)
    edges = roots.selectExpr("node AS a", "root AS b").union(links)
    joined = {place[r.node]: place[r.root] % 6 for r in components(edges, scratch, "all").collect()}
    assert joined == {i: i % 6 for i in range(90)}
    assert len({r.root for r in components(edges, scratch, "again").collect()}) == 6


def test_short_texts_against_all_pairs(frame):
    """A text and the same with a fifth more, at either end: at the threshold, or a little above."""
    rng = random.Random(9)
    rows = []
    for i in range(420):
        n = 5 + i % 21
        words = [f"w{rng.randrange(10**6)}" for _ in range(n + max(1, (n - 4) // 4))]
        rows += [(2 * i, " ".join(words[:n] if i % 2 else words[-n:])), (2 * i + 1, " ".join(words))]
    check(frame(*rows), rows)


def test_sketches_on_both_sides_of_the_short_border():
    rng = np.random.default_rng(1)
    for n in (4, 5, 8, 16, 24, 40, 60, 64):
        for _ in range(50):
            grams = rng.integers(0, 2**63, n + n // 4).astype(np.uint64)
            one, two = (near_dedup._sketch(g, near_dedup.label_occurrences(g, np.zeros(len(g), np.int64)))[0] for g in (grams, grams[:n]))
            assert np.intersect1d(one, two).size


def test_order_matters(frame):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[100:] + words[:100])), (3, " ".join(words[:-1]))]
    check(frame(*rows), rows)


def test_odd_rows(odd, nothing):
    documents, _ = odd
    found = {(r.doc_id, r.class_id, r.kept) for r in near_dedup.near_duplicates(documents).collect()}
    # texts without words are one class
    assert found == {(1, 1, True), (1, 1, False), (2, 2, True), (3, 2, False), (4, 2, False), (None, 2, False), (None, None, True), (5, 5, True), (6, 6, True)}
    assert near_dedup.near_duplicates(nothing).count() == 0
    assert near_dedup.keep_one(nothing).count() == 0


@pytest.mark.parametrize("together", [1 << 20, 20])
def test_components(spark, monkeypatch, together):
    from wardlake.llm import components as module

    monkeypatch.setattr(module, "EDGES_TOGETHER", together)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)] + [(7, 7), (9, 8), (8, 9)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    scratch = Scratch(spark, "components")
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), scratch, "t").collect()}
    assert found == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long"), scratch, "none").count() == 0
