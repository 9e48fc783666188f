import random
import re

from wardlake.llm import substring

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows):
    """Removed words by (id, text), from every window of every document."""
    starts = {}
    docs = [(float("inf") if i is None else i, t or "", WORDS.findall(t or "")) for i, t in rows]
    for i, _, words in docs:
        for k in range(len(words) - 49):
            window = tuple(words[k : k + 50])
            starts[window] = min(i, starts.get(window, i))
    out = {}
    for i, text, words in docs:
        gone = [False] * len(words)
        for k in range(len(words) - 49):
            if starts[tuple(words[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        out[i, text] = (len(words), sum(gone), [w for w, g in zip(words, gone) if not g])
    return out


def check(df, rows):
    kept, names = substring.remove_repeats(df)
    assert kept.columns[: len(df.columns)] == df.columns
    want = expected(rows)
    results = kept.collect()
    assert len(results) == len(rows)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r[names["n_words"]], r[names["n_removed"]], WORDS.findall(r.text or "")) for r in results)
    assert got == sorted((-1 if i is None else i, *want[float("inf") if i is None else i, t or ""]) for i, t in rows)


def planted(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 75, 100, 240)]
    rows = []
    for i in range(60):
        words = [word() for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(max(1, len(p) - 45))
            at = rng.randrange(len(words) + 1)
            words[at:at] = p[a : a + rng.randrange(40, 240)]
        rows.append((rng.randrange(50), rng.choice([" ", "\n", " \t "]).join(words)))
    whole = " ".join(passages[-1])
    return [*rows, (3, whole), (70, whole), (70, whole), (71, whole + " end"), (None, whole), (None, None), (72, ("a b " * 200).strip()), (73, ("b a " * 200).strip())]


def test_planted_passages_against_brute_force(frame):
    for seed in (1, 2):
        rows = planted(seed)
        check(frame(*rows), rows)


def test_corpus_against_brute_force(corpus):
    check(corpus, [(r.doc_id, r.text) for r in corpus.collect()])


def test_odd_rows(odd, nothing):
    documents, rows = odd
    check(documents, rows)
    assert substring.remove_repeats(nothing)[0].count() == 0


def test_many_texts_below_a_window(frame):
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 49 + 1))) for i in range(120)]
    check(frame(*rows), rows)


def test_factors_are_greedy():
    assert substring.greedy([3, 4, 5, 6, 60], [1, 1, 2, 2, 2]) == [(3, 51, 1), (5, 51, 2), (60, 50, 2)]


def test_untouched_texts_keep_their_space(frame):
    text = "  kept \n as it\tis  "
    kept, _ = substring.remove_repeats(frame((1, text)))
    assert kept.first().text == text
