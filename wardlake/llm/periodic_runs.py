"""Periodic runs of words, found by block convolution.

At the scale L = 1, 2, 4, ... the words are cut into blocks of L. A run of period q, L <= q < 2L,
that is at least 4q long holds a whole block that occurs again q words later. For every block the
sums of squared differences to all places L to 2L-1 words later come from one product of number
theoretic transforms: the sum of squares of both minus twice the correlation, in exact integers
modulo a prime. Where the sum is zero, that distance seeds an extension, which compares the words
themselves; so a sum that is only zero modulo the prime costs a comparison and changes no result.

Two exact rules spare work. The words of such a run recur within q, so a block can only count if all
words in it and in the next block recur within less than 2L. And where a block and the two after it
lie in a run found at a smaller scale, every match is a multiple of that run's period.

Null texts have no words. A document is one row and is read whole; the transforms work in slabs of
bounded size. Many short documents are searched together, with a mark between them that occurs once.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardlake.llm.common import extend, free_name

#: A run has this many periods at least, and this many words.
PERIODS, WORDS = 4, 6
#: Prime 15 * 2^27 + 1 and a generator of its multiplicative group: transforms of up to 2^27 places.
PRIME, GENERATOR = 2013265921, 31
#: Numbers in one batch of transforms.
SLAB = 1 << 18

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

_roots: dict[tuple[int, bool], np.ndarray] = {}


def _powers_of_root(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half, as a column."""
    if (half, inverse) not in _roots:
        root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        powers = np.ones(1, np.uint64)
        while len(powers) < half:
            powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), PRIME)) % np.uint64(PRIME)])
        _roots[half, inverse] = powers[:, None]
    return _roots[half, inverse]


def transform(x: np.ndarray) -> None:
    """Transform every column in place; the result is in bit-reversed order."""
    p, half = np.uint64(PRIME), len(x) // 2
    while half:
        v = x.reshape(-1, 2, half, x.shape[1])
        total = (v[:, 0] + v[:, 1]) % p
        v[:, 1] = (v[:, 0] + (p - v[:, 1])) % p * _powers_of_root(half, False) % p
        v[:, 0] = total
        half //= 2


def restore(x: np.ndarray) -> None:
    """Undo ``transform`` in place."""
    p, half = np.uint64(PRIME), 1
    while half < len(x):
        v = x.reshape(-1, 2, half, x.shape[1])
        turned = v[:, 1] * _powers_of_root(half, True) % p
        v[:, 1] = (v[:, 0] + (p - turned)) % p
        v[:, 0] = (v[:, 0] + turned) % p
        half *= 2
    x *= np.uint64(pow(len(x), -1, PRIME))
    x %= p


def mismatches(x: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Sums modulo PRIME of squared differences, one row per distance ``size`` to 2 * ``size`` - 1.

    Column k belongs to the block ``x[starts[k]:starts[k] + size]``; x reaches 3 * size further.
    """
    p = np.uint64(PRIME)
    block = x[starts + np.arange(size)[:, None]]
    after = x[starts + np.arange(size, 3 * size)[:, None]]
    turned = np.zeros((2 * size, len(starts)), np.uint64)
    turned[(-np.arange(size)) % (2 * size)] = block
    sums = np.cumsum(after * after % p, axis=0)
    squares = sums[size - 1 : 2 * size - 1].copy()
    squares[1:] -= sums[: size - 1]
    squares += (block * block % p).sum(axis=0)
    transform(turned)
    product = after
    transform(product)
    product *= turned
    product %= p
    restore(product)
    return (squares + 2 * (p - product[:size])) % p


def _gaps(ids: np.ndarray) -> np.ndarray:
    """How many words later each word occurs again; more than there are words when it does not."""
    order = np.argsort(ids, kind="stable")
    gaps = np.full(len(ids), 4 * len(ids) + 1, np.int64)
    again = ids[order[1:]] == ids[order[:-1]]
    gaps[order[:-1][again]] = np.diff(order)[again]
    return gaps


def _stretch(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which a word equals the one a period later."""
    end, step, n = at, 64, len(ids) - period
    while end < n:
        to = min(end + step, n)
        other = np.flatnonzero(ids[end:to] != ids[end + period : to + period])
        if len(other):
            end += int(other[0])
            break
        end, step = to, 2 * step
    start, step = at, 64
    while start > 0:
        since = max(start - step, 0)
        other = np.flatnonzero(ids[since:start] != ids[since + period : start + period])
        if len(other):
            start = since + int(other[-1]) + 1
            break
        start, step = since, 2 * step
    return start, end


class _Found:
    """Runs so far, to ask which of them hold a stretch."""

    def __init__(self) -> None:
        self.runs: dict[tuple[int, int], int] = {}
        self._sort()

    def add(self, runs: dict[tuple[int, int], int]) -> None:
        for place, period in runs.items():
            self.runs.setdefault(place, period)
        if runs:
            self._sort()

    def _sort(self) -> None:
        rows = np.array(sorted((s, e, p) for (s, e), p in self.runs.items()), np.int64).reshape(-1, 3)
        self.starts = rows[:, 0]
        # of the runs that start no later, the one that reaches furthest
        far = np.maximum.accumulate(rows[:, 1]) if len(rows) else rows[:, 1]
        which = np.maximum.accumulate(np.where(rows[:, 1] == far, np.arange(len(rows)), 0))
        self.ends, self.periods = rows[which, 1], rows[which, 2]

    def period(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Period of a run that holds each [start, end), else 0."""
        if not len(self.starts):
            return np.zeros(len(starts), np.int64)
        at = np.searchsorted(self.starts, starts, "right") - 1
        held = (at >= 0) & (self.ends[at] >= ends)
        return np.where(held, self.periods[at], 0)


def _seeds(x: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of the blocks that occur again, by distance and place."""
    places, distances = [], []
    width = max(1, SLAB // (2 * size))
    for at in range(0, len(starts), width):
        some = starts[at : at + width]
        distance, which = np.nonzero(mismatches(x, some, size) == 0)
        places.append(some[which])
        distances.append(distance + size)
    places, distances = np.concatenate(places), np.concatenate(distances)
    order = np.lexsort((places, distances))
    return places[order], distances[order]


def runs_of(ids: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs of the words, by start and period.

    ``ids`` are small whole numbers, equal for equal words; no run is longer than ``longest``.
    """
    n, found = len(ids), _Found()
    longest = n if longest is None else longest
    gaps, size = _gaps(ids), 1
    while PERIODS * size <= longest:
        if size > 1:  # greatest gap in every block of this scale
            gaps = np.maximum(gaps[0::2], np.append(gaps[1::2], np.full(len(gaps) % 2, 4 * n + 1)))
        recurs = gaps < 2 * size
        starts = np.flatnonzero(recurs[:-1] & recurs[1:]) * size
        starts = starts[found.period(starts, starts + 3 * size) == 0]
        if len(starts):
            # words that no block can match, beyond the end
            x = np.concatenate([ids, n + 1 + np.arange(4 * size)]).astype(np.uint64)
            found.add(_extend_seeds(ids, found, *_seeds(x, starts, size)))
        size *= 2
    return sorted((s, e - s, p) for (s, e), p in found.runs.items())


def _extend_seeds(ids: np.ndarray, found: _Found, places: np.ndarray, distances: np.ndarray) -> dict[tuple[int, int], int]:
    new: dict[tuple[int, int], int] = {}
    for period in np.unique(distances):
        of_period = places[np.searchsorted(distances, period) : np.searchsorted(distances, period, "right")]
        at = 0
        while at < len(of_period):
            start, end = _stretch(ids, int(of_period[at]), int(period))
            whole = (start, end + int(period))
            if whole[1] - whole[0] >= max(WORDS, PERIODS * period) and whole not in found.runs:
                new.setdefault(whole, int(period))
            at = max(at + 1, int(np.searchsorted(of_period, end)))
    return new


def _numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all documents as numbers, a number of its own after each, and where each begins."""
    known: dict[bytes, int] = {}
    ids: list[int] = []
    starts = np.zeros(len(documents), np.int64)
    for k, words in enumerate(documents):
        starts[k] = len(ids)
        ids += [known.setdefault(w, len(known)) for w in words]
        ids.append(-k - 1)
    out = np.array(ids, np.int64)
    # marks follow the words' numbers, so that all are small and none is negative
    return np.where(out < 0, len(known) - out - 1, out), starts


def search(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[bytes], list[int]]:
    """Runs of each text, its words without repeated periods, joined by spaces, and their number before."""
    documents = [t.split() for t in texts]  # of bytes: at ASCII white space
    ids, starts = _numbered(documents)
    repeated = np.zeros(len(ids), bool)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs_of(ids, max(map(len, documents), default=0)):
        k = int(np.searchsorted(starts, start, "right")) - 1
        runs[k].append((start - int(starts[k]), length, period))
        repeated[start + period : start + length] = True
    kept = []
    for k, words in enumerate(documents):
        gone = repeated[starts[k] : starts[k] + len(words)]
        kept.append(b" ".join(w for w, out in zip(words, gone.tolist()) if not out) if runs[k] else b" ".join(words))
    return runs, kept, [len(words) for words in documents]


def periodic_runs(documents: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """All columns, the runs, the text without repeated periods and the number of words; and their names.

    A run is a stretch of words with smallest period q, at least 4q and 6 words long, that no
    neighbouring word extends with that period. Of each run only the first q words stay.
    """
    names = {n: free_name(documents, n) for n in ("runs", "collapsed", "n_words")}

    def compute(texts: list[bytes]) -> list[pa.Array]:
        runs, kept, sizes = search(texts)
        rows = [[dict(zip(("start", "length", "period"), r)) for r in some] for some in runs]
        return [pa.array(rows, pa.list_(_ARROW_RUN)), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64())]

    kinds = {"runs": T.ArrayType(RUN), "collapsed": T.StringType(), "n_words": T.LongType()}
    return extend(documents, [T.StructField(names[n], kinds[n]) for n in names], compute, text), names
