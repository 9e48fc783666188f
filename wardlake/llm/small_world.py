"""Hierarchical navigable small-world graphs over unit vectors, built and searched in batches.

A graph covers one shard. Every node lies on level 0 and, with a probability that falls by the
number of links per level, on higher ones. On each level a node links to its nearest nodes, to
diverse near ones and to those that chose it. A search walks greedily down the levels and then
keeps a beam of the best nodes, expanding several of every query's beam at a time.
"""

from collections.abc import Iterator

import numpy as np

from wardlake.llm.common import mix

LINKS = 16
#: Nodes of a beam expanded at a time: so many, or this share of a wide beam.
_EXPANDED, _SHARE = 8, 8
#: Rows compared at once while a graph is built, and queries that walk through it together.
_BLOCK, _TOGETHER = 1024, 256
#: Places of beams that one part of a search holds, unless fewer queries than walk together have more.
_CELLS = 1 << 18


def _nearest(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest others of every vector and their cosines, nearest first."""
    n = len(vectors)
    ids, cosines = np.empty((n, k), np.int32), np.empty((n, k), np.float32)
    for at in range(0, n, _BLOCK):
        near = vectors[at : at + _BLOCK] @ vectors.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -2
        part = np.argpartition(-near, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(near, part, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        ids[at : at + len(near)] = np.take_along_axis(part, order, axis=1)
        cosines[at : at + len(near)] = np.take_along_axis(value, order, axis=1)
    return ids, cosines


def _diverse(vectors: np.ndarray, ids: np.ndarray, cosines: np.ndarray, wanted: int) -> np.ndarray:
    """Of each node's candidates those closer to it than to any candidate taken before; -1 fills up."""
    out = np.full((len(ids), wanted), -1, np.int32)
    for at in range(0, len(ids), _BLOCK):
        near, value = ids[at : at + _BLOCK], cosines[at : at + _BLOCK]
        found = vectors[near]
        between = found @ found.transpose(0, 2, 1)
        rows = np.arange(len(near))
        closest, count = np.full(near.shape, -2.0, np.float32), np.zeros(len(near), np.int64)
        for j in range(near.shape[1]):
            take = (value[:, j] > closest[:, j]) & (count < wanted)
            out[at + rows[take], count[take]] = near[take, j]
            count += take
            closest[take] = np.maximum(closest[take], between[take, j])
    return out


def _level(vectors: np.ndarray, links: int) -> np.ndarray:
    """Links of every node among ``vectors``: nearest, diverse and reverse ones, each once; -1 fills up."""
    n = len(vectors)
    if n < 2:
        return np.full((n, 1), -1, np.int32)
    ids, cosines = _nearest(vectors, min(3 * links, n - 1))
    forward = np.concatenate([ids[:, :links], _diverse(vectors, ids, cosines, links)], axis=1)
    source = np.repeat(np.arange(n, dtype=np.int32), forward.shape[1])
    target = forward.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    rank = np.arange(len(target)) - np.searchsorted(target, target)
    reverse = np.full((n, links), -1, np.int32)
    few = rank < links
    reverse[target[few], rank[few]] = source[few]
    out = np.sort(np.concatenate([forward, reverse], axis=1), axis=1)
    out[:, :-1][out[:, :-1] == out[:, 1:]] = -1
    out = np.sort(out, axis=1)[:, ::-1]
    return np.ascontiguousarray(out[:, : max(1, int((out >= 0).sum(axis=1).max()))])


def build(vectors: np.ndarray, links: int = LINKS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the bottom: the nodes on it, and their links as positions among them."""
    n = len(vectors)
    drawn = (mix(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    height = np.floor(-np.log(np.maximum(drawn, 1e-300)) / np.log(links)).astype(np.int64)
    levels, nodes = [], np.arange(n, dtype=np.int32)
    while len(nodes):
        levels.append((nodes, _level(vectors[nodes], links)))
        if len(nodes) <= links:
            break
        nodes = np.flatnonzero(height >= len(levels)).astype(np.int32)
    return levels


def search(vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best nodes found for each query with their cosines, in no order; -1 fills up."""
    beam = min(beam, len(vectors))
    ids, cosines = np.full((len(queries), beam), -1, np.int32), np.full((len(queries), beam), -2, np.float32)
    for at in range(0, len(queries), _TOGETHER):
        some = queries[at : at + _TOGETHER]
        ids[at : at + len(some)], cosines[at : at + len(some)] = _search_block(vectors, levels, some, beam)
    return ids, cosines


def _descend(vectors: np.ndarray, levels: list, queries: np.ndarray) -> np.ndarray:
    """Greedy walk through the upper levels: a node of level 0 for every query."""
    top = levels[-1][0]
    now = top[np.argmax(queries @ vectors[top].T, axis=1)] if len(top) <= 4 * LINKS else np.full(len(queries), top[0])
    for nodes, links in reversed(levels[1:]):
        place = np.searchsorted(nodes, now)
        best = np.einsum("qd,qd->q", queries, vectors[nodes[place]])
        live = np.arange(len(queries))
        while len(live):
            near = links[place[live]]
            value = np.einsum("qd,qkd->qk", queries[live], vectors[nodes[np.maximum(near, 0)]])
            value[near < 0] = -2
            j = np.argmax(value, axis=1)
            step = value[np.arange(len(live)), j]
            better = step > best[live]
            live, near, j, step = live[better], near[better], j[better], step[better]
            place[live], best[live] = near[np.arange(len(live)), j], step
        now = nodes[place]
    return now


def _search_block(vectors: np.ndarray, levels: list, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    n, q = len(vectors), len(queries)
    # a missing link leads to a node after the last, which is never new and has no links
    links = np.pad(levels[0][1], ((0, 1), (0, 0)), constant_values=-1)
    links[links < 0] = n
    start = _descend(vectors, levels, queries)
    out_ids, out_cosines = np.full((q, beam), -1, np.int32), np.full((q, beam), -2, np.float32)
    ids, cosines, done = out_ids.copy(), out_cosines.copy(), np.ones((q, beam), bool)
    ids[:, 0], cosines[:, 0], done[:, 0] = start, np.einsum("qd,qd->q", queries, vectors[start]), False
    fresh = np.ones((q, n + 1), bool)
    fresh[np.arange(q), start], fresh[:, n] = False, False
    fresh = fresh.ravel()
    width = min(max(_EXPANDED, beam // _SHARE), beam)
    live = np.arange(q)
    while True:
        open_value = np.where(done, np.float32(-3), cosines)
        busy = (open_value > -3).any(axis=1)
        if not busy.all():
            out_ids[live[~busy]], out_cosines[live[~busy]] = ids[~busy], cosines[~busy]
            live, ids, cosines, done, open_value = (x[busy] for x in (live, ids, cosines, done, open_value))
        if not len(live):
            return out_ids, out_cosines
        pick = np.argpartition(-open_value, width - 1, axis=1)[:, :width]
        good = np.take_along_axis(open_value, pick, axis=1) > -3
        expanded = np.where(good, np.take_along_axis(ids, pick, axis=1), n)
        np.put_along_axis(done, pick, True, axis=1)
        rows, reached = [], []
        # one node's links differ, so what they reach first is new once
        for j in range(width):
            near = links[expanded[:, j]]
            place = live[:, None] * (n + 1) + near
            row, column = np.nonzero(fresh[place])
            fresh[place[row, column]] = False
            rows.append(row)
            reached.append(near[row, column])
        row, node = np.concatenate(rows), np.concatenate(reached)
        value = np.einsum("kd,kd->k", queries[live[row]], vectors[node])
        better = np.flatnonzero(value > cosines.min(axis=1)[row])
        if not len(better):
            continue
        better = better[np.argsort(row[better], kind="stable")]
        row, node, value = row[better], node[better], value[better]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        size = int(rank.max()) + 1
        more_ids, more_value = np.full((len(live), size), -1, np.int32), np.full((len(live), size), -2, np.float32)
        more_ids[row, rank], more_value[row, rank] = node, value
        all_ids = np.concatenate([ids, more_ids], axis=1)
        all_value = np.concatenate([cosines, more_value], axis=1)
        all_done = np.concatenate([done, more_ids < 0], axis=1)
        keep = np.argpartition(-all_value, beam - 1, axis=1)[:, :beam]
        ids, cosines, done = (np.take_along_axis(x, keep, axis=1) for x in (all_ids, all_value, all_done))


def within_parts(vectors: np.ndarray, levels: list, queries: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, node) with a cosine of at least ``least`` that the search finds, some queries at a time.

    The beam of a query is widened while a quarter of it lies within the bound, up to all nodes, so
    that no group of near vectors is cut off by the beam. Fewer queries go together as it widens.
    """
    live = np.arange(len(queries))
    while len(live):
        again, together = [], max(_TOGETHER, _CELLS // beam)
        for at in range(0, len(live), together):
            some = live[at : at + together]
            ids, cosines = search(vectors, levels, queries[some], beam)
            hit = (cosines >= least) & (ids >= 0)
            full = (hit.sum(axis=1) * 4 >= hit.shape[1]) & (hit.shape[1] < len(vectors))
            row, column = np.nonzero(hit & ~full[:, None])
            yield some[row], ids[row, column].astype(np.int64)
            again.append(some[full])
        live, beam = np.concatenate(again), 4 * beam


def within(vectors: np.ndarray, levels: list, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``within_parts`` at once."""
    nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    q, n = zip(nothing, *within_parts(vectors, levels, queries, least, beam))
    return np.concatenate(q), np.concatenate(n)
