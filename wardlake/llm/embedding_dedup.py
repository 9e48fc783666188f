"""Embedding near-dedup with one small-world graph per shard.

Equal vectors count as one. Every shard's graph is searched with every vector; beams widen while
the bound does not end them. A fixed audit set is compared with all vectors exactly, and the search
repeats with wider beams until the audit's recall is reached. Every pair found is verified by its
cosine in double precision, and linked vectors form components.

Two shards meet in one task, which searches each one's graph with the other's vectors, so every pair
of vectors belongs to one task. It gives sums per vector and what its links connect, not the links.
Shards are read from their files where they meet: no shuffle carries them.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm import small_world
from wardlake.llm.common import Scratch
from wardlake.llm.components import components

#: Rows of a shard at most, about; shards at least.
SHARD_ROWS, LEAST_SHARDS = 16_384, 8
BEAM, AUDITED, RECALL = 16, 256, 0.99
#: The graphs hold single precision; pairs this close to the bound are verified too.
_SLACK = 1e-4
#: Pairs verified at once; cells of the pair table looked at together.
_PAIRS, _CELLS = 1 << 16, 1 << 23
#: What a row about a pair of shards says: copies among a vector's links, a link, a pair of an audited vector.
_COPIES, _LINK, _AUDITED = 0, 1, 2


def _unit(flat: bytes, rows: int, size: int) -> np.ndarray:
    x = np.frombuffer(flat, np.float32 if len(flat) == 4 * rows * size else np.float64).reshape(rows, size).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, v, usable`` with a row number; components in double precision unless they are single."""
    v = F.col("embedding")
    if vectors.schema["embedding"].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = F.coalesce(v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), fine.alias("usable")).withColumn(
        "row", F.monotonically_increasing_id()
    )


def _shards(distinct: DataFrame, groups: int) -> DataFrame:
    """Vectors of one length dealt by hash into groups: ``size, shard, ids, copies, flat``."""
    dealt = distinct.select("rep", "copies", "v", F.size("v").alias("size"), F.pmod(F.xxhash64("rep", F.lit(2)), F.lit(groups)).alias("shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def closed(key: tuple[int, int]) -> pa.RecordBatch:
            ids, copies, flat = held.pop(key)
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (ids, copies)]
            columns = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), *lists, pa.array([b"".join(flat)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["size", "shard", "ids", "copies", "flat"])

        for batch in batches:
            values, offsets = batch.column("v").values.to_numpy(zero_copy_only=False), batch.column("v").offsets.to_numpy()
            for size, shard, rep, n, a, b in zip(*(batch.column(c).to_pylist() for c in ("size", "shard", "rep", "copies")), offsets[:-1], offsets[1:]):
                key = (size, shard)
                if key not in held:
                    for other in list(held):  # rows come sorted by group
                        yield closed(other)
                    held[key] = ([], [], [])
                held[key][0].append(rep)
                held[key][1].append(n)
                held[key][2].append(values[a:b].tobytes())
        for key in list(held):
            yield closed(key)

    # a number of partitions of its own: small shards are not gathered into a few files, few share one
    sorted_rows = dealt.repartition(4 * groups, "size", "shard").sortWithinPartitions("size", "shard", "rep")
    return sorted_rows.mapInArrow(run, "size int, shard long, ids array<long>, copies array<long>, flat binary")


def _graphs(shards: DataFrame) -> DataFrame:
    """One graph per shard, as binary columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = small_world.build(_unit(row["flat"], len(row["ids"]), row["size"]).astype(np.float32))
                out = row | {
                    "nodes": [x.astype(np.int32).tobytes() for x, _ in levels],
                    "links": [x.astype(np.int32).tobytes() for _, x in levels],
                }
                yield pa.RecordBatch.from_pylist([out], schema=_GRAPH)

    return shards.mapInArrow(run, "size int, shard long, ids array<long>, copies array<long>, flat binary, nodes array<binary>, links array<binary>")


_GRAPH = pa.schema(
    [("size", pa.int32()), ("shard", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("ids", "copies")]
    + [("flat", pa.binary())]
    + [(c, pa.list_(pa.binary())) for c in ("nodes", "links")]
)


class _Shard:
    """A shard with its graph, as columns of one row."""

    def __init__(self, row: dict, mark: str = ""):
        of = lambda name: row[name + mark]
        self.ids, self.copies = np.array(of("ids"), np.int64), np.array(of("copies"), np.float64)
        self.exact = _unit(of("flat"), len(self.ids), row["size"])
        self.single = self.exact.astype(np.float32)
        nodes = [np.frombuffer(x, np.int32) for x in of("nodes")]
        self.levels = [(n, np.frombuffer(x, np.int32).reshape(len(n), -1)) for n, x in zip(nodes, of("links"))]


def _verified(queries: _Shard, shard: _Shard, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for q, n in small_world.within_parts(shard.single, shard.levels, queries.single, least - _SLACK, beam):
        for at in range(0, len(q), _PAIRS):
            a, b = q[at : at + _PAIRS], n[at : at + _PAIRS]
            good = np.einsum("kd,kd->k", queries.exact[a], shard.exact[b]) >= least
            yield a[good], b[good]


def _pair_table(one: _Shard, other: _Shard, same: bool, least: float, beam: int) -> np.ndarray:
    """A bit for every pair that either search finds, a row per vector of ``one``."""
    bits = np.zeros((len(one.ids), (len(other.ids) + 7) // 8), np.uint8)

    def put(a: np.ndarray, b: np.ndarray) -> None:
        np.bitwise_or.at(bits, (a, b >> 3), np.left_shift(1, b & 7).astype(np.uint8))

    for a, b in _verified(one, other, least, beam):
        put(a, b)
        if same:
            put(b, a)
    if not same:
        for b, a in _verified(other, one, least, beam):
            put(a, b)
    return bits


def _connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all nodes that the links ``a, b`` connect the smallest of their labels; a label names a node."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, above := label[label]):
            label[:] = above


def _met(one: _Shard, other: _Shard, same: bool, least: float, beam: int, audited: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What two shards, or one with itself, have to say about their pairs: rows ``kind, a, b``."""

    def rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], ["kind", "a", "b"])

    bits = _pair_table(one, other, same, least, beam)
    first = 0 if same else len(one.ids)  # the nodes of the other shard are numbered from here
    ids = one.ids if same else np.concatenate([one.ids, other.ids])
    copies, label, seen = np.zeros(len(ids)), np.arange(len(ids)), np.isin(ids, audited)
    step = max(1, _CELLS // len(other.ids))
    for at in range(0, len(bits), step):
        a, b = np.nonzero(np.unpackbits(bits[at : at + step], axis=1, count=len(other.ids), bitorder="little"))
        a = a + at
        if same:
            a, b = a[a < b], b[a < b]
        copies += np.bincount(a, other.copies[b], len(ids))
        copies += np.bincount(b + first, one.copies[a], len(ids))
        _connect(label, a, b + first)
        shown = seen[a] | seen[b + first]
        x, y = one.ids[a[shown]], other.ids[b[shown]]
        yield rows(_AUDITED, np.minimum(x, y), np.maximum(x, y))
    some = np.flatnonzero(copies)
    yield rows(_COPIES, ids[some], copies[some].astype(np.int64))
    inner = np.flatnonzero(label != np.arange(len(ids)))
    yield rows(_LINK, ids[inner], ids[label[inner]])


def _searched(graphs: DataFrame, least: float, beam: int, audited: np.ndarray) -> DataFrame:
    """Rows ``kind, a, b`` of every two shards of one vector length, and of every shard with itself."""
    audited = graphs.sparkSession.sparkContext.broadcast(audited)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _met(_Shard(row), _Shard(row, "_"), row["shard"] == row["shard_"], least, beam, audited.value)

    # every vector meets every shard of its length by the contract of the method; which of two
    # shards comes first alternates, so that the tasks share the work, whatever shards a file holds
    others = graphs.select(*[F.col(c).alias(f"{c}_") for c in graphs.columns])
    low_first = (F.col("shard") + F.col("shard_")) % 2 == 0
    once = (F.col("shard") == F.col("shard_")) | (low_first == (F.col("shard") < F.col("shard_")))
    met = graphs.join(others.hint("shuffle_replicate_nl"), (F.col("size") == F.col("size_")) & once)
    return met.drop("size_").mapInArrow(run, "kind int, a long, b long")


def _audit(distinct: DataFrame, least: float) -> tuple[DataFrame, np.ndarray]:
    """All pairs of the audited vectors, by comparing them with every vector, and who these are; their number is fixed."""
    chosen = distinct.orderBy(F.xxhash64("rep", F.lit(7)), "rep").limit(AUDITED).select("rep", "v").collect()
    by_size: dict[int, tuple[list, list]] = {}
    for r in chosen:
        ids, rows = by_size.setdefault(len(r.v), ([], []))
        ids.append(r.rep)
        rows.append(r.v)
    shared = distinct.sparkSession.sparkContext.broadcast({k: (np.array(i), _unit(np.array(v, np.float64).tobytes(), len(i), k)) for k, (i, v) in by_size.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            sizes, reps = np.array(batch.column("size").to_pylist()), batch.column("rep").to_numpy()
            for size, (ids, audited) in shared.value.items():
                at = np.flatnonzero(sizes == size)
                if len(at):
                    x = np.array(batch.column("v").take(pa.array(at)).to_pylist(), np.float64)
                    near = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ audited.T >= least
                    i, j = np.nonzero(near)
                    a, b = reps[at[i]], ids[j]
                    found_a.append(np.minimum(a, b)[a != b])
                    found_b.append(np.maximum(a, b)[a != b])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], ["a", "b"])

    pairs = distinct.select("rep", "v", F.size("v").alias("size")).mapInArrow(run, "a long, b long").distinct()
    return pairs, np.array([r.rep for r in chosen], np.int64)


def similar_vectors(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors that are null, zero or hold null or non-finite components link with nothing, nor do
    vectors of different length. Repeated vectors count as links of each other; a null ``vec_id``
    stays null and is never the smallest. An empty table gives no row; other columns are not used.
    """
    scratch = Scratch(vectors.sparkSession, "embeddings")
    known = scratch.keep(_usable(vectors), "known")
    distinct = scratch.keep(known.filter("usable").groupBy("v").agg(F.min("row").alias("rep"), F.count("*").alias("copies")), "distinct")
    weights = scratch.keep(distinct.select("rep", "copies"), "weights")
    named = scratch.keep(known.filter("usable").select("vec_id", "v").join(distinct.select("v", "rep"), "v").select("vec_id", "rep"), "named")
    alone = scratch.keep(known.filter("not usable").select("vec_id"), "alone")
    scratch.drop("known")
    n = weights.count()
    rows = min(SHARD_ROWS, max(1, math.ceil(n / LEAST_SHARDS)))
    pairs, audited = _audit(distinct, least)
    truth = scratch.keep(pairs, "audit")
    shards = scratch.keep(_shards(distinct, max(1, math.ceil(n / rows))), "shards")
    scratch.drop("distinct")
    graphs = scratch.keep(_graphs(shards), "graphs", rows_at_once=1)
    scratch.drop("shards")
    wanted, beam, turn = truth.count(), BEAM, 0
    while True:
        met = scratch.keep(_searched(graphs, least, beam, audited), f"met-{turn}", rows_at_once=1)
        missed = scratch.keep(truth.join(met.filter(F.col("kind") == _AUDITED), ["a", "b"], "left_anti"), f"missed-{turn}")
        if not wanted or beam >= rows or wanted - missed.count() >= RECALL * wanted:
            break
        scratch.drop(f"met-{turn}", f"missed-{turn}")
        beam, turn = 4 * beam, turn + 1
    scratch.drop("graphs")
    # what the audit saw exactly belongs to the links too
    roots = scratch.keep(components(met.filter(F.col("kind") == _LINK).select("a", "b").union(missed), scratch, "roots"), "rooted")
    both = missed.union(missed.select("b", "a")).toDF("rep", "other")
    more = both.join(weights.withColumnRenamed("rep", "other"), "other").select("rep", "copies")
    linked = met.filter(F.col("kind") == _COPIES).select("a", "b").union(more).toDF("rep", "others").groupBy("rep").agg(F.sum("others").alias("others"))
    counted = weights.join(linked, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    counted = counted.select("rep", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    counted = scratch.keep(counted, "counted")
    placed = scratch.keep(named.join(counted, "rep").select("vec_id", "n_links", "root"), "placed")
    smallest = scratch.keep(placed.groupBy("root").agg(F.min("vec_id").alias("component_id")), "smallest")
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = placed.join(smallest, "root").select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
