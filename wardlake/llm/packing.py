"""Packing along a space-filling curve.

Each document's ids are hashed into a signed vector, projected to three dimensions, scaled by the
corpus' mean and deviation, and placed on a Hilbert curve. Documents in curve order are laid end to
end and cut every ``length`` tokens, so neighbours in content share sequences and only the last
sequence can be short.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import chunks, mix, stash
from wardlake.llm.encode import encoder

BUCKETS, DIMENSIONS, BITS = 256, 3, 16
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _projection() -> np.ndarray:
    """A fixed matrix of pseudo-random directions, the same in every task."""
    drawn = mix(np.arange(1, BUCKETS * DIMENSIONS + 1, dtype=np.uint64))
    return (drawn.astype(np.float64) / 2.0**63 - 1).reshape(BUCKETS, DIMENSIONS)


def project(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Coordinates of each document, whose ids are ``ids[bounds[i]:bounds[i + 1]]``."""
    n = len(bounds) - 1
    drawn = mix(ids.astype(np.uint64) + np.uint64(1))
    cell = np.repeat(np.arange(n), np.diff(bounds)) * BUCKETS + (drawn % BUCKETS).astype(np.int64)
    sign = 1.0 - 2.0 * (drawn >> np.uint64(63)).astype(np.float64)
    vectors = np.bincount(cell, sign, n * BUCKETS).reshape(n, BUCKETS)
    vectors = np.sign(vectors) * np.sqrt(np.abs(vectors))
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors @ _projection() / np.where(lengths > 0, lengths, 1)


def hilbert_key(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits per axis (rows are points)."""
    x = [axes[:, i].astype(np.int64) for i in range(axes.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            is_set = (x[i] >> level) & 1 == 1
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key


def _encoded(documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Written once: ids, token count and coordinates of every document row, with a row number."""
    axes = [f"x{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.kind).tobytes()
        for batch, texts in chunks(batches):
            found = [ids + end for ids in enc.encode(texts)]
            sizes = np.array([len(x) // enc.kind.itemsize for x in found], np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            at = project(np.frombuffer(b"".join(found), enc.kind), bounds)
            columns = [batch.column("doc_id"), pa.array(sizes), pa.array(found, pa.binary()), *map(pa.array, at.T)]
            wide = pa.array(np.full(len(sizes), enc.kind.itemsize, np.int32))
            yield pa.RecordBatch.from_arrays([*columns, wide], ["doc_id", "doc_tokens", "ids", *axes, "width"])

    schema = f"doc_id long, doc_tokens long, ids binary, {', '.join(a + ' double' for a in axes)}, width int"
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stash(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "encoded")


def _curve_order(encoded: DataFrame) -> DataFrame:
    """``row, first``: the tokens before each document along the curve. Ids are not read here.

    The order is range-sorted on narrow rows; the driver sees one total per partition.
    """
    axes = [f"x{i}" for i in range(DIMENSIONS)]
    stats = encoded.agg(*(F.mean(a).alias(f"m{a}") for a in axes), *(F.stddev_pop(a).alias(f"s{a}") for a in axes)).first()
    mean = np.array([stats[f"m{a}"] or 0.0 for a in axes])
    spread = np.array([stats[f"s{a}"] or 1.0 for a in axes])

    @F.pandas_udf("long")
    def place(x0: pd.Series, x1: pd.Series, x2: pd.Series) -> pd.Series:
        z = (np.stack([x0, x1, x2], axis=1) - mean) / spread
        even = 1 / (1 + np.exp(-1.702 * z))  # close to the normal distribution's share below z
        return pd.Series(hilbert_key(np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column("doc_tokens").to_numpy()
            ends = before + np.cumsum(sizes)
            columns = [batch.column("row"), pa.array(np.full(len(sizes), part, np.int32)), pa.array(ends - sizes), pa.array(sizes)]
            before = int(ends[-1]) if len(ends) else before
            yield pa.RecordBatch.from_arrays(columns, ["row", "part", "local", "size"])

    keyed = encoded.select("row", "doc_tokens", place(*axes).alias("key"))
    ordered = keyed.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    placed = stash(ordered.mapInArrow(run, "row long, part int, local long, size long"), "curve")
    bases, before = [], 0
    for r in sorted(placed.groupBy("part").agg(F.sum("size").alias("n")).collect()):
        bases.append((r.part, before))
        before += r.n
    base = F.broadcast(encoded.sparkSession.createDataFrame(bases, "part int, base long"))
    return placed.join(base, "part").select("row", (F.col("base") + F.col("local")).alias("first"))


def pack(documents: DataFrame, tokenizer: str, end_id: int, length: int = 4096) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens.

    Each piece has its document's id, the document's tokens before it (``start``), its ``ids``
    (unsigned 32-bit, little endian), the document's token count with ``end_id``, and its place:
    ``sequence_id`` and ``offset``, gapless from 0. Every id lies in exactly one piece. Null texts
    are empty documents of the end id alone, null ids stay null, repeated rows are packed each,
    equal keys follow in row order. An empty table gives no piece; other columns are not used.
    """
    encoded = _encoded(documents, tokenizer, end_id)
    order = _curve_order(encoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("first").to_numpy()
            sizes = batch.column("doc_tokens").to_numpy()
            n = (first + sizes - 1) // length - first // length + 1
            doc = np.repeat(np.arange(len(first)), n)
            step = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            sequence = first[doc] // length + step
            begin = np.maximum(sequence * length, first[doc])
            stop = np.minimum((sequence + 1) * length, (first + sizes)[doc])
            ids = batch.column("ids").to_pylist()
            kinds = ["<u2" if w == 2 else "<u4" for w in batch.column("width").to_pylist()]
            whole = [np.frombuffer(x, k).astype("<u4") for x, k in zip(ids, kinds)]
            cut = [whole[d][a:b].tobytes() for d, a, b in zip(doc, begin - first[doc], stop - first[doc])]
            columns = [batch.column("doc_id").take(pa.array(doc)), begin - first[doc], stop - begin, sizes[doc], sequence, begin % length]
            arrays = [columns[0], *(pa.array(c, pa.int64()) for c in columns[1:]), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    together = encoded.select("row", "doc_id", "doc_tokens", "ids", "width").join(order, "row")
    return together.mapInArrow(run, PIECES)


def sequences(pieces: DataFrame, length: int = 4096, pad_id: int = 0) -> DataFrame:
    """Whole sequences: ``sequence_id``, ``ids``, ``n_tokens`` without padding, ``doc_ids``.

    A sequence is padded to ``length`` unless its own token count is a power of two.
    """
    part = F.struct("offset", "ids", "doc_id")
    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.sum("length").alias("n_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, docs = [], []
            for parts, n in zip(batch.column("parts").to_pylist(), batch.column("n_tokens").to_pylist()):
                pad = 0 if n & (n - 1) == 0 else length - n
                whole.append(b"".join(p["ids"] for p in parts) + np.full(pad, pad_id, "<u4").tobytes())
                docs.append([p["doc_id"] for p in parts])
            columns = [batch.column("sequence_id"), pa.array(whole, pa.binary()), batch.column("n_tokens"), pa.array(docs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["sequence_id", "ids", "n_tokens", "doc_ids"])

    return grouped.mapInArrow(run, "sequence_id long, ids binary, n_tokens long, doc_ids array<long>")
