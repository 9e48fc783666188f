"""Hard negatives by a vertical scan (BOND): dimensions are read as columns, the anchor's largest first.

A shard is a few megabytes of vectors, stored dimension by dimension, with the least and greatest
value of each. For one anchor its dimensions are read in descending magnitude. After some of them,
a row's score lies between what it has so far plus the least, and plus the greatest, that the unread
dimensions can still add. Rows whose bounds show that they cannot be among the best, or in no
wanted window, leave the candidate set; the scores of the rest become exact at the last dimension.

Anchors are a stated query set. They come in blocks of bounded size, and every block is scanned
against all rows where these lie: the vectors themselves are never shuffled. A task gives at most
``positives`` rows (then ``negatives`` per positive) per anchor, and one small shuffle ranks them.

Rows take part if they have an id, a label, and a vector without null or non-finite components;
only vectors of one length are compared. A row with the anchor's own id is never its partner.
Repeated rows count as often as they occur. Equal scores go by the smaller id.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.common import Scratch

#: Components become floor(SCALE * x).
SCALE = 256
#: Bytes of a shard's columns, and of the anchors that are scanned together.
SHARD_BYTES, BLOCK_BYTES = 8 << 20, 16 << 20
#: Rows in one batch from Spark; shards are made of whole batches.
ROWS = 1000
#: Dimensions between two looks at the bounds.
STEP = 8

#: (least, greatest) score a negative may have for one positive; none when the first is greater.
Window_ = tuple[int, int]


def whole(values: np.ndarray) -> np.ndarray:
    """Components as integers; refused when an inner product of them could leave 64 bits."""
    scaled = np.floor(values * SCALE)
    if scaled.size and np.abs(scaled).max() > math.isqrt((1 << 62) // values.shape[1]):
        raise ValueError("components too large for scores of 64 bits")
    return scaled.astype(np.int64)


class Shard:
    """Vectors of one length, column by column."""

    def __init__(self, ids: np.ndarray, labels: list, vectors: np.ndarray):
        self.ids = ids
        self.codes: dict = {}
        self.labels = np.fromiter((self.codes.setdefault(x, len(self.codes)) for x in labels), np.int64, len(ids))
        self.columns = np.ascontiguousarray(vectors.T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def others(self, anchor_id: int, label, same: bool) -> np.ndarray:
        """Places of rows that have, or have not, the anchor's label and not its id."""
        alike = self.labels == self.codes.get(label, -1)
        return np.flatnonzero((alike if same else ~alike) & (self.ids != anchor_id))

    def scan(self, anchor: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of the rows that ``keep(least, greatest)`` never excludes."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = anchor[order] * np.stack([self.low[order], self.high[order]])
        # what the dimensions from each place on can add
        least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        score = np.zeros(len(rows), np.int64)
        for at in range(0, len(order), STEP):
            for dimension in order[at : at + STEP]:
                score += anchor[dimension] * self.columns[dimension][rows]
            read = min(at + STEP, len(order))
            stays = keep(score + least[read], score + most[read])
            if not stays.all():
                rows, score = rows[stays], score[stays]
            if not len(rows):
                break
        return rows, score


def _usable(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list, np.ndarray]]:
    """(ids, labels, vectors) of the rows that take part, by length of the vector."""
    lists = batch.column("embedding")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null is not a number here
    ends = np.cumsum(sizes)
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        of_size = np.flatnonzero(sizes == size)
        vectors = values[(ends[of_size] - size)[:, None] + np.arange(size)]
        fine = np.isfinite(vectors).all(axis=1)
        if size and fine.any():
            yield ids[of_size[fine]], batch.column("label").take(pa.array(of_size[fine])).to_pylist(), whole(vectors[fine])


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    held: dict[int, list] = {}
    weight: dict[int, int] = {}

    def close(size: int) -> Shard:
        ids, labels, vectors = zip(*held.pop(size))
        weight.pop(size)
        return Shard(np.concatenate(ids), [x for some in labels for x in some], np.concatenate(vectors))

    for batch in batches:
        for part in _usable(batch):
            size = part[2].shape[1]
            held.setdefault(size, []).append(part)
            weight[size] = weight.get(size, 0) + part[2].nbytes
            if weight[size] >= SHARD_BYTES:
                yield close(size)
    for size in list(held):
        yield close(size)


class Best:
    """The ``most`` best (score, id) so far: greater scores first, then smaller ids."""

    def __init__(self, most: int):
        self.most, self.scores, self.ids = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[: self.most]
        self.scores, self.ids = scores[first], ids[first]

    def bar(self, certain: np.ndarray) -> int | None:
        """A score that ``most`` rows reach for certain, by those found and least scores of others."""
        bars = [int(self.scores[-1])] if len(self.scores) == self.most else []
        if len(certain) >= self.most:
            bars.append(int(np.partition(certain, -self.most)[-self.most]))
        return max(bars, default=None)


def nearest(batches: Iterator[pa.RecordBatch], anchors: list, most: int) -> list[Best]:
    """The best rows of the same label for each (id, label, vector)."""
    best = [Best(most) for _ in anchors]
    for shard in shards(batches):
        for (anchor_id, label, vector), found in zip(anchors, best):
            if len(vector) != len(shard.columns):
                continue

            def keep(least: np.ndarray, greatest: np.ndarray, found: Best = found) -> np.ndarray:
                bar = found.bar(least)
                return greatest >= bar if bar is not None else np.ones(len(least), bool)

            rows, scores = shard.scan(vector, shard.others(anchor_id, label, True), keep)
            found.add(scores, shard.ids[rows])
    return best


def in_windows(batches: Iterator[pa.RecordBatch], anchors: list, windows: list[list[Window_]], most: int) -> list[list[Best]]:
    """The best rows of another label in each window of each anchor."""
    best = [[Best(most) for _ in some] for some in windows]
    for shard in shards(batches):
        for (anchor_id, label, vector), some, found in zip(anchors, windows, best):
            wanted = [(lo, hi, b) for (lo, hi), b in zip(some, found) if lo <= hi]
            if not wanted or len(vector) != len(shard.columns):
                continue

            def keep(least: np.ndarray, greatest: np.ndarray, wanted=wanted) -> np.ndarray:
                stays = np.zeros(len(least), bool)
                for lo, hi, b in wanted:
                    bar = b.bar(least[(least >= lo) & (greatest <= hi)])
                    stays |= (greatest >= (lo if bar is None else max(lo, bar))) & (least <= hi)
                return stays

            rows, scores = shard.scan(vector, shard.others(anchor_id, label, False), keep)
            for lo, hi, b in wanted:
                inside = (scores >= lo) & (scores <= hi)
                b.add(scores[inside], shard.ids[rows[inside]])
    return best


def _ranked(df: DataFrame, of: list[str], score: str, row_id: str, most: int, rank: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*of).orderBy(F.desc(score), row_id))
    return df.withColumn(rank, place).filter(F.col(rank) <= most)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` picks, from columns vec_id, embedding and label.

    Positives are an anchor's best rows of its label. Negatives of a positive are the best rows of
    another label whose score is from ``least`` to ``most`` hundredths of the positive's. Returns
    anchor_id, positive_id, rank (of the negative), negative_id, positive_score, negative_score.
    """
    scratch = Scratch(rows.sparkSession, "hard-negatives")
    usable = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    usable = usable.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    chosen = scratch.keep(usable.filter(anchors).withColumn("anchor", F.monotonically_increasing_id()), "anchors", ROWS)
    n_bytes = chosen.agg(F.sum(8 * F.size("embedding").cast("long"))).head()[0] or 0
    n_blocks = -(-2 * n_bytes // BLOCK_BYTES) if n_bytes > BLOCK_BYTES else 1  # even if hashing is uneven
    kept = [_mine_block(usable, chosen.filter(F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)) == b), scratch, b, positives, negatives, least, most) for b in range(n_blocks)]
    found = rows.sparkSession.read.schema(kept[0].schema).parquet(*[f"{scratch.base}/found-{b}" for b in range(n_blocks)])
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _mine_block(usable: DataFrame, chosen: DataFrame, scratch: Scratch, block: int, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    """One block of anchors against all rows, twice: positives, then windows below each."""
    anchors, keys = [], []
    for batch in chosen.toArrow().to_batches():  # at most about BLOCK_BYTES
        by_vector = {int(i): k for k, i in enumerate(batch.column("anchor").to_pylist())}
        if not by_vector:
            continue
        numbered = batch.set_column(batch.schema.get_field_index("vec_id"), "vec_id", batch.column("anchor"))
        ids = batch.column("vec_id").to_pylist()
        for found, labels, vectors in _usable(numbered):
            keys += found.tolist()
            anchors += [(ids[by_vector[int(i)]], x, v) for i, x, v in zip(found, labels, vectors)]

    def positives_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = nearest(batches, anchors, positives)
        at = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
        columns = [at, *(np.concatenate([np.zeros(0, np.int64), *(getattr(b, c) for b in best)]) for c in ("ids", "scores"))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["at", "positive_id", "positive_score"])

    near = usable.mapInArrow(positives_of, "at long, positive_id long, positive_score long")
    near = scratch.keep(_ranked(near, ["at"], "positive_score", "positive_id", positives, "place"), f"positives-{block}", ROWS)
    pairs: list[list[tuple[int, int]]] = [[] for _ in anchors]
    for row in near.orderBy("at", "place").toArrow().to_pylist():  # at most ``positives`` per anchor of the block
        pairs[row["at"]].append((row["positive_id"], row["positive_score"]))
    windows = [[(-(-least * p // 100), most * p // 100) for _, p in some] for some in pairs]

    def negatives_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for at, found in enumerate(in_windows(batches, anchors, windows, negatives)):
            for place, b in enumerate(found):
                out += [(at, place, anchors[at][0], *pairs[at][place], int(i), int(s)) for i, s in zip(b.ids, b.scores)]
        names = ["at", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * len(names), names)

    schema = "at long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    hard = _ranked(usable.mapInArrow(negatives_of, schema), ["at", "place"], "negative_score", "negative_id", negatives, "rank")
    return scratch.keep(hard, f"found-{block}", ROWS)
