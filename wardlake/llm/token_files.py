"""Token ids in directly addressable codes, written and read back by Spark.

An id is cut into bytes, lowest first. Level 0 holds the first byte of every id, level i the next
byte of those ids that need it. A bitmap per level marks the ids that continue, and a rank
directory counts the marks before every block of 512 bits, so the place of an id on the next level
is one count away: any token is read without decoding its neighbours.

A segment (one row of the written table) holds whole documents in ascending ``doc_id`` order with
their directory. Parts follow one another in the order of their number.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.common import chunks, writing
from wardlake.llm.encode import encoder

#: A segment is closed once it holds this many tokens; a longer document is a segment of its own.
SEGMENT_TOKENS = 1 << 18
_BLOCK_BITS = 512
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)

SEGMENT = (
    "part int, segment int, part_start long, n_tokens long, doc_ids array<long>, lengths array<long>, "
    "levels array<binary>, bitmaps array<binary>, ranks array<binary>"
)


def pack_levels(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Levels, continuation bitmaps and rank directories of unsigned 32-bit ids."""
    levels, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        levels.append((rest & 0xFF).astype(np.uint8).tobytes())
        goes_on = rest > 0xFF
        bits = np.packbits(goes_on, bitorder="little")
        counts = np.add.reduceat(_ONES[bits], np.arange(0, len(bits), _BLOCK_BITS // 8)) if len(bits) else np.zeros(0, np.int64)
        bitmaps.append(bits.tobytes())
        ranks.append(np.concatenate([[0], np.cumsum(counts)])[:-1].astype("<u4").tobytes() if len(counts) else b"")
        rest = rest[goes_on] >> 8
        if not len(rest):
            return levels, bitmaps, ranks


def unpack_levels(levels: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    out = np.frombuffer(levels[0], np.uint8).astype(np.uint32)
    at = np.arange(len(out))
    for i in range(1, len(levels)):
        goes_on = np.unpackbits(np.frombuffer(bitmaps[i - 1], np.uint8), bitorder="little", count=len(at)).astype(bool)
        at = at[goes_on]
        out[at] |= np.frombuffer(levels[i], np.uint8).astype(np.uint32) << np.uint32(8 * i)
    return out


def read_at(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], where: np.ndarray) -> np.ndarray:
    """The ids at some places of a segment, touching a byte per level and one block per rank."""
    at, out = np.asarray(where, np.int64), np.zeros(len(where), np.uint32)
    live = np.arange(len(at))
    for i, level in enumerate(levels):
        out[live] |= np.frombuffer(level, np.uint8)[at].astype(np.uint32) << np.uint32(8 * i)
        bits = np.frombuffer(bitmaps[i], np.uint8)
        goes_on = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        live, at = live[goes_on], at[goes_on]
        if not len(live):
            break
        directory = np.frombuffer(ranks[i], "<u4")
        block = at // _BLOCK_BITS
        rank = directory[block].astype(np.int64)
        for j, (b, p) in enumerate(zip(block, at)):
            first = b * _BLOCK_BITS // 8
            rank[j] += _ONES[bits[first : p >> 3]].sum() + _ONES[bits[p >> 3] & ((1 << (p & 7)) - 1)]
        at = rank
    return out


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every text, append ``end_id`` and write all ids in ascending ``doc_id`` order.

    Null texts are empty documents (the end id alone); a null ``doc_id`` comes first; rows that
    share a ``doc_id`` follow each other by text, repeated rows are kept. Other columns are not
    used. An empty table writes no segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], enc.kind).tobytes()
        held, docs, lengths, size, start, number = [], [], [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            levels = pack_levels(np.frombuffer(b"".join(held), enc.kind))
            row = dict(zip(("levels", "bitmaps", "ranks"), levels))
            row |= {"part": part, "segment": number, "part_start": start, "n_tokens": size, "doc_ids": docs, "lengths": lengths}
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT_ARROW)

        for batch, texts in chunks(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(texts)):
                held.append(ids + end)
                docs.append(doc_id)
                lengths.append(len(ids) // enc.kind.itemsize + 1)
                size += lengths[-1]
                if size >= SEGMENT_TOKENS:
                    yield closed()
                    held, docs, lengths, size, start, number = [], [], [], 0, start + size, number + 1
        if docs:
            yield closed()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    with writing(documents.sparkSession):
        ordered.mapInArrow(run, SEGMENT).write.parquet(path)


_SEGMENT_ARROW = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("doc_ids", "lengths")]
    + [(c, pa.list_(pa.binary())) for c in ("levels", "bitmaps", "ranks")]
)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The written segments, each with the number of tokens before it in all files (``start``).

    One total per written part reaches the driver, so at most as many rows as tasks wrote.
    """
    stored = spark.read.schema(SEGMENT).parquet(path)
    totals = sorted((r.part, r.n) for r in stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    bases, before = [], 0
    for part, n in totals:
        bases.append((part, before))
        before += n
    base = spark.createDataFrame(bases, "part int, base long")
    joined = stored.join(F.broadcast(base), "part")
    return joined.withColumn("start", F.col("base") + F.col("part_start")).drop("base")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of written files: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (unsigned 32-bit, little endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_levels(row["levels"], row["bitmaps"]).astype("<u4").tobytes()
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                texts = [ids[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [row["doc_ids"], row["start"] + ends - lengths, lengths, texts]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "n_tokens", "ids"])

    kept = segments(spark, path).select("start", "doc_ids", "lengths", "levels", "bitmaps")
    return kept.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """Random access: ``token_id`` at each ``position`` (counted over all files); others are left out.

    Positions meet segments on numbered blocks of the position axis, so nothing is broadcast.
    """
    block = F.lit(SEGMENT_TOKENS)
    stored = segments(spark, path)
    directory = stored.select("part", "segment", "start", (F.col("start") + F.col("n_tokens")).alias("end"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block)
    directory = directory.withColumn("block", F.explode(F.sequence(first, last)))
    wanted = positions.select(F.col("position").cast("long").alias("position")).filter("position >= 0")
    wanted = wanted.withColumn("block", F.floor(F.col("position") / block))
    near = wanted.join(directory, "block").filter("position >= start and position < end")
    places = near.groupBy("part", "segment").agg(F.collect_set("position").alias("places"))
    grouped = places.join(stored, ["part", "segment"]).select("places", "start", "levels", "bitmaps", "ranks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = np.array(sorted(row["places"]), np.int64)
                ids = read_at(row["levels"], row["bitmaps"], row["ranks"], places - row["start"])
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(ids.astype(np.int64))], ["position", "token_id"])

    return grouped.mapInArrow(run, "position long, token_id long")

