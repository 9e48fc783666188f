"""Quartile bucket digests: locality-sensitive fingerprints of byte triplets.

Every three neighbouring bytes are hashed into one of ``BUCKETS`` counters. A counter is written as
the quartile of the document's counters it lies in (two bits), after one byte for the length on a
logarithmic scale. Two digests differ by the sum of their quartile steps and their length steps,
bounded so that the likeness is between 0 and 1.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import CHUNK_BYTES, chunks, joined

BUCKETS = 1024
#: Documents counted at once; with the chunk size this bounds the counters in memory.
ROWS_AT_ONCE = 2048
_LENGTH_STEP = 1.1
_LENGTH_STEPS_AT_MOST = 16
#: Difference between quartiles by their distance; opposite ends count double.
_STEPS = np.array([0, 1, 2, 6])


def digests(texts: list[bytes]) -> np.ndarray:
    """One row per text: the length byte, then two bits per bucket."""
    n = len(texts)
    data, at = joined(texts)
    d = data.astype(np.uint32)
    doc = np.repeat(np.arange(n), np.diff(at))
    inside = doc[:-3] == doc[3:]  # each text ends with a line end, which no triplet may hold
    triplets = (d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16))[inside]
    cells = (triplets * np.uint32(2654435761)) >> np.uint32(22)
    counts = np.bincount(doc[:-3][inside] * BUCKETS + cells, minlength=n * BUCKETS).reshape(n, BUCKETS)
    places = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
    quartiles = np.partition(counts, places, axis=1)[:, places]
    codes = (counts[:, :, None] > quartiles[:, None, :]).sum(2).astype(np.uint8)
    packed = codes[:, 0::4] | codes[:, 1::4] << 2 | codes[:, 2::4] << 4 | codes[:, 3::4] << 6
    sizes = np.array([len(t) for t in texts], np.float64)
    length = np.minimum(255, np.log1p(sizes) / np.log(_LENGTH_STEP)).astype(np.uint8)
    return np.concatenate([length[:, None], packed], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of digests row by row: 1 for equal ones, 0 from a mean difference of two steps."""
    steps = np.zeros(len(a))
    for shift in (0, 2, 4, 6):
        apart = np.abs((a[:, 1:] >> shift & 3).astype(np.int8) - (b[:, 1:] >> shift & 3).astype(np.int8))
        steps += _STEPS[apart].sum(1)
    length = np.abs(a[:, 0].astype(np.int64) - b[:, 0].astype(np.int64))
    steps += np.minimum(length, _LENGTH_STEPS_AT_MOST) * (BUCKETS / 256)
    return 1 - np.minimum(steps, 2 * BUCKETS) / (2 * BUCKETS)


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row; a null text is empty, other columns are not used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big, texts in chunks(batches):
            for at in range(0, len(texts), ROWS_AT_ONCE):
                part, some = big.slice(at, ROWS_AT_ONCE), texts[at : at + ROWS_AT_ONCE]
                found = [x.tobytes().hex() for x in digests(some)]
                sizes = pa.array([len(t.decode()) for t in some], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, pa.array(found)], ["doc_id", "n_chars", "fingerprint"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def with_next_text(documents: DataFrame) -> DataFrame:
    """Buckets of documents in descending ``doc_id`` order, each bucket ending with its follower.

    Columns ``bucket, helper, order_id, doc_id, text``. Bucket bounds are quantiles of the ids; the
    first document of every bucket also closes the bucket before it, and the very first the last
    one. The driver holds one id per bucket. A null ``doc_id`` comes last; rows that share an id
    follow each other by a hash of the text.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lowest = F.lit(-(2**63)).cast("long")
    rows = rows.withColumn("order_id", F.coalesce("doc_id", lowest))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select("order_id").approxQuantile("order_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    cuts = sorted({int(c) for c in cuts if -(2**63) < c < 2**63})
    # the first bucket has the highest ids
    bounds = F.array(*map(F.lit, cuts)).cast("array<long>")
    bucket = F.size(F.filter(bounds, lambda c: F.col("order_id") < c))
    rows = rows.withColumn("bucket", bucket.cast("int"))
    tops = sorted((r.bucket, r.top) for r in rows.groupBy("bucket").agg(F.max("order_id").alias("top")).collect())
    if not tops:
        return rows.withColumn("helper", F.lit(0)).select("bucket", "helper", "order_id", "doc_id", "text")
    follows = [(tops[i][1], tops[i - 1][0]) for i in range(len(tops))]  # this top closes that bucket
    closing = F.broadcast(spark.createDataFrame(follows, "order_id long, closes int"))
    helpers = rows.join(closing, "order_id").select(F.col("closes").alias("bucket"), F.lit(1).alias("helper"), "order_id", "doc_id", "text")
    own = rows.select("bucket", F.lit(0).alias("helper"), "order_id", "doc_id", "text")
    dealt = own.union(helpers).repartitionById(tops[-1][0] + 1, F.col("bucket"))
    return dealt.sortWithinPartitions("bucket", "helper", F.desc("order_id"), F.xxhash64("text"), "text")


def edited_pairs(documents: DataFrame) -> DataFrame:
    """Every document against its edited text and against the next document.

    The edit replaces the last half of a text's code points (rounded down) by as many first ones of
    the next document in descending ``doc_id`` order. Gives ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``, one row per document row. Null texts
    are empty, a single document is its own next one, an empty table gives no row.
    """

    def rows(pending: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        edited, texts, following = [], [], []
        for _, text, after in pending:
            half = len(text) // 2
            edited.append((text[: len(text) - half] + after[:half]).encode())
            texts.append(text.encode())
            following.append(after.encode())
        own, changed = digests(texts), digests(edited)
        # each next text is the following row's own text, so only the last one is new
        last = digests(following[-1:])
        after = np.concatenate([own[1:], last])
        columns = [
            pa.array([p[0] for p in pending], pa.int64()),
            pa.array([len(p[1]) for p in pending], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in edited], pa.string()),
            pa.array([x.tobytes().hex() for x in own], pa.string()),
            pa.array([x.tobytes().hex() for x in changed], pa.string()),
            pa.array(likeness(own, changed)),
            pa.array(likeness(own, after)),
        ]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size, held, bucket, closed = [], 0, None, None, True
        for batch, texts in chunks(batches):
            for where, helper, doc_id, text in zip(
                batch.column("bucket").to_pylist(), batch.column("helper").to_pylist(), batch.column("doc_id").to_pylist(), texts
            ):
                text = text.decode()
                if where != bucket:
                    bucket, closed, held = where, False, None
                if held is not None and not closed:
                    pending.append((held[0], held[1], text))
                    size += len(held[1]) + 1
                    # a batch ends where the next row starts another bucket
                    if helper or size >= CHUNK_BYTES // 2 or len(pending) >= ROWS_AT_ONCE:
                        yield rows(pending)
                        pending, size = [], 0
                closed = closed or bool(helper)
                held = (doc_id, text)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next_text(documents).mapInArrow(run, schema)
