"""Small helpers the operators share: written intermediate tables, text batches, vectorised hashing."""

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake import fs
from wardlake.fs import work_dir

#: Words of the corpus: runs of anything but ASCII white space.
WORD = rb"[^\x20\x09-\x0D]+"
#: Bytes of text that are hashed at once; bounds the working arrays of a task.
CHUNK_BYTES = 1 << 20
#: Bytes of text after which a worker gives back what it has freed.
GIVEN_BACK_BYTES = 1 << 23

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


#: Setting while an intermediate table is written: shuffle files go with the job.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def writing(spark: SparkSession, rows_at_once: int = 2000):
    """Settings for a write: no kept shuffle files, and Python gets ``rows_at_once`` rows in a batch."""
    return fs.settings(spark, {**_WRITING, "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_at_once)})


class Scratch:
    """Intermediate tables of one job, written below the shared checkpoint folder.

    Writing cuts the lineage, survives lost executors and lets several readers share one
    computation. Shuffle files are given up as soon as a table is written, and a table may be
    dropped once all that was made from it is written too.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, work_dir(spark, label)

    def keep(self, df: DataFrame, name: str, rows_at_once: int = 2000) -> DataFrame:
        """Write and reread a table; Python gets ``rows_at_once`` rows in a batch, few when they are large."""
        path = f"{self.base}/{name}"
        with writing(self.spark, rows_at_once):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            fs.remove(self.spark, f"{self.base}/{name}")


def stash(df: DataFrame, label: str) -> DataFrame:
    """A single intermediate table that stays."""
    return Scratch(df.sparkSession, label).keep(df, "table")


def hashed_sample(rows: DataFrame, column: str, most: int) -> DataFrame:
    """The ``most`` distinct values of a column with the smallest hashes, or all when there are fewer.

    A bound on the hash, from an estimate of the number of distinct values, leaves about twice as
    many before they are sorted, so no task sorts more however many rows there are, and rows that
    repeat a value do not count. The bound rises until enough values are below it.
    """
    place = F.xxhash64(column)
    distinct = rows.agg(F.approx_count_distinct(column).alias("n")).head()["n"]
    share = 2 * most / max(1, distinct)
    while True:
        few = rows.filter(place <= F.lit(min(2**63 - 1, int(-(2**63) + min(1.0, share) * 2**64)))).select(column).distinct()
        if share >= 1 or few.count() >= most:
            return few.orderBy(place, column).limit(most)
        share *= 2


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text counts as empty."""
    return [x if x is not None else b"" for x in column.cast(pa.large_binary()).to_pylist()]


def give_back() -> None:
    """Return freed memory to the system: workers stay for later stages and would hold on to it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES):
    """Yield ``(batch slice, its texts as bytes)`` of up to ``size`` bytes, or of one longer text.

    The worker's freed memory is given back every few chunks and once all have been worked on.
    """
    held = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            part = batch.slice(at, to - at)
            yield part, byte_texts(part.column(text))
            held, at = held + int(ends[to - 1]) - before, to
            if held >= GIVEN_BACK_BYTES:
                give_back()
                held = 0
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix constants) over an array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, 0 to n."""
    if 0 not in _powers or len(_powers[0][0]) <= n:
        m = max(n + 1, 1 << 16)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[0] = (out[0], out[1])
    return _powers[0]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of ``values[start:end]`` for many spans at once."""
    up, down = powers(len(values))
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a line end after each, as bytes, and where each text begins."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return data, np.concatenate([[0], np.cumsum(sizes)])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts, and the bounds of each text among them."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data, at = joined(texts)
    space = SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    hashes = span_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends)
    return hashes, np.searchsorted(starts, at)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position; empty when there are fewer than k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    starts = np.arange(n)
    return span_hashes(words, starts, starts + k)


def split_words(text: bytes) -> list[bytes]:
    return re.findall(WORD, text)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def extend(df: DataFrame, fields: list[T.StructField], compute: Callable[[list[bytes]], list[pa.Array]], text: str = "text", size: int = CHUNK_BYTES) -> DataFrame:
    """All columns of a table and new ones computed from the texts, about ``size`` bytes of them at a time."""
    names = [*df.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, text, size):
            yield pa.RecordBatch.from_arrays([*part.columns, *compute(texts)], names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))
