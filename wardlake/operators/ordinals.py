"""Ordinal directories: which row of a sorted table each of its files begins with.

A table is range-partitioned and sorted by an order that identifies its rows, so every file holds
one stretch of it. The directory names, per file, the first key and the number of rows before it.
It is a few hundred bytes per file, made once when the table is written and kept next to it. A page
of any depth then opens the files it lies in and no others, without counting or sampling.

Several sorted tables, such as the loads of one stored table, are paged together: between two
first keys each table contributes at most the file that begins before the lower one.
"""

import json
import re
from bisect import bisect_right
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake import fs

#: Bounds what a page has to skip inside the file it begins in.
MAX_FILE_ROWS = 500_000
#: Key types that keep their value and their order in the directory's JSON.
KEY_TYPES = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


class SortedFile(NamedTuple):
    name: str
    first: list
    n: int


class Stretch(NamedTuple):
    """Rows [start, end) of one file."""

    path: str
    start: int
    end: int


def _sortable(key: list) -> tuple:
    """Nulls first, as Spark sorts; strings by code point, which is the order of their UTF-8 bytes."""
    return tuple((v is not None, v if v is not None else 0) for v in key)


class Ordinals:
    """The directory of one sorted table."""

    def __init__(self, root: str, files: list[SortedFile]):
        self.root, self.files = root, sorted(files, key=lambda f: _sortable(f.first))
        self.firsts = [_sortable(f.first) for f in self.files]
        self.ranks = [0]
        for f in self.files:
            self.ranks.append(self.ranks[-1] + f.n)
        self._by_number = {file_number(f.name): k for k, f in enumerate(self.files)}

    @property
    def total(self) -> int:
        return self.ranks[-1]

    def path(self, k: int) -> str:
        return f"{self.root}/{self.files[k].name}"

    def rank(self, place: int) -> int:
        """Rank of the row at a ``place_in_table``."""
        number, row = divmod(place, 1 << ROW_BITS)
        return self.ranks[self._by_number[number]] + row

    def stretches(self, start: int, end: int) -> list[Stretch]:
        """Where the rows of rank [start, end) are."""
        out, k = [], max(0, bisect_right(self.ranks, start) - 1)
        while k < len(self.files) and self.ranks[k] < end:
            low, high = max(start, self.ranks[k]), min(end, self.ranks[k + 1])
            if low < high:
                out.append(Stretch(self.path(k), low - self.ranks[k], high - self.ranks[k]))
            k += 1
        return out

    def files_between(self, low: list, high: list) -> list[str]:
        """Paths of the files that may hold keys from ``low`` up to ``high``, both given by their leading values."""
        begin = end = max(0, bisect_right(self.firsts, _sortable(low)) - 1)
        while end < len(self.files) and self.firsts[end][: len(high)] <= _sortable(high):
            end += 1
        return [self.path(k) for k in range(begin, end)]

    def rows_before(self, key: tuple) -> tuple[int, int, int]:
        """(file, least, most): where a key would be, and how many rows are smaller at least and at most."""
        k = bisect_right(self.firsts, key) - 1
        if k < 0:
            return 0, 0, 0
        inside = 0 if self.firsts[k] == key else self.files[k].n
        return k, self.ranks[k], self.ranks[k] + inside

    def to_json(self) -> str:
        return json.dumps([list(f) for f in self.files])

    @classmethod
    def from_json(cls, root: str, text: str) -> "Ordinals":
        return cls(root, [SortedFile(*f) for f in json.loads(text)])


#: A place in a table: the number of the file, then this many bits for the row in it.
ROW_BITS = 32


def file_number(name: str) -> int:
    """Number of a file that Spark wrote: its task, and which of the task's files it is."""
    task, of_task = re.match(r"part-([0-9]+)-.*-c([0-9]+)[.]", name).groups()
    return (int(task) << 12) + int(of_task)


def place_in_table() -> Column:
    """Place of a scanned row: ascending within the table, to be looked up with ``Ordinals.rank``."""
    name = F.col("_metadata.file_name")
    task = F.regexp_extract(name, "^part-([0-9]+)-", 1).cast("long")
    of_task = F.regexp_extract(name, "-c([0-9]+)[.]", 1).cast("long")
    return F.shiftleft(F.shiftleft(task, 12) + of_task, ROW_BITS) + F.col("_metadata.row_index")


def write_sorted(rows: DataFrame, order: list[str], path: str) -> Ordinals:
    """Write rows sorted by columns that identify them, and make their directory.

    Ranges over the whole key: a leading key that holds most rows spans several files.
    """
    fields = {f.name: f.dataType for f in rows.schema.fields}
    wrong = [c for c in order if not isinstance(fields[c], KEY_TYPES)]
    if wrong:
        raise TypeError(f"pages need an order of strings, whole numbers or booleans, not {wrong}")
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    spread.write.mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    per_file = stored.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.min(F.struct(*order)).alias("first"), F.count(F.lit(1)).alias("n"))
    return Ordinals(path, [SortedFile(r["name"], list(r["first"]), r["n"]) for r in per_file.collect()])


def keep_ordinals(spark: SparkSession, path: str, ordinals: Ordinals) -> None:
    fs.create_text(spark, path, ordinals.to_json())


def load_ordinals(spark: SparkSession, path: str, root: str) -> Ordinals:
    return Ordinals.from_json(root, fs.read_text(spark, path))


def rows_of(spark: SparkSession, schema: T.StructType, stretches: list[Stretch]) -> DataFrame:
    """The given stretches of files, and nothing of any other file."""
    merged: list[Stretch] = []
    for s in sorted(stretches):
        if merged and merged[-1].path == s.path and merged[-1].end >= s.start:
            merged[-1] = merged[-1]._replace(end=max(s.end, merged[-1].end))
        else:
            merged.append(s)
    if not merged:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    wanted = F.lit(False)
    for s in merged:
        row = F.col("_metadata.row_index")
        wanted |= (F.col("_metadata.file_name") == s.path.rsplit("/", 1)[-1]) & (row >= s.start) & (row < s.end)
    return spark.read.schema(schema).parquet(*dict.fromkeys(s.path for s in merged)).filter(wanted)


def page_of(spark: SparkSession, tables: list[Ordinals], schema: T.StructType, order: list[str], limit: int, offset: int) -> DataFrame:
    """Rows [offset, offset + limit) of all tables together, in one job over the few files that hold them."""
    keys = sorted({k for t in tables for k in t.firsts})

    def before(key: tuple) -> list[tuple[int, int, int]]:
        return [t.rows_before(key) for t in tables]

    # the last first key that all rows of the page are not before, and the first one they are before
    low = _last(keys, lambda key: sum(most for _, _, most in before(key)) <= offset)
    high = next((k for k in keys[_first(keys, lambda key: sum(least for _, least, _ in before(key)) >= offset + limit) :]), None)
    stretches, skipped = [], 0
    for t in tables:
        begin = t.rows_before(low)[1] if low is not None else 0
        end = t.rows_before(high)[2] if high is not None else t.total
        skipped += begin
        stretches += t.stretches(begin, end)
    return rows_of(spark, schema, stretches).orderBy(*order).offset(offset - skipped).limit(limit)


def _first(keys: list, holds) -> int:
    """Number of the first key for which a condition holds that stays true from there on."""
    low, high = 0, len(keys)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(keys[middle]) else (middle + 1, high)
    return low


def _last(keys: list, holds) -> tuple | None:
    """The last key for which a condition holds that was true until there."""
    k = _first(keys, lambda key: not holds(key))
    return keys[k - 1] if k else None
