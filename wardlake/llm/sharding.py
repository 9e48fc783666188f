"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair draws a fixed number ``u`` from its digest, and the key goes to the shard
with the greatest ``-weight / ln(u)``. A shard therefore gets keys in proportion to its weight, and
a key's choice among the others does not depend on a shard that comes or goes: one more shard only
takes rows, into itself, and a removed one only gives its own away.

Nothing but expressions and DataFrame operators: no row leaves the JVM. Rows that share a key share
a shard (null counts as the empty key); repeated rows keep their order of input. Slots come from
one range shuffle whose key ends with a row number, so rows of one hot key spread over many tasks,
and from one count per task and shard; no shard is ever gathered.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.common import Scratch, free_name

#: A draw has as many bits as a double holds: 13 hexadecimal digits.
DIGITS = 13
#: ``monotonically_increasing_id`` keeps the row's place in its task in the low bits.
PLACE_BITS = 33


def _scores(key: Column, weights: Sequence[float]) -> Column:
    """(score, -shard) per shard; ties go to the smaller number."""
    if not weights or any(not 0 < w < float("inf") for w in weights):
        raise ValueError("every shard needs a positive weight")
    name = F.coalesce(key.cast("string"), F.lit(""))

    def score(weight: Column, shard: Column) -> Column:
        digest = F.substring(F.md5(F.concat_ws("#", name, shard.cast("string"))), 1, DIGITS)
        u = (F.conv(digest, 16, 10).cast("double") + 0.5) / 16.0**DIGITS
        return F.struct((-weight / F.log(u)).alias("score"), (-shard).alias("minus"))

    return F.transform(F.array(*[F.lit(float(w)) for w in weights]), score)


def with_shard(df: DataFrame, weights: Sequence[float], key: str = "doc_id", shard: str = "shard", more: Sequence[float] = (), grown: str = "grown_shard") -> DataFrame:
    """All columns and the shard of each row; with weights of ``more`` shards, where it is after these came, too.

    Columns of these names are replaced.
    """
    scores = free_name(df, "_scores")
    scored = df.withColumn(scores, _scores(F.col(key), [*weights, *more]))
    best = lambda many: (-F.array_max(many)["minus"]).cast("int")
    found = {shard: best(F.slice(scores, 1, len(weights)))}
    if more:
        found[grown] = best(F.col(scores))
    return scored.withColumns(found).drop(scores)


def with_slots(df: DataFrame, key: str = "doc_id", shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of every shard from 0, without gaps, by key (null first) and order of input.

    The rows are range-partitioned by (shard, key, row number) and written once. A task holds
    stretches of few shards then, so a table of its counts has one row per task and one more for
    each border between shards; that table is broadcast.
    """
    row, number, task, first, before, count = (free_name(df, f"_{n}") for n in ("row", "number", "task", "first", "before", "count"))
    numbered = df.withColumn(row, F.monotonically_increasing_id())
    order = [shard, key, row]
    sorted_rows = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop(row)
    placed = Scratch(df.sparkSession, "sharding").keep(sorted_rows.withColumn(number, F.monotonically_increasing_id()), "placed")

    of_task = F.shiftright(number, PLACE_BITS)
    sizes = placed.groupBy(of_task.alias(task), shard).agg(F.min(number).alias(first), F.count(F.lit(1)).alias(count))
    earlier = Window.partitionBy(shard).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0))).drop(count)
    joined = placed.withColumn(task, of_task).join(F.broadcast(starts), [task, shard])
    return joined.withColumn(slot, F.col(before) + F.col(number) - F.col(first)).select(*[c for c in df.columns if c != slot], slot)


def assign(df: DataFrame, weights: Sequence[float], key: str = "doc_id", more: Sequence[float] = ()) -> DataFrame:
    """All columns, ``shard``, ``slot`` and, with ``more`` shards to come, ``grown_shard``."""
    return with_slots(with_shard(df, weights, key, more=more), key)


def write_shards(assigned: DataFrame, path: str) -> None:
    """One directory per shard. Rows lie sorted by shard already, so a task writes to few of them."""
    assigned.write.partitionBy("shard").parquet(path)


def with_text_size(df: DataFrame, text: str = "text") -> DataFrame:
    """UTF-8 bytes of the text plus 1 as ``size`` and its unsigned crc32 as ``text_crc32``; null counts as empty."""
    utf8 = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return df.withColumns({"size": F.octet_length(utf8).cast("long") + 1, "text_crc32": F.crc32(utf8)})
