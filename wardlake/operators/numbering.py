"""Dense numbers for the rows of a frame, without gathering them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake import fs
from wardlake.operators.ordinals import Ordinals, write_sorted


def numbered(df: DataFrame, order: list[str], number: str = "number") -> tuple[DataFrame, int]:
    """The rows with numbers 0, 1, 2, ... in ascending order, and how many there are.

    They are written once, range-partitioned and sorted; a row's number is its place in its file
    plus the rows of the files before, of which there is one short line each. Rows that tie in
    ``order`` are numbered in any order.
    """
    spark = df.sparkSession
    table = write_sorted(df, order, fs.work_dir(spark, "numbered"))
    before, file = "_before", "_file"
    lines = [F.struct(F.lit(f.name).alias(file), F.lit(rank).cast("long").alias(before)) for f, rank in zip(table.files, table.ranks)]
    if not lines:
        return df.limit(0).withColumn(number, F.lit(0).cast("long")), 0
    starts = spark.range(1).select(F.inline(F.array(*lines)))
    rows = spark.read.schema(df.schema).parquet(table.root).select("*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(number))
    placed = rows.join(F.broadcast(starts), file).withColumn(number, F.col(number) + F.col(before))
    return placed.select(*df.columns, number), table.total
