"""Stored objects as an append-only log of puts and removals; the newest entry counts.

The log is resolved on its metadata alone. Bytes are read where they lie: what has to be left out,
or picked, is a set of row positions per file, applied at the scan of that file, so no shuffle ever
carries an object.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.operators.metrics import duplicate_keys
from wardlake.schemas import DEFAULT_CONTENT_TYPE

BLOB_KEY = ["bucket", "object_key"]


def put_entries(objects: DataFrame, content_type: str = DEFAULT_CONTENT_TYPE) -> DataFrame:
    """Log entries for (bucket, object_key, content[, content_type, source_time]) rows."""
    kind = F.col("content_type") if "content_type" in objects.columns else F.lit(content_type)
    return objects.select(
        *BLOB_KEY,
        "content",
        F.octet_length("content").cast("long").alias("length"),
        F.coalesce(kind, F.lit(content_type)).alias("content_type"),
        F.lit(False).alias("deleted"),
        (F.col("source_time") if "source_time" in objects.columns else F.lit(None)).cast("timestamp").alias("source_time"),
    )


def remove_entries(keys: DataFrame) -> DataFrame:
    return keys.select(
        *BLOB_KEY,
        F.lit(None).cast("binary").alias("content"),
        F.lit(0).cast("long").alias("length"),
        F.lit(None).cast("string").alias("content_type"),
        F.lit(True).alias("deleted"),
        F.lit(None).cast("timestamp").alias("source_time"),
    )


def check_unique(entries: DataFrame) -> None:
    """One batch must not write a key twice: which of the two would count?"""
    twice = duplicate_keys(entries, BLOB_KEY).head(1)
    if twice:
        raise ValueError(f"object written twice in one batch: {twice[0]['bucket']}/{twice[0]['object_key']}")


def blob_index(log: DataFrame) -> DataFrame:
    """Current objects without their bytes: the newest entry per key that is no removal."""
    return _newest(log).filter(~F.col("deleted")).drop("deleted", "source_time")


def source_times(log: DataFrame) -> DataFrame:
    """Current objects with the length and time of the file each came from."""
    return _newest(log).filter(~F.col("deleted")).select(*BLOB_KEY, "length", "source_time")


def _newest(log: DataFrame) -> DataFrame:
    newest = F.max(F.struct("load", "length", "content_type", "deleted", "source_time")).alias("_n")
    return log.groupBy(*BLOB_KEY).agg(newest).select(*BLOB_KEY, "_n.*")


def list_objects(index: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    found = index.filter(F.col("bucket") == bucket)
    if prefix:
        found = found.filter(F.col("object_key").startswith(prefix))
    return found.select("object_key")


def objects_exist(index: DataFrame, keys: DataFrame) -> DataFrame:
    """All columns of the wanted keys, and whether each is ``present``."""
    found = index.select(*BLOB_KEY, F.lit(True).alias("present"))
    return keys.join(found, BLOB_KEY, "left").withColumn("present", F.coalesce("present", F.lit(False)))


def object_exists(index: DataFrame, bucket: str, key: str) -> bool:
    return not index.filter((F.col("bucket") == bucket) & (F.col("object_key") == key)).isEmpty()


def stale_places(entries: DataFrame) -> DataFrame:
    """Places (load, file, row) of entries without a current object: replaced ones and removals."""
    newest = F.max("load").alias("_newest")
    later = entries.groupBy(*BLOB_KEY).agg(newest)
    return entries.join(later, BLOB_KEY).filter(F.col("deleted") | (F.col("load") < F.col("_newest"))).select("load", "file", "row")


def wanted_places(entries: DataFrame, index: DataFrame) -> DataFrame:
    """Places of the objects of the given index rows."""
    return entries.filter(~F.col("deleted")).join(index.select(*BLOB_KEY, "load"), [*BLOB_KEY, "load"], "left_semi").select("load", "file", "row")
