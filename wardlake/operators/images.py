"""Image files: which are acceptable, what is recorded about them, which are already stored."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import base_name, has_png_suffix, is_png, object_key, patient_of
from wardlake.operators.links import bounded_ids


def disposition(name: Column, first_bytes: Column) -> Column:
    """Why a file is skipped, or ``ok``; the tests in the order in which they apply."""
    return (
        F.when(~has_png_suffix(name), "not_png")
        .when(patient_of(name) == "", "bad_name")
        .when(is_png(first_bytes), "ok")
        .otherwise("corrupt")
    )


def classify_images(files: DataFrame) -> DataFrame:
    """Add ``disposition`` to files with columns name and content (or its first bytes)."""
    return files.withColumn("disposition", disposition(F.col("name"), F.col("content")))


def accepted_images(files: DataFrame) -> DataFrame:
    """Acceptable files with their object key, the same on every run."""
    ok = files.filter(disposition(F.col("name"), F.col("content")) == "ok")
    return ok.withColumn("object_key", object_key(patient_of(F.col("name")), F.col("name")))


def keyed_names(files: DataFrame) -> DataFrame:
    """Files whose name is an image's, with their object key; the content is not looked at."""
    named = files.filter(has_png_suffix(F.col("name")) & (patient_of(F.col("name")) != ""))
    return named.withColumn("object_key", object_key(patient_of(F.col("name")), F.col("name")))


def changed_files(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Keyed files that are not stored, or were made from a file of other length or time."""
    kept = stored.select(F.col("object_key").alias("_key"), F.col("length").alias("_length"), "source_time")
    same = (F.col("object_key") == F.col("_key")) & (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("source_time"))
    return files.join(kept, same, "left_anti")


def image_records(stored: DataFrame, at: datetime) -> DataFrame:
    """Metadata records of stored images (object_key, length); the bytes are not read."""
    name = base_name(F.col("object_key"))
    return stored.select(
        F.substring_index("object_key", "/", 1).alias("patient_external_id"),
        F.col("object_key").alias("minio_object_key"),
        name.alias("original_filename"),
        F.col("length").cast("long").alias("file_size_bytes"),
        F.lit(at.isoformat()).alias("ingested_at"),
        F.lit(None).cast("string").alias("classification"),
    )


def sync_report(images: DataFrame, stored_keys: DataFrame) -> DataFrame:
    """Split of image records into ``uploaded`` and ``already there``, by base name."""
    known = stored_keys.select(base_name(F.col("object_key")).alias("original_filename")).distinct()
    known = known.withColumn("_known", F.lit(True))
    state = F.when(F.col("_known"), "already there").otherwise("uploaded")
    return images.join(known, "original_filename", "left").withColumn("sync_state", state).drop("_known")


def attach_report(images: DataFrame, patients: DataFrame) -> DataFrame:
    """Images of known patients (``attached``, also when stored before) and of unknown ones."""
    ids = bounded_ids(patients).withColumnRenamed("external_id", "_parent_id")
    linked = images.join(ids, images["patient_external_id"] == ids["_parent_id"], "left")
    state = F.when(F.col("_parent_id").isNull(), "orphan").otherwise("attached")
    return linked.withColumn("attach_state", state).drop("_parent_id")
