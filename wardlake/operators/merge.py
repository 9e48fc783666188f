"""Keyed merges of a batch into stored rows."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.operators.clean import deduplicate
from wardlake.operators.links import with_patient, without_patient
from wardlake.schemas import RADIOGRAPHY_KEY

STAMPS = ["created_at", "updated_at"]


def merge_upsert(stored: DataFrame, batch: DataFrame, key: str, at: datetime | Column, insert: bool = True) -> DataFrame:
    """Rows after the batch is merged into the stored rows; both unique on ``key``.

    A field in the batch overwrites the stored one, also with null; a field the batch does not
    have survives. ``created_at`` is set on insert only, ``updated_at`` on every hit. With
    ``insert=False`` keys that are not stored yet are left out.
    """
    now = at if isinstance(at, Column) else F.lit(at)
    fields = [c for c in batch.columns if c != key and c not in STAMPS]
    # a marker column, since a null field may mean "set to null" as well as "not in the batch"
    new = batch.select(F.col(key).alias("_key"), F.struct(F.lit(True).alias("hit"), *fields).alias("_new"))
    old = stored.withColumn("_stored", F.lit(True))
    joined = old.join(new, old[key] == new["_key"], "full_outer" if insert else "left_outer")
    hit = F.col("_new.hit").isNotNull()

    def merged(name: str) -> Column:
        if name == key:
            value = F.coalesce(F.col(key), F.col("_key"))
        elif name == "created_at":
            value = F.when(F.col("_stored").isNull(), now).otherwise(F.col(name))
        elif name == "updated_at":
            value = F.when(hit, now).otherwise(F.col(name))
        elif name in fields and name in stored.columns:
            value = F.when(hit, F.col(f"_new.{name}")).otherwise(F.col(name))
        elif name in fields:
            value = F.col(f"_new.{name}")
        else:
            value = F.col(name)
        return value.alias(name)

    return joined.select(*[merged(c) for c in stored.columns], *[merged(c) for c in fields if c not in stored.columns])


def merge_counts(at: datetime | Column) -> list[Column]:
    """How many rows a merge stamped ``at`` inserted, and how many it overwrote."""
    now = at if isinstance(at, Column) else F.lit(at)
    return [
        F.count_if(F.col("created_at") == now).alias("upserted"),
        F.count_if((F.col("updated_at") == now) & (F.col("created_at") != now)).alias("modified"),
    ]


def merge_stats(merged: DataFrame, at: datetime | Column) -> DataFrame:
    """One row with the counts of a merge."""
    return merged.agg(*merge_counts(at))


def replace_admissions(stored: DataFrame, batch_patients: DataFrame, batch_admissions: DataFrame) -> DataFrame:
    """Admissions after a batch: those of a patient in the batch are replaced as a whole.

    Patients absent from the batch keep theirs; admissions of patients who are not in the
    batch do not get in.
    """
    kept = without_patient(stored, batch_patients)
    return kept.unionByName(with_patient(batch_admissions, batch_patients))


def new_radiographies(stored: DataFrame, images: DataFrame, patients: DataFrame) -> DataFrame:
    """Image rows to append: of known patients, once per object key, not stored already."""
    fresh = deduplicate(with_patient(images, patients), RADIOGRAPHY_KEY)
    return fresh.join(stored.select(*RADIOGRAPHY_KEY), RADIOGRAPHY_KEY, "left_anti")
