"""Trim, deduplicate, enrich."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.functions import age_years, diagnosis_category
from wardlake.schemas import ADMISSION_KEY, PATIENT_KEY


def deduplicate(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest of the remaining columns (nulls first).

    The survivor depends on the rows alone, not on task order, so a recomputed partition
    gives the same answer. ``min`` combines before the shuffle: a key that holds a third of
    all rows sends one row per map task. That sorts each task's rows, and a number in front
    decides nearly every comparison of keys, which otherwise all begin alike.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    kept = df.groupBy(F.xxhash64(*keys).alias("_h"), *keys).agg(F.min(F.struct(*others)).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def clean_patients(df: DataFrame, *within: str) -> DataFrame:
    """One row per patient, or per patient and further columns."""
    return deduplicate(df.withColumn("name", F.trim("name")), [*within, *PATIENT_KEY])


def clean_admissions(df: DataFrame, *within: str) -> DataFrame:
    # the trimmed department is part of the key, so trim first
    return deduplicate(df.withColumn("department", F.trim("department")), [*within, *ADMISSION_KEY])


def enrich_patients(df: DataFrame, reference: date | None = None) -> DataFrame:
    return df.withColumn("age", age_years(F.col("birth_date"), reference))


def enrich_admissions(df: DataFrame) -> DataFrame:
    return df.withColumn("diagnosis_category", diagnosis_category(F.col("diagnosis_code")))
