"""Expressions over file names and first bytes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlake.schemas import IMAGE_NAME, PNG_SIGNATURE


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def has_png_suffix(name: Column) -> Column:
    return F.lower(name).endswith(".png")


def patient_of(name: Column) -> Column:
    """Patient id at the start of an image name; empty when the name has none."""
    return F.regexp_extract(name, IMAGE_NAME, 1)


def is_png(content: Column) -> Column:
    return F.substring(content, 1, len(PNG_SIGNATURE)) == F.lit(PNG_SIGNATURE)


def object_key(patient: Column, name: Column) -> Column:
    return F.concat_ws("/", patient, name)
