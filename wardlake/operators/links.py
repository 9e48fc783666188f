"""Joins of children (admissions, images) to their patients.

A patient id has the fixed form ``HOSP-`` plus six digits, so however large the input, there
are at most 10^6 distinct ids (a few times that with the line breaks that the pattern lets
pass at the end): some tens of megabytes. That bound, which the filter below
puts into the plan itself, is why ids are broadcast: the large child side is never shuffled
and a patient holding a third of the children costs nothing extra. The patient's other
columns have no such bound and are never broadcast.

The parents must have passed the id rule; the store refuses others (see plans/store.py).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.schemas import PATIENT_ID


def bounded_ids(df: DataFrame, *extra: str, key: str = "external_id") -> DataFrame:
    """Distinct valid ids, with fixed-width extra columns, marked for broadcast."""
    return F.broadcast(df.filter(F.col(key).rlike(PATIENT_ID)).select(key, *extra).distinct())


def _link(children: DataFrame, patients: DataFrame, how: str) -> DataFrame:
    ids = bounded_ids(patients).withColumnRenamed("external_id", "_parent_id")
    return children.join(ids, children["patient_external_id"] == ids["_parent_id"], how)


def with_patient(children: DataFrame, patients: DataFrame) -> DataFrame:
    """Children whose patient is known."""
    return _link(children, patients, "left_semi")


def without_patient(children: DataFrame, patients: DataFrame) -> DataFrame:
    """Orphans: children whose patient is not known (or who name none)."""
    return _link(children, patients, "left_anti")
