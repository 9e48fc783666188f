"""Ordered row rules: the first rule a row breaks names its rejection reason."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake import schemas as S


class Rule(NamedTuple):
    reason: str
    broken: Column


class Validated(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


# Null makes rlike, isin and == return null, so every rule tests for it on its own.
def _not_matching(name: str, pattern: str) -> Column:
    return F.col(name).isNull() | ~F.col(name).rlike(pattern)


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def _outside(name: str, allowed: list[str]) -> Column:
    return F.col(name).isNull() | ~F.col(name).isin(allowed)


def patient_rules() -> list[Rule]:
    return [
        Rule("invalid external_id", _not_matching("external_id", S.PATIENT_ID)),
        Rule("missing name", _blank("name")),
        Rule("invalid birth_date", _not_matching("birth_date", S.ISO_DATE)),
        Rule("invalid gender", _outside("gender", S.GENDERS)),
        Rule("invalid blood_type", _outside("blood_type", S.BLOOD_TYPES)),
    ]


def admission_rules() -> list[Rule]:
    return [
        Rule("invalid patient_external_id", _not_matching("patient_external_id", S.PATIENT_ID)),
        Rule("invalid admission_date", _not_matching("admission_date", S.ISO_DATE)),
        Rule("missing department", _blank("department")),
        Rule("invalid status", _outside("status", S.STATUSES)),
    ]


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add the reason column, null for rows that keep every rule. One flat expression."""
    return df.withColumn(S.REASON, F.coalesce(*[F.when(r.broken, F.lit(r.reason)) for r in rules]))


def split(tagged: DataFrame) -> Validated:
    return Validated(
        valid=tagged.filter(F.col(S.REASON).isNull()).drop(S.REASON),
        rejected=tagged.filter(F.col(S.REASON).isNotNull()),
    )


def validate_patients(df: DataFrame) -> Validated:
    return split(tag(df, patient_rules()))


def validate_admissions(df: DataFrame) -> Validated:
    return split(tag(df, admission_rules()))


def reject_report(**tagged: DataFrame) -> DataFrame:
    """Rows per entity and reason; accepted rows count under a null reason."""
    parts = [df.groupBy(S.REASON).count().select(F.lit(entity).alias("entity"), S.REASON, "count") for entity, df in tagged.items()]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def pack_rejected(rejected: DataFrame, source_file: str, *beside: str) -> DataFrame:
    """Rejects of any entity in one shape: the row itself becomes a map, nulls kept; columns ``beside`` it stay."""
    fields = [c for c in rejected.columns if c != S.REASON and c not in beside]
    pairs = [x for c in fields for x in (F.lit(c), F.col(c))]
    return rejected.select(F.lit(source_file).alias("source_file"), S.REASON, F.create_map(*pairs).alias("raw_data"), *beside)
