"""Derived clinical values."""

from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlake.schemas import COVID_PREFIXES, PNEUMONIA_PREFIXES


def as_date(text: Column) -> Column:
    """Date of a string, null when it is no calendar day (``1999-02-30``)."""
    return text.try_cast("date")


def age_years(birth: Column, reference: date | None = None) -> Column:
    """Whole years between birth and the reference day (today when none is given)."""
    until = F.current_date() if reference is None else F.lit(reference)
    return F.floor(F.months_between(until, as_date(birth)) / 12).cast("int")


def month_of(day: Column) -> Column:
    return F.date_format(as_date(day), "yyyy-MM")


def _starts_with_any(code: Column, prefixes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [code.startswith(p) for p in prefixes])


def diagnosis_category(code: Column) -> Column:
    # the null test has to come first: a null code would fall through to "Other"
    return (
        F.when(code.isNull(), "Unknown")
        .when(_starts_with_any(code, COVID_PREFIXES), "COVID-19")
        .when(_starts_with_any(code, PNEUMONIA_PREFIXES), "Pneumonia")
        .otherwise("Other")
    )
