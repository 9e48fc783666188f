"""Column expressions. Everything here stays inside Spark's generated code."""

from wardlake.functions.clinical import age_years, as_date, diagnosis_category, month_of
from wardlake.functions.draws import below, draw, pick, weighted
from wardlake.functions.files import base_name, has_png_suffix, is_png, object_key, patient_of

__all__ = [
    "age_years",
    "as_date",
    "base_name",
    "below",
    "diagnosis_category",
    "draw",
    "has_png_suffix",
    "is_png",
    "month_of",
    "object_key",
    "patient_of",
    "pick",
    "weighted",
]
