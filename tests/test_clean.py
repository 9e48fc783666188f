from datetime import date

import pytest
from pyspark.sql import functions as F

from wardlake.functions import age_years, diagnosis_category
from wardlake.operators import metrics as M
from wardlake.operators.clean import clean_admissions, clean_patients, deduplicate, enrich_admissions, enrich_patients


def test_patients_are_trimmed_and_unique(patients_of):
    rows = clean_patients(
        patients_of(
            ("HOSP-000001", " Nuria ", "1971-11-04", "F", "A+"),
            ("HOSP-000001", "Nuria", "1971-11-04", "F", "A+"),
            ("HOSP-000002", "Zoe", "1971-11-04", "F", "A+"),
            ("HOSP-000002", "Bea", "1990-01-01", "M", "O+"),
        )
    ).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("HOSP-000001", "Nuria", "1971-11-04", "F", "A+"),
        ("HOSP-000002", "Bea", "1990-01-01", "M", "O+"),
    ]


def test_admissions_are_unique_by_patient_day_and_trimmed_department(admissions_of):
    base = ("HOSP-000001", "2024-07-09", None, "UCI", "J18.9", "x", "admitted")
    df = admissions_of(
        base,
        base,
        (*base[:3], " UCI ", *base[4:]),
        (*base[:3], "Urgencias", *base[4:]),
        (base[0], "2025-03-11", *base[2:]),
        ("HOSP-000002", *base[1:]),
    )
    rows = clean_admissions(df).collect()
    assert len(rows) == 4
    assert {r["department"] for r in rows} == {"UCI", "Urgencias"}


def test_survivor_does_not_depend_on_order_or_partitions(spark):
    rows = [(i % 7, None if i % 5 == 0 else i % 11, f"v{i % 13}") for i in range(500)]
    forward = spark.createDataFrame(rows, "k int, a int, b string").repartition(1)
    backward = spark.createDataFrame(rows[::-1], "k int, a int, b string").repartition(8)
    assert sorted(map(tuple, deduplicate(forward, ["k"]).collect())) == sorted(map(tuple, deduplicate(backward, ["k"]).collect()))


def test_empty_input(patients_of, admissions_of, spark):
    empty = spark.createDataFrame([], patients_of(("a",) * 5).schema)
    assert clean_patients(empty).count() == 0
    assert enrich_patients(clean_patients(empty)).columns[-1] == "age"


def age(spark, birth, on):
    return spark.range(1).select(age_years(F.lit(birth), on)).head()[0]


@pytest.mark.parametrize(
    "birth, on, years",
    [
        ("1971-11-04", date(2025, 11, 3), 53),
        ("1971-11-04", date(2025, 11, 4), 54),
        ("1971-11-04", date(2026, 4, 21), 54),
        ("1971-11-04", date(2026, 12, 1), 55),
        ("2000-02-29", date(2025, 2, 28), 25),
        ("1999-02-30", date(2026, 4, 21), None),
        (None, date(2026, 4, 21), None),
        ("2026-12-01", date(2026, 4, 21), -1),
    ],
)
def test_age(spark, birth, on, years):
    assert age(spark, birth, on) == years


def test_age_without_reference_uses_today(spark, patients_of):
    row = enrich_patients(patients_of(("HOSP-000001", "Nuria", "1971-11-04", "F", "A+"))).head()
    assert row["age"] >= 54


@pytest.mark.parametrize(
    "code, category",
    [
        ("U07.1", "COVID-19"),
        ("U07.2", "COVID-19"),
        ("J18.9", "Pneumonia"),
        ("J12.1", "Pneumonia"),
        ("J11.0", "Other"),
        ("J44.9", "Other"),
        ("I21.9", "Other"),
        ("u07.1", "Other"),
        ("", "Other"),
        (None, "Unknown"),
    ],
)
def test_category(spark, code, category):
    assert spark.range(1).select(diagnosis_category(F.lit(code).cast("string"))).head()[0] == category


def test_summaries(admissions_of):
    def row(day, department, code):
        return ("HOSP-000001", day, None, department, code, "x", "admitted")

    df = admissions_of(
        row("2024-07-09", "UCI", "J18.9"), row("2024-07-21", "UCI", "U07.1"), row("2024-08-14", "Urgencias", None), row("2025-02-30", "Alta", "J18.9")
    )
    assert [tuple(r) for r in M.admissions_by_department(df).collect()] == [("UCI", 2), ("Alta", 1), ("Urgencias", 1)]
    assert [tuple(r) for r in M.admissions_by_month(df).collect()] == [(None, 1), ("2024-07", 2), ("2024-08", 1)]
    by_category = [tuple(r) for r in M.admissions_by_diagnosis_category(df).collect()]
    assert by_category == [("Pneumonia", 2), ("COVID-19", 1), ("Unknown", 1)]
    assert by_category == [tuple(r) for r in M.admissions_by_diagnosis_category(enrich_admissions(df)).collect()]
    assert [tuple(r) for r in M.duplicate_keys(df, ["department"]).collect()] == [("UCI", 2)]
