"""Counts that have to fit together, and the ones known for the fixtures at sf0.01."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardlake.operators.clean import clean_admissions, clean_patients, enrich_patients
from wardlake.operators.images import classify_images
from wardlake.operators.links import with_patient, without_patient
from wardlake.operators.nest import patient_documents, unnest_admissions
from wardlake.operators.validate import validate_admissions, validate_patients
from wardlake.schemas import ADMISSION_COLUMNS, PATIENT_COLUMNS
from wardlake.sources import testdata as T

DATA = "/root/testdata/sf0.01"


def by_reason(result):
    return {r["rejection_reason"]: r["count"] for r in result.rejected.groupBy("rejection_reason").count().collect()}


def test_known_patient_counts(spark):
    from datetime import date

    raw = T.patients_raw(spark, DATA)
    result = validate_patients(raw)
    assert raw.count() == 1546 and result.valid.count() == 1391
    assert by_reason(result) == {"invalid birth_date": 77, "invalid gender": 39, "missing name": 39}
    clean = enrich_patients(clean_patients(result.valid), date(2026, 4, 21))
    assert clean.count() == 1350 and clean.filter("age is null").count() == 4


def test_known_admission_counts(spark):
    raw = T.admissions_raw(spark, DATA)
    result = validate_admissions(raw)
    assert raw.count() == 15455 and result.valid.count() == 14682
    assert by_reason(result) == {"invalid admission_date": 773}
    clean = clean_admissions(result.valid)
    patients = validate_patients(T.patients_raw(spark, DATA)).valid
    assert clean.count() == 14248
    assert with_patient(clean, patients).count() == 12113 and without_patient(clean, patients).count() == 2135


def test_known_image_counts(spark):
    files = classify_images(T.image_files(spark, DATA))
    assert {r["disposition"]: r["count"] for r in files.groupBy("disposition").count().collect()} == {
        "ok": 435,
        "not_png": 25,
        "bad_name": 25,
        "corrupt": 15,
    }


IDS = ["HOSP-000001", "HOSP-000002", "HOSP-000003", "HOSP-12", None]
PATIENT = st.tuples(
    st.sampled_from(IDS),
    st.sampled_from(["Nuria", " Nuria ", "Bea", " ", None]),
    st.sampled_from(["1971-11-04", "1999-02-30", "04/11/1971", None]),
    st.sampled_from(["M", "F", "Other", "X", None]),
    st.sampled_from(["A+", "O-", "Z", None]),
)
ADMISSION = st.tuples(
    st.sampled_from(IDS),
    st.sampled_from(["2025-01-01", "2025-01-02", "01/02/2025", None]),
    st.sampled_from(["2025-02-01", None]),
    st.sampled_from(["UCI", " UCI", "Alta", " ", None]),
    st.sampled_from(["J18.9", "U07.1", None]),
    st.sampled_from(["x", None]),
    st.sampled_from(["admitted", "discharged", "gone", None]),
)


def good_patient(r):
    return r[0] in IDS[:3] and (r[1] or "").strip(" ") and r[2] in ("1971-11-04", "1999-02-30") and r[3] in ("M", "F", "Other") and r[4] in ("A+", "O-")


def good_admission(r):
    return r[0] in IDS[:3] and r[1] and "-" in r[1] and (r[3] or "").strip(" ") and r[6] in ("admitted", "discharged")


def smallest(rows, key):
    """One row per key: the smallest of the others, nulls first."""
    best = {}
    for r in rows:
        k = tuple(r[i] for i in key)
        rank = [(r[i] is not None, r[i] or "") for i in range(len(r)) if i not in key]
        if k not in best or rank < best[k][0]:
            best[k] = (rank, r)
    return sorted(r for _, r in best.values())


def text(rows):
    return sorted(map(repr, rows))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PATIENT, max_size=25), st.lists(ADMISSION, max_size=40), st.integers(1, 5))
def test_against_plain_python(spark, people, stays, part_size):
    p = validate_patients(spark.createDataFrame(people, ", ".join(f"{c} string" for c in PATIENT_COLUMNS)))
    a = validate_admissions(spark.createDataFrame(stays, ", ".join(f"{c} string" for c in ADMISSION_COLUMNS)))
    assert p.valid.count() + p.rejected.count() == len(people)
    assert text(map(tuple, p.valid.collect())) == text(r for r in people if good_patient(r))
    assert text(map(tuple, a.valid.collect())) == text(r for r in stays if good_admission(r))

    trimmed = [(r[0], r[1].strip(" "), *r[2:]) for r in people if good_patient(r)]
    patients = clean_patients(p.valid)
    assert text(map(tuple, patients.collect())) == text(smallest(trimmed, [0]))
    trimmed = [(*r[:3], r[3].strip(" "), *r[4:]) for r in stays if good_admission(r)]
    expected = smallest([tuple(r) for r in trimmed], [0, 1, 3])
    admissions = clean_admissions(a.valid)
    assert text(map(tuple, admissions.collect())) == text(expected)

    known = {r[0] for r in people if good_patient(r)}
    docs = patient_documents(patients, admissions, part_size=part_size)
    flat = unnest_admissions(docs).select(*ADMISSION_COLUMNS)
    assert text(map(tuple, flat.collect())) == text(r for r in expected if r[0] in known)
    assert docs.select("external_id").distinct().count() == len(known)
    assert without_patient(admissions, patients).count() == sum(r[0] not in known for r in expected)


@pytest.mark.parametrize("seed", range(3))
def test_order_of_the_input_does_not_matter(spark, seed):
    rows = [tuple(r) for r in T.admissions_raw(spark, DATA).limit(3000).collect()]
    schema = T.admissions_raw(spark, DATA).schema
    random.Random(seed).shuffle(rows)
    shuffled = clean_admissions(validate_admissions(spark.createDataFrame(rows, schema).repartition(seed + 2)).valid)
    digest = shuffled.agg(F.sum(F.xxhash64(*shuffled.columns).cast("decimal(38,0)"))).head()[0]
    rows.sort(key=repr)
    plain = clean_admissions(validate_admissions(spark.createDataFrame(rows, schema)).valid)
    assert digest == plain.agg(F.sum(F.xxhash64(*plain.columns).cast("decimal(38,0)"))).head()[0]
