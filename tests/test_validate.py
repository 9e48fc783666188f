import pytest

from wardlake.operators.validate import pack_rejected, reject_report, split, tag, patient_rules, validate_admissions, validate_patients

GOOD = ("HOSP-000001", "Nuria Vidal", "1971-11-04", "F", "A+")
GOOD_ADMISSION = ("HOSP-000001", "2024-07-09", None, "UCI", "J18.9", "Pneumonia", "admitted")


def changed(row, index, value):
    return (*row[:index], value, *row[index + 1 :])


def reasons(result):
    return [r["rejection_reason"] for r in result.rejected.collect()]


def test_good_rows_keep_their_columns(patients_of, admissions_of):
    result = validate_patients(patients_of(GOOD))
    assert result.valid.columns == patients_of(GOOD).columns and tuple(result.valid.head()) == GOOD
    assert reasons(result) == []
    assert validate_admissions(admissions_of(GOOD_ADMISSION)).valid.count() == 1


@pytest.mark.parametrize(
    "index, value, reason",
    [
        (0, "HOSPITAL-7", "invalid external_id"),
        (0, None, "invalid external_id"),
        (0, "HOSP-12345", "invalid external_id"),
        (0, "xHOSP-000001", "invalid external_id"),
        (1, "", "missing name"),
        (1, "   ", "missing name"),
        (1, None, "missing name"),
        (2, "04/11/1971", "invalid birth_date"),
        (2, "", "invalid birth_date"),
        (2, None, "invalid birth_date"),
        (3, "X", "invalid gender"),
        (3, "m", "invalid gender"),
        (3, None, "invalid gender"),
        (4, "C+", "invalid blood_type"),
        (4, None, "invalid blood_type"),
    ],
)
def test_patient_rules(patients_of, index, value, reason):
    result = validate_patients(patients_of(changed(GOOD, index, value), GOOD))
    assert reasons(result) == [reason]
    assert result.valid.count() == 1


@pytest.mark.parametrize(
    "index, value, reason",
    [
        (0, "X", "invalid patient_external_id"),
        (0, None, "invalid patient_external_id"),
        (1, "09/07/2024", "invalid admission_date"),
        (1, None, "invalid admission_date"),
        (3, None, "missing department"),
        (3, " ", "missing department"),
        (6, "unknown", "invalid status"),
        (6, None, "invalid status"),
    ],
)
def test_admission_rules(admissions_of, index, value, reason):
    assert reasons(validate_admissions(admissions_of(changed(GOOD_ADMISSION, index, value)))) == [reason]


def test_first_broken_rule_counts(patients_of):
    assert reasons(validate_patients(patients_of(("HOSPITAL-7", "", "bad-date", "X", "C+")))) == ["invalid external_id"]
    assert reasons(validate_patients(patients_of(("HOSP-000001", "", "bad-date", "X", "C+")))) == ["missing name"]


def test_what_the_rules_let_through(patients_of, admissions_of):
    # no calendar check, only spaces are trimmed, no diagnosis needed
    assert validate_patients(patients_of(changed(GOOD, 2, "1999-02-30"), changed(GOOD, 1, "\t"))).valid.count() == 2
    assert validate_admissions(admissions_of(changed(GOOD_ADMISSION, 4, None))).valid.count() == 1


def test_extra_columns_stay_on_both_sides(spark, patients_of):
    from pyspark.sql import functions as F

    df = patients_of(GOOD, changed(GOOD, 1, None)).withColumn("_source_file", F.lit("p.csv"))
    result = validate_patients(df)
    assert result.valid.columns == df.columns
    assert result.rejected.columns == [*df.columns, "rejection_reason"]


def test_report_and_packing(patients_of):
    tagged = tag(patients_of(GOOD, changed(GOOD, 1, None), changed(GOOD, 1, " ")), patient_rules())
    counts = {(r["entity"], r["rejection_reason"]): r["count"] for r in reject_report(patients=tagged).collect()}
    assert counts == {("patients", None): 1, ("patients", "missing name"): 2}
    packed = pack_rejected(split(tagged).rejected, "patients.csv").collect()
    assert {r["source_file"] for r in packed} == {"patients.csv"}
    raw = next(r["raw_data"] for r in packed if r["raw_data"]["name"] is None)
    assert raw == dict(zip(["external_id", "name", "birth_date", "gender", "blood_type"], changed(GOOD, 1, None)))
