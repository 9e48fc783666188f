import pytest

from wardlake.schemas import ADMISSION_COLUMNS, PATIENT_COLUMNS
from wardlake.sources.csv import MissingColumnsError, read_admissions, read_patients, write_csv


def test_columns_come_by_header_and_extras_are_dropped(spark, write_text):
    path = write_text("p.csv", ["extra", *reversed(PATIENT_COLUMNS)], "x,A+,F,1971-11-04,Nuria,HOSP-000001")
    df = read_patients(spark, path)
    assert df.columns == [*PATIENT_COLUMNS, "_source_file"]
    assert {t for _, t in df.dtypes} == {"string"}
    assert tuple(df.head()) == ("HOSP-000001", "Nuria", "1971-11-04", "F", "A+", "p.csv")


def test_rows_are_kept_as_they_are(spark, write_text):
    path = write_text("p.csv", PATIENT_COLUMNS, "BAD, Nuria ,04/11/1971,X,", '"",,,,', "HOSP-000002,Oriol", "HOSP-000003,a,b,c,d,e,f")
    rows = [tuple(r)[:5] for r in read_patients(spark, path).collect()]
    assert rows == [
        ("BAD", " Nuria ", "04/11/1971", "X", None),
        (None, None, None, None, None),
        ("HOSP-000002", "Oriol", None, None, None),
        ("HOSP-000003", "a", "b", "c", "d"),
    ]


def test_missing_columns_are_all_named(spark, write_text):
    path = write_text("p.csv", ["External_Id", "name", "gender"], "HOSP-000001,Nuria,F")
    with pytest.raises(MissingColumnsError) as error:
        read_patients(spark, path)
    for column in ["external_id", "birth_date", "blood_type"]:
        assert column in str(error.value)
    assert "'name'" not in str(error.value)


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_patients(spark, str(tmp_path / "none.csv"))


def test_header_only_and_empty_file(spark, write_text, tmp_path):
    assert read_admissions(spark, write_text("a.csv", ADMISSION_COLUMNS)).count() == 0
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(MissingColumnsError):
        read_admissions(spark, str(empty))


def test_file_name_with_a_space(spark, write_text):
    path = write_text("my+new patients 100%.csv", PATIENT_COLUMNS, "HOSP-000001,Nuria,1971-11-04,F,A+")
    assert read_patients(spark, path).head()["_source_file"] == "my+new patients 100%.csv"


def test_written_values_come_back(spark, patients_of, tmp_path):
    df = patients_of(("HOSP-000001", "  padded ", "1971-11-04", "F", "A+"), ("HOSP-000002", "", None, 'a,"b', "O+"))
    path = str(tmp_path / "out")
    write_csv(df, path)
    rows = {r["external_id"]: r for r in read_patients(spark, path, escape="\\").collect()}
    assert rows["HOSP-000001"]["name"] == "  padded "
    assert rows["HOSP-000002"]["name"] is None and rows["HOSP-000002"]["birth_date"] is None
    assert rows["HOSP-000002"]["gender"] == 'a,"b'


def test_part_files_with_other_headers_are_refused(spark, write_text):
    write_text("dir/a.csv", PATIENT_COLUMNS, "HOSP-000001,Nuria,1971-11-04,F,A+")
    path = write_text("dir/b.csv", list(reversed(PATIENT_COLUMNS)), "A+,F,1971-11-04,Nuria,HOSP-000001")
    with pytest.raises(Exception, match="(?i)header"):
        read_patients(spark, path.rsplit("/", 1)[0]).collect()
