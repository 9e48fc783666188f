import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardlake.schemas import ADMISSION_COLUMNS, PATIENT_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("wardlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def patients_of(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in PATIENT_COLUMNS))

    return make


@pytest.fixture
def admissions_of(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in ADMISSION_COLUMNS))

    return make


@pytest.fixture
def write_text(tmp_path):
    def write(name, header, *rows):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([",".join(header), *rows]) + "\n", encoding="utf-8")
        return str(path)

    return write


@pytest.fixture
def inputs(write_text):
    """A small pair of CSV files: two good patients, two bad ones, one orphan admission."""
    patients = write_text(
        "in/patients.csv",
        PATIENT_COLUMNS,
        "HOSP-000001,Nuria Vidal,1971-11-04,F,A+",
        "HOSP-000002, Oriol Sanz ,1966-08-30,M,O-",
        "HOSP-000001,Nuria Vidal,1971-11-04,F,A+",
        "HOSP-000003,,1966-08-30,M,O-",
        "HOSP-000004,Eva,04/11/1971,F,B+",
    )
    admissions = write_text(
        "in/admissions.csv",
        ADMISSION_COLUMNS,
        "HOSP-000001,2024-07-09,2024-07-21,UCI,J18.9,Pneumonia,discharged",
        "HOSP-000001,2024-10-02,,Urgencias,U07.1,COVID-19,admitted",
        "HOSP-000001,2024-10-02,, Urgencias ,U07.1,COVID-19,admitted",
        "HOSP-000002,2024-08-14,,Cardiologia,I21.9,Infarction,admitted",
        "HOSP-900001,2024-08-14,,Cardiologia,I21.9,Infarction,admitted",
        "HOSP-000002,14/08/2024,,Cardiologia,I21.9,Infarction,admitted",
    )
    return patients, admissions
