"""Fixed vocabularies and table schemas."""

from pyspark.sql import types as T

# ---- fixed values: id and date shapes, closed vocabularies, reject reasons ----
PATIENT_ID = r"^HOSP-\d{6}$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
GENDERS = ["M", "F", "Other"]
BLOOD_TYPES = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
STATUSES = ["admitted", "discharged", "transferred"]
COVID_PREFIXES = ["U07"]
PNEUMONIA_PREFIXES = ["J12", "J13", "J14", "J15", "J16", "J17", "J18"]
PNG_SIGNATURE = bytes.fromhex("89504E470D0A1A0A")
IMAGE_NAME = r"^(HOSP-\d{6})_"
PATIENTS_FILE = "patients.csv"
ADMISSIONS_FILE = "admissions.csv"
DEFAULT_CONTENT_TYPE = "application/octet-stream"
IMAGES_BUCKET = "radiographies"

SOURCE_FILE = "_source_file"
REASON = "rejection_reason"

PATIENT_COLUMNS = ["external_id", "name", "birth_date", "gender", "blood_type"]
ADMISSION_COLUMNS = [
    "patient_external_id",
    "admission_date",
    "discharge_date",
    "department",
    "diagnosis_code",
    "diagnosis_description",
    "status",
]
PATIENT_KEY = ["external_id"]
ADMISSION_KEY = ["patient_external_id", "admission_date", "department"]
STORE_COLUMNS = ["admissions_load", "admissions_at", "n_admissions", "n_radiographies"]
ADMISSION_ORDER = ["patient_external_id", "admission_date", "department"]
RADIOGRAPHY_KEY = ["patient_external_id", "minio_object_key"]
RADIOGRAPHY_ORDER = ["minio_object_key", "patient_external_id"]


def _strings(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


PATIENTS = T.StructType(
    _strings(PATIENT_COLUMNS + [SOURCE_FILE])
    + [
        T.StructField("age", T.IntegerType()),
        # bookkeeping of the store: which load the admissions come from, where in it the first
        # one is, sizes of both arrays
        T.StructField("admissions_load", T.LongType()),
        T.StructField("admissions_at", T.LongType()),
        T.StructField("n_admissions", T.LongType()),
        T.StructField("n_radiographies", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
ADMISSIONS = T.StructType(_strings(ADMISSION_COLUMNS + [SOURCE_FILE, "diagnosis_category"]))
RADIOGRAPHIES = T.StructType(
    _strings(["patient_external_id", "minio_object_key", "original_filename"])
    + [T.StructField("file_size_bytes", T.LongType())]
    + _strings(["ingested_at", "classification"])
)
BLOBS = T.StructType(
    _strings(["bucket", "object_key"])
    + [
        T.StructField("content", T.BinaryType()),
        T.StructField("length", T.LongType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("deleted", T.BooleanType()),
        # of the file an object was made from, to see later whether that one has changed
        T.StructField("source_time", T.TimestampType()),
    ]
)
REJECTED = T.StructType(
    _strings(["source_file", REASON])
    + [
        T.StructField("raw_data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("pipeline_run_id", T.StringType()),
    ]
)
RUN_EVENTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event_at", T.TimestampType()),
        T.StructField("trigger_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("records_rejected", T.LongType()),
        T.StructField("images_processed", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)
