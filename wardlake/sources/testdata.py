"""Clinical tables derived from the given test tables, whole, in Spark.

Each table is an expression per column over one input table (FIXTURES.md), defects included.
The ``*_dirty`` variants break every rule at least once.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.schemas import ADMISSION_COLUMNS, PATIENT_COLUMNS, PNG_SIGNATURE
from wardlake.sources.generate import describe, padded_id

# ---- fixed values of the fixtures ----
BLOOD_BY_KEY = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
DEPARTMENT_BY_KEY = [
    "Urgencias",
    "UCI",
    "Medicina Interna",
    "Cardiologia",
    "Neumologia",
    "Traumatologia",
    "Pediatria",
    "Ginecologia",
    "Oncologia",
    " Radiologia ",
]
CODE_BY_KEY = ["J18.9", "J18.0", "U07.1", "J44.9", "I21.9", "R05", "R50.9", "S72.9", "K35.80", "N39.0", None]
#: Eight bytes that open no image.
BAD_HEADER = b"no image"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_index(index: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _id(number: Column) -> Column:
    """Padded, never cut: a number of seven digits makes an id that the rules reject."""
    return padded_id(number)


def _with_copies(df: DataFrame, key: str) -> DataFrame:
    """Every 33rd row twice."""
    copies = F.when(F.col(key) % 33 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def _patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    day = F.concat_ws("-", (1940 + k * 7 % 75).cast("string"), two(1 + k * 5 % 12), two(1 + k * 11 % 28))
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        "c_acctbal",
        _id(k).alias("external_id"),
        F.when(k % 40 == 3, "")
        .when(k % 7 == 2, F.concat(F.lit("  "), "c_name", F.lit(" ")))
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.when(k % 40 == 13, F.lit(None))
        .when(k % 40 == 23, "04/11/1971")
        .when(k % 400 == 77, "1999-02-30")
        .otherwise(day)
        .alias("birth_date"),
        F.when(k % 40 == 33, F.lit(None))
        .when(k % 25 == 0, "Other")
        .when(k % 2 == 0, "F")
        .otherwise("M")
        .alias("gender"),
        _by_index(k % 8, BLOOD_BY_KEY).alias("blood_type"),
    )
    return _with_copies(rows, "c_custkey")


def _admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(k % 20 == 7, F.concat(F.lit("HOSP-"), (900_000 + k % 100_000).cast("string")))
        .otherwise(_id(c))
        .alias("patient_external_id"),
        F.when(k % 20 == 11, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("admission_date"),
        F.when(F.col("o_orderstatus") != "O", F.date_format(F.date_add(day, (1 + k % 30).cast("int")), "yyyy-MM-dd")).alias(
            "discharge_date"
        ),
        _by_index(k % 10, DEPARTMENT_BY_KEY).alias("department"),
        _by_index((k + c) % 11, CODE_BY_KEY).alias("diagnosis_code"),
        F.when(F.col("o_orderstatus") == "O", "admitted")
        .when(F.col("o_orderstatus") == "F", "discharged")
        .when(F.col("o_orderstatus") == "P", "transferred")
        .alias("status"),
    )
    rows = rows.withColumn("diagnosis_description", describe(F.col("diagnosis_code")))
    return _with_copies(rows, "o_orderkey")


def patients_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _patients(spark, sf_dir).select(*PATIENT_COLUMNS)


def admissions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _admissions(spark, sf_dir).select(*ADMISSION_COLUMNS)


def patients_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the customer's market segment, which splits the patients into batches."""
    return _patients(spark, sf_dir).select("c_mktsegment", *PATIENT_COLUMNS)


def admissions_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the segment of the ordering customer; one segment per key, so no row is multiplied."""
    customers = table(spark, sf_dir, "customer")
    segments = customers.groupBy(F.col("c_custkey").alias("o_custkey")).agg(F.min("c_mktsegment").alias("c_mktsegment"))
    return _admissions(spark, sf_dir).join(segments, "o_custkey").select("c_mktsegment", *ADMISSION_COLUMNS)


def stored_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients as an earlier load might have left them: other names, no blood type column.

    Those of all segments but FURNITURE, unique by id.
    """
    old = _patients(spark, sf_dir).filter("c_mktsegment <> 'FURNITURE'")
    return old.groupBy("external_id").agg(
        F.min(F.concat(F.lit("old "), F.trim("name"))).alias("name"),
        F.lit(1).alias("age"),
        F.min("c_mktsegment").alias("ward"),
        F.lit("2026-01-01").cast("timestamp").alias("created_at"),
        F.lit("2026-01-01").cast("timestamp").alias("updated_at"),
    )


def batch_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw patients of the customers who owe nothing."""
    return _patients(spark, sf_dir).filter("c_acctbal >= 0").select(*PATIENT_COLUMNS)


def patients_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _patients(spark, sf_dir).select(
        F.when(k % 31 == 5, F.lit(None))
        .when(k % 31 == 9, F.concat(F.lit("BAD-"), k.cast("string")))
        .when(k % 31 == 11, F.substring("external_id", 1, 10))
        .when(k % 31 == 13, F.lower("external_id"))
        .otherwise(F.col("external_id"))
        .alias("external_id"),
        F.when(k % 19 == 3, "   ").when(k % 19 == 5, "\t").when(k % 19 == 7, F.lit(None)).otherwise(F.col("name")).alias("name"),
        "birth_date",
        F.when(k % 23 == 2, "X").when(k % 23 == 4, "m").otherwise(F.col("gender")).alias("gender"),
        F.when(k % 29 == 3, F.lit(None))
        .when(k % 29 == 7, "C+")
        .when(k % 29 == 9, "a+")
        .otherwise(F.col("blood_type"))
        .alias("blood_type"),
    )


def admissions_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _admissions(spark, sf_dir).select(
        F.when(k % 37 == 1, F.lit(None))
        .when(k % 37 == 3, F.concat(F.lit("X"), "patient_external_id"))
        .otherwise(F.col("patient_external_id"))
        .alias("patient_external_id"),
        F.when(k % 47 == 2, F.lit(None)).when(k % 47 == 4, "2025-1-5").otherwise(F.col("admission_date")).alias("admission_date"),
        "discharge_date",
        F.when(k % 41 == 2, F.lit(None)).when(k % 41 == 5, "   ").otherwise(F.col("department")).alias("department"),
        "diagnosis_code",
        "diagnosis_description",
        F.when(k % 43 == 1, F.lit(None))
        .when(k % 43 == 4, "unknown")
        .when(k % 43 == 6, "Admitted")
        .otherwise(F.col("status"))
        .alias("status"),
    )


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File list: name, first bytes as ``content``, length. Every eighth image is of one of five patients."""
    k = F.col("vec_id")
    patient = _id(F.when(k % 8 == 0, k % 5).otherwise(k))
    text = k.cast("string")
    return table(spark, sf_dir, "embeddings").select(
        F.when(k % 20 == 7, F.concat(F.lit("random_"), text, F.lit(".png")))
        .when(k % 20 == 9, F.concat(patient, F.lit("_notes"), text, F.lit(".txt")))
        .when(k % 20 == 11, F.concat(patient, F.lit("_xray"), text, F.lit(".PNG")))
        .otherwise(F.concat(patient, F.lit("_xray"), text, F.lit(".png")))
        .alias("name"),
        F.when(k % 25 == 4, F.lit(BAD_HEADER)).otherwise(F.lit(PNG_SIGNATURE)).alias("content"),
        (67 + k).cast("long").alias("length"),
    )


def page_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as stored objects: the host is the bucket."""
    return table(spark, sf_dir, "pages").select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("bucket"),
        F.concat(F.split_part("url", F.lit("/"), F.lit(4)), F.lit("/"), F.col("page_id"), F.lit(".html")).alias("object_key"),
        F.encode("html", "UTF-8").alias("content"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run ledger: each opens a run, most of them also close it an hour later."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    opened = F.struct(
        F.col("ts").alias("event_at"), kind.alias("trigger_type"), F.lit("running").alias("status"), *_counts(0, 0), _text(None)
    )
    closed = F.struct(
        (F.col("ts") + F.expr("interval 1 hour")).alias("event_at"),
        F.lit(None).cast("string").alias("trigger_type"),
        F.when(kind == "error", "failed").otherwise("success").alias("status"),
        *_counts(F.floor(F.col("value") * 10), F.col("user_id")),
        F.when(kind == "error", F.concat(F.lit("RuntimeError: "), "props")).alias("error_message"),
    )
    # a run of type "view" is still running
    both = F.when(kind == "view", F.array(opened)).otherwise(F.array(opened, closed))
    return events.select(F.col("event_id").cast("string").alias("run_id"), F.explode(both).alias("e")).select("run_id", "e.*")


def _counts(processed, rejected) -> list[Column]:
    numbers = zip([processed, rejected, 0], ["records_processed", "records_rejected", "images_processed"])
    return [(n if isinstance(n, Column) else F.lit(n)).cast("long").alias(name) for n, name in numbers]


def _text(value) -> Column:
    return F.lit(value).cast("string").alias("error_message")
