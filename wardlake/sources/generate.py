"""Dirty test data from integer keys: any number of rows, the same for the same seed.

Every generator takes a frame with one integer column ``key``: ``spark.range(n)`` renamed, or
the keys of any table. Rows follow from (key, seed) alone.
"""

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import below, draw, pick, weighted
from wardlake.operators.numbering import numbered
from wardlake.schemas import ADMISSION_COLUMNS, BLOOD_TYPES, GENDERS, PATIENT_COLUMNS, PNG_SIGNATURE, STATUSES

# ---- fixed values: odds, departments, diagnoses ----
BLOOD_TYPE_ODDS = [0.34, 0.06, 0.09, 0.02, 0.04, 0.01, 0.38, 0.07]
GENDER_ODDS = [0.48, 0.48, 0.04]
DEPARTMENTS = [
    "Urgencias",
    "UCI",
    "Medicina Interna",
    "Cardiologia",
    "Neumologia",
    "Traumatologia",
    "Pediatria",
    "Ginecologia",
    "Oncologia",
    "Radiologia",
]
DIAGNOSES = {
    "J18.9": "Pneumonia, unspecified",
    "J18.0": "Bronchopneumonia",
    "U07.1": "COVID-19",
    "J44.9": "Chronic obstructive pulmonary disease",
    "I21.9": "Acute myocardial infarction",
    "R05": "Cough",
    "R50.9": "Fever, unspecified",
    "S72.9": "Fracture of femur",
    "K35.80": "Acute appendicitis",
    "N39.0": "Urinary tract infection",
}
DUPLICATE_RATIO = 0.03
EDGE_KINDS = 4

# names of our own for the generated people
GIVEN_NAMES = ["Alba", "Bruno", "Carla", "Dario", "Elena", "Fabio", "Gala", "Hugo", "Irene", "Jorge"]
FAMILY_NAMES = ["Arias", "Bravo", "Campos", "Duran", "Esteve", "Fuentes", "Gallego", "Herrero", "Ibarra", "Lozano"]


def padded_id(number: Column) -> Column:
    return F.format_string("HOSP-%06d", number)


def placeholder_png() -> bytes:
    """A valid image of one transparent pixel."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")

    header = chunk(b"IHDR", bytes([0, 0, 0, 1, 0, 0, 0, 1, 8, 6, 0, 0, 0]))
    return PNG_SIGNATURE + header + chunk(b"IDAT", zlib.compress(bytes(5))) + chunk(b"IEND", b"")


def _day_between(key: Column, seed: int, last_day: str, days: int) -> Column:
    """A day in the ``days`` days that end on ``last_day``."""
    return F.date_sub(F.lit(last_day).cast("date"), (draw(key, seed) % days).cast("int"))


def generate_patients(keys: DataFrame, edge_ratio: float = 0.05, seed: int = 0, today: str = "2026-04-21") -> DataFrame:
    """Patients aged 5 to 85; ``edge_ratio`` of them get one of four defects, 3 % a twin."""
    key = F.col("key")
    s = seed * 100
    # between 5 and 85 years before today
    birth = F.date_sub(F.date_sub(F.lit(today).cast("date"), 5 * 365 + 2), (draw(key, s + 1) % (80 * 365)).cast("int"))
    edge = F.when(below(key, s + 2, edge_ratio), draw(key, s + 3) % EDGE_KINDS).otherwise(-1)
    people = keys.select(
        key,
        edge.alias("edge"),
        birth.alias("birth"),
        F.concat_ws(
            " ", pick(key, s + 4, GIVEN_NAMES), pick(key, s + 5, FAMILY_NAMES), pick(key, s + 6, FAMILY_NAMES)
        ).alias("full_name"),
        weighted(key, s + 7, GENDERS, GENDER_ODDS).alias("sex"),
        weighted(key, s + 8, BLOOD_TYPES, BLOOD_TYPE_ODDS).alias("blood_type"),
        _copies(key, s + 9, edge_ratio).alias("copies"),
    )
    rows = people.select(
        padded_id(key).alias("external_id"),
        F.when(F.col("edge") == 0, "").otherwise(F.col("full_name")).alias("name"),
        F.when(F.col("edge") == 1, "")
        .when(F.col("edge") == 3, F.date_format("birth", "dd/MM/yyyy"))
        .otherwise(F.date_format("birth", "yyyy-MM-dd"))
        .alias("birth_date"),
        F.when(F.col("edge") == 2, "").otherwise(F.col("sex")).alias("gender"),
        "blood_type",
        F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_copy"),
    )
    return rows.select(*PATIENT_COLUMNS)


def _copies(key: Column, seed: int, edge_ratio: float) -> Column:
    """2 for about 3 % of the keys, always for key 0, else 1; no twins without edge cases."""
    if edge_ratio <= 0:
        return F.lit(1)
    return F.when(below(key, seed, DUPLICATE_RATIO) | (key == 0), 2).otherwise(1)


def generate_admissions(
    keys: DataFrame, patients: DataFrame, edge_ratio: float = 0.05, seed: int = 1, today: str = "2026-04-21"
) -> DataFrame:
    """Admissions of the given patients, any ids in a column ``external_id``, in the last two years.

    Each row draws a number, and the ids are numbered from 0 in ascending order; an id given twice
    is drawn twice as often. ``edge_ratio`` of the rows name a patient who does not exist, and as
    many carry a date in the wrong format. A discharge follows 1 to 30 days later unless still
    admitted.
    """
    ids, n_patients = numbered(patients.select("external_id"), ["external_id"], "_number")
    if n_patients < 1:
        raise ValueError("there must be at least one patient")
    key = F.col("key")
    s = seed * 100
    drawn = keys.select(key, F.when(~below(key, s + 1, edge_ratio), draw(key, s + 3) % n_patients).alias("_number"))
    # numbers are drawn evenly, so no patient is a hot key of this join
    known = drawn.join(ids, "_number", "left")
    stranger = padded_id(900_000 + draw(key, s + 2) % 100_000)
    rows = known.select(
        F.when(F.col("_number").isNull(), stranger).otherwise(F.col("external_id")).alias("patient_external_id"),
        _day_between(key, s + 4, today, 730).alias("day"),
        (draw(key, s + 5) % 30 + 1).cast("int").alias("stay"),
        pick(key, s + 6, STATUSES).alias("status"),
        pick(key, s + 7, DEPARTMENTS).alias("department"),
        pick(key, s + 8, list(DIAGNOSES)).alias("diagnosis_code"),
        below(key, s + 9, edge_ratio).alias("bad_date"),
    )
    return rows.select(
        "patient_external_id",
        F.when(F.col("bad_date"), F.date_format("day", "dd/MM/yyyy"))
        .otherwise(F.date_format("day", "yyyy-MM-dd"))
        .alias("admission_date"),
        F.when(F.col("status") == "admitted", "")
        .otherwise(F.date_format(F.date_add("day", F.col("stay")), "yyyy-MM-dd"))
        .alias("discharge_date"),
        "department",
        "diagnosis_code",
        describe(F.col("diagnosis_code")).alias("diagnosis_description"),
        "status",
    ).select(*ADMISSION_COLUMNS)


def describe(code: Column) -> Column:
    """Description of a diagnosis code, null for an unknown one."""
    table = F.create_map(*[F.lit(x) for pair in DIAGNOSES.items() for x in pair])
    return F.try_element_at(table, code)


def generate_images(keys: DataFrame, most: int = 3, seed: int = 0) -> DataFrame:
    """1 to ``most`` placeholder PNGs per patient key: name, length, content."""
    key = F.col("key")
    png = placeholder_png()
    count = (draw(key, seed * 100 + 1) % most + 1).cast("int")
    n = keys.select(padded_id(key).alias("patient"), F.explode(F.sequence(F.lit(1), count)).alias("n"))
    return n.select(
        F.concat("patient", F.lit("_xray"), F.col("n").cast("string"), F.lit(".png")).alias("name"),
        F.lit(len(png)).cast("long").alias("length"),
        F.lit(png).alias("content"),
    )
