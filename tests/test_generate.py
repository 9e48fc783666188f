import pytest
from pyspark.sql import functions as F

from wardlake.functions.draws import PRIME, draw
from wardlake.operators.validate import validate_admissions, validate_patients
from wardlake.schemas import ADMISSION_COLUMNS, PATIENT_COLUMNS
from wardlake.sources.generate import generate_admissions, generate_images, generate_patients


def keys(spark, n):
    return spark.range(n).withColumnRenamed("id", "key")


def people(spark, n):
    return spark.range(n).select(F.format_string("HOSP-%06d", "id").alias("external_id"))


def test_draws_are_even(spark):
    n = 20_000
    tenth = spark.range(n).groupBy((draw(F.col("id"), 5) * 10 / PRIME).cast("int").alias("b")).count().collect()
    assert len(tenth) == 10 and all(0.09 * n < r["count"] < 0.11 * n for r in tenth)
    # two seeds do not move together
    both = spark.range(n).filter((draw(F.col("id"), 5) < PRIME // 10) & (draw(F.col("id"), 6) < PRIME // 10)).count()
    assert 0.007 * n < both < 0.013 * n


def test_clean_patients(spark):
    df = generate_patients(keys(spark, 500), edge_ratio=0.0, seed=42)
    assert df.columns == PATIENT_COLUMNS and df.count() == 500
    assert df.select("external_id").distinct().count() == 500
    assert validate_patients(df).rejected.count() == 0
    years = df.select(F.months_between(F.lit("2026-04-21").cast("date"), F.to_date("birth_date")) / 12)
    low, high = years.agg(F.min(years.columns[0]), F.max(years.columns[0])).head()
    assert 4.99 < low and high < 85.1


def test_defects(spark):
    n = 4000
    df = generate_patients(keys(spark, n), edge_ratio=0.3, seed=42)
    twins = df.count() - n
    assert 0.02 * n < twins < 0.04 * n
    reasons = {r["rejection_reason"]: r["count"] for r in validate_patients(df).rejected.groupBy("rejection_reason").count().collect()}
    assert set(reasons) == {"missing name", "invalid birth_date", "invalid gender"}
    assert 0.25 * n < sum(reasons.values()) < 0.36 * n
    assert reasons["invalid birth_date"] > 1.5 * reasons["missing name"]
    assert df.filter("birth_date like '%/%'").count() > 0


def test_blood_types_follow_their_odds(spark):
    rows = {r["blood_type"]: r["count"] for r in generate_patients(keys(spark, 5000), 0.0, 1).groupBy("blood_type").count().collect()}
    assert 0.36 < rows["O+"] / 5000 < 0.40 and rows["AB-"] < 120


def test_admissions(spark):
    df = generate_admissions(keys(spark, 2000), people(spark, 50), edge_ratio=0.0, seed=43)
    assert df.columns == ADMISSION_COLUMNS and validate_admissions(df).rejected.count() == 0
    assert df.filter("patient_external_id >= 'HOSP-000050'").count() == 0
    assert df.filter("(status = 'admitted') <> (discharge_date = '')").count() == 0
    stays = df.filter("discharge_date <> ''").select(F.datediff("discharge_date", "admission_date").alias("d")).agg(F.min("d"), F.max("d")).head()
    assert tuple(stays) == (1, 30)
    assert df.select("department").distinct().count() == 10 and df.select("diagnosis_code").distinct().count() == 10


def test_orphans_and_bad_days(spark):
    df = generate_admissions(keys(spark, 2000), people(spark, 50), edge_ratio=0.3, seed=43)
    assert 500 < df.filter("patient_external_id >= 'HOSP-900000'").count() < 700
    assert 500 < validate_admissions(df).rejected.count() < 700
    with pytest.raises(ValueError):
        generate_admissions(keys(spark, 1), people(spark, 0))


def test_same_seed_same_rows(spark):
    def rows(seed, parts):
        return sorted(map(tuple, generate_patients(keys(spark, 300).repartition(parts), 0.1, seed).collect()))

    assert rows(7, 1) == rows(7, 5) != rows(8, 1)


def test_images(spark):
    rows = generate_images(keys(spark, 200), most=3, seed=1).collect()
    per_patient = {}
    for r in rows:
        per_patient.setdefault(r["name"][:11], []).append(r["name"])
        assert bytes(r["content"]).startswith(b"\x89PNG") and len(r["content"]) == r["length"]
    assert len(per_patient) == 200 and {len(v) for v in per_patient.values()} == {1, 2, 3}
    assert "HOSP-000007_xray1.png" in {r["name"] for r in rows}


def test_admissions_of_any_ids(spark):
    ids = ["HOSP-000007", "HOSP-999999", "x", "", "Zoë", "HOSP-000007"]
    given = spark.createDataFrame([(i, 1) for i in ids], "external_id string, age int").repartition(3)
    found = generate_admissions(keys(spark, 6000), given, edge_ratio=0.0, seed=9)
    counts = {r["patient_external_id"]: r["count"] for r in found.groupBy("patient_external_id").count().collect()}
    # every id occurs, one that is given twice about twice as often
    assert set(counts) == set(ids) and sum(counts.values()) == 6000
    assert all(850 < n < 1150 for i, n in counts.items() if i != "HOSP-000007") and 1800 < counts["HOSP-000007"] < 2200


def test_numbers_are_dense_and_in_order(spark, monkeypatch):
    from wardlake.operators import ordinals
    from wardlake.operators.numbering import numbered

    monkeypatch.setattr(ordinals, "MAX_FILE_ROWS", 40)
    rows, n = numbered(spark.range(500).selectExpr("id % 7 AS a", "id AS b").repartition(5), ["a", "b"])
    got = sorted((r["number"], (r["a"], r["b"])) for r in rows.collect())
    assert n == 500 and [k for k, _ in got] == list(range(500))
    assert [key for _, key in got] == sorted((i % 7, i) for i in range(500))
    empty, n = numbered(spark.range(0), ["id"])
    assert n == 0 and empty.count() == 0 and empty.columns == ["id", "number"]
