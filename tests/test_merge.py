from datetime import datetime, timezone

from wardlake.operators.merge import merge_stats, merge_upsert, new_radiographies, replace_admissions

T0, T1 = datetime(2026, 1, 1, tzinfo=timezone.utc), datetime(2026, 2, 1, tzinfo=timezone.utc)
SCHEMA = "external_id string, name string, ward string, created_at timestamp, updated_at timestamp"


def test_fields_survive_or_are_overwritten(spark):
    stored = spark.createDataFrame([("a", "old", "w1", T0, T0), ("b", "old", "w2", T0, T0)], SCHEMA)
    batch = spark.createDataFrame([("b", None, 7), ("c", "new", 8)], "external_id string, name string, age int")
    merged = merge_upsert(stored, batch, "external_id", T1)
    rows = {r["external_id"]: r for r in merged.collect()}
    t0, t1 = T0.replace(tzinfo=None), T1.replace(tzinfo=None)
    assert tuple(rows["a"]) == ("a", "old", "w1", t0, t0, None)
    assert tuple(rows["b"]) == ("b", None, "w2", t0, t1, 7)  # null overwrites, ward survives
    assert tuple(rows["c"]) == ("c", "new", None, t1, t1, 8)
    assert merge_stats(merged, T1).head().asDict() == {"upserted": 1, "modified": 1}


def test_merging_twice_changes_nothing(spark):
    stored = spark.createDataFrame([("a", "old", "w1", T0, T0)], SCHEMA)
    batch = spark.createDataFrame([("a", "x"), ("b", "y")], "external_id string, name string")
    once = merge_upsert(stored, batch, "external_id", T1)
    twice = merge_upsert(once, batch, "external_id", T1)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_update_only(spark):
    stored = spark.createDataFrame([("a", "old", "w1", T0, T0)], SCHEMA)
    batch = spark.createDataFrame([("a", "x"), ("b", "y")], "external_id string, name string")
    assert merge_upsert(stored, batch, "external_id", T1, insert=False).count() == 1


def test_admissions_are_replaced_per_patient(spark):
    columns = "patient_external_id string, admission_date string"
    stored = spark.createDataFrame([("HOSP-000001", "d1"), ("HOSP-000001", "d2"), ("HOSP-000002", "d1")], columns)
    patients = spark.createDataFrame([("HOSP-000001",), ("HOSP-000003",)], "external_id string")
    batch = spark.createDataFrame([("HOSP-000001", "d9"), ("HOSP-000009", "d9")], columns)
    got = sorted(map(tuple, replace_admissions(stored, patients, batch).collect()))
    assert got == [("HOSP-000001", "d9"), ("HOSP-000002", "d1")]


def test_radiographies_are_added_once(spark):
    columns = "patient_external_id string, minio_object_key string, file_size_bytes long"
    stored = spark.createDataFrame([("HOSP-000001", "k1", 1)], columns)
    images = spark.createDataFrame([("HOSP-000001", "k1", 2), ("HOSP-000001", "k2", 2), ("HOSP-000001", "k2", 3), ("HOSP-000009", "k3", 2)], columns)
    patients = spark.createDataFrame([("HOSP-000001",)], "external_id string")
    assert [tuple(r) for r in new_radiographies(stored, images, patients).collect()] == [("HOSP-000001", "k2", 2)]
