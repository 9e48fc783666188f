from collections import defaultdict

from pyspark.sql import functions as F

from wardlake.operators.links import with_patient, without_patient
from wardlake.operators.metrics import nested_total
from wardlake.operators.nest import patient_documents, unnest_admissions, unnest_radiographies

N_HOT = 400


def tables(spark):
    """Patient 0 has none, patient 1 far more than the others, patient 9 does not exist."""
    ids = [f"HOSP-{i:06d}" for i in range(5)]
    patients = spark.createDataFrame([(i, f"n{i}") for i in ids], "external_id string, name string")
    rows = [("HOSP-000001", f"2025-01-{d % 28 + 1:02d}", f"D{d}") for d in range(N_HOT)]
    rows += [(i, "2025-02-01", f"D{d}") for i in ids[2:] for d in range(3)] + [("HOSP-000009", "2025-02-01", "D")]
    admissions = spark.createDataFrame(rows, "patient_external_id string, admission_date string, department string")
    images = [(i, f"{i}/{n}.png", n) for i in ids[1:3] for n in range(25)]
    images = spark.createDataFrame(images, "patient_external_id string, minio_object_key string, file_size_bytes long")
    return patients, admissions, rows, images


def test_small_patients_have_one_part(spark):
    patients, admissions, rows, images = tables(spark)
    docs = patient_documents(patients, admissions, images).collect()
    assert len(docs) == 5 and {d["part"] for d in docs} == {0} and {d["n_parts"] for d in docs} == {1}
    expected = defaultdict(list)
    for pid, day, department in rows:
        expected[pid].append((day, department))
    for d in docs:
        assert [(a["admission_date"], a["department"]) for a in d["admissions"]] == sorted(expected[d["external_id"]])
    assert docs and next(d for d in docs if d["external_id"] == "HOSP-000000")["admissions"] == []


def test_a_large_patient_is_cut_into_bounded_parts(spark):
    patients, admissions, rows, images = tables(spark)
    docs = patient_documents(patients, admissions, images, part_size=10)
    got = docs.collect()
    hot = [d for d in got if d["external_id"] == "HOSP-000001"]
    assert sorted(d["part"] for d in hot) == list(range(N_HOT // 10))
    assert {d["n_parts"] for d in hot} == {N_HOT // 10}
    assert max(len(d["admissions"]) for d in hot) <= 30
    assert sum(len(d["radiographies"]) for d in hot) == 25
    # nothing lost, nothing twice
    flat = sorted(tuple(r) for r in unnest_admissions(docs).select("patient_external_id", "admission_date", "department").collect())
    assert flat == sorted(r for r in rows if r[0] != "HOSP-000009")
    assert nested_total(docs, "admissions").head()["total"] == len(rows) - 1
    assert nested_total(docs, "radiographies").head()["total"] == 50


def test_unnested_radiographies_name_their_parent(spark):
    inner = "array<struct<patient_external_id string, minio_object_key string>>".replace(" string", ":string")
    docs = spark.createDataFrame(
        [("HOSP-000001", [("other", "k1")]), ("HOSP-000002", []), ("HOSP-000003", None)], f"external_id string, radiographies {inner}"
    )
    assert [tuple(r) for r in unnest_radiographies(docs).collect()] == [("HOSP-000001", "k1")]


def test_nested_total_of_nulls_and_of_nothing(spark):
    docs = spark.createDataFrame([(None,), ([1, 2],)], "a array<int>")
    assert nested_total(docs, "a").head()["total"] == 2
    assert nested_total(docs.limit(0), "a").head()["total"] == 0


def test_links(spark):
    patients, admissions, rows, _ = tables(spark)
    twice = patients.unionByName(patients)
    assert with_patient(admissions, twice).count() == len(rows) - 1
    assert [r["patient_external_id"] for r in without_patient(admissions, twice).collect()] == ["HOSP-000009"]


def test_children_are_not_shuffled_by_patient(spark):
    patients, admissions, _, _ = tables(spark)
    plan = with_patient(admissions, patients)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    docs = patient_documents(patients, admissions).select(F.size("admissions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = docs._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
        assert joins and all("part" in line for line in joins)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
