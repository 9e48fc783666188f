"""What the plans must and must not contain."""

import pytest

from wardlake.catalog import QUERIES
from wardlake.plans.store import ClinicalStore

DATA = "/root/testdata/sf0.001"
# these run jobs while they are built, or write files
EAGER = {
    "admissions_deep_page",
    "archived_batches",
    "blob_contents",
    "chosen_images",
    "contract_errors",
    "generated_admissions",
    "etl_rerun",
    "etl_run",
    "image_ingest",
    "incremental_batches",
    "read_contract_admissions",
    "read_contract_patients",
    "run_outcomes",
    "second_load",
    "served_pages",
    "stored_counts",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    for word in ["Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "InMemoryTableScan", "ExistingRDD"]:
        assert word not in plan, word


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(QUERIES["patient_summary"](spark, DATA))
    assert plan.count("FileScan") == 2
    assert "o_totalprice" not in plan and "c_acctbal" not in plan and "o_orderpriority" not in plan


def test_groups_combine_before_the_shuffle(spark):
    for name in ["clean_admissions", "clean_patients", "admissions_by_month", "run_states", "duplicate_admissions", "blob_index"]:
        assert "partial_" in plan_of(QUERIES[name](spark, DATA)), name


def test_cleaning_shuffles_once(spark):
    assert plan_of(QUERIES["clean_admissions"](spark, DATA)).count("Exchange hashpartitioning") == 1
    assert "Exchange" not in plan_of(QUERIES["validate_admissions"](spark, DATA))


def test_pages_are_a_top_k(spark):
    for name in ["patients_page", "admissions_page", "radiographies_page", "run_history"]:
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, DATA)), name


def test_children_are_linked_without_a_shuffle_at_any_size(spark):
    """Also when sizes speak against it: the bound on the ids is what counts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(QUERIES["orphan_admissions"](spark, DATA))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert "RLIKE" in plan.split("BroadcastExchange")[1]
        # other columns of the patients are never broadcast
        documents = plan_of(QUERIES["patient_documents"](spark, DATA))
        assert all("name" not in part.split("\n")[0] for part in documents.split("BroadcastExchange")[1:])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ids_reach_the_scan_of_a_lookup(spark, tmp_path):
    store = ClinicalStore(spark, str(tmp_path / "store"))
    people = spark.createDataFrame([(f"HOSP-{i:06d}", "n") for i in range(3)], "external_id string, name string")
    rows = [(f"HOSP-{i:06d}", "2025-01-01", "UCI") for i in range(3)]
    store.load_batch(people, spark.createDataFrame(rows, "patient_external_id string, admission_date string, department string"))
    plan = plan_of(store.admissions(["HOSP-000001"]))
    assert "EqualTo(patient_external_id,HOSP-000001)" in plan or "In(patient_external_id" in plan
    store.put_objects(spark.createDataFrame([("b", "k", b"1")], "bucket string, object_key string, content binary"))
    assert "content#" not in plan_of(store.blobs())
