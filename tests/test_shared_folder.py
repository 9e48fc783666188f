"""Queries that write files, under the name of a cluster that shares its checkpoint folder only."""

import pytest

from wardlake import fs
from wardlake.catalog import QUERIES


@pytest.fixture
def cluster(spark, tmp_path, monkeypatch):
    """Folder of small tables; the session has a cluster's name and a shared folder."""
    rows = {
        "pages": ([(k, f"https://host{k % 2}/en/{k}", f"<p>{k}</p>") for k in range(4)], "page_id long, url string, html string"),
        "embeddings": ([(k,) for k in range(1, 7)], "vec_id long"),
        "customer": (
            [(k, f"Customer {k}", "BUILDING", 1.0) for k in range(1, 5)],
            "c_custkey long, c_name string, c_mktsegment string, c_acctbal double",
        ),
        "orders": (
            [(k, k, "2024-01-02", "O") for k in range(1, 5)],
            "o_orderkey long, o_custkey long, o_orderdate string, o_orderstatus string",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(fs, "checkpoint_folder", lambda spark: f"file://{tmp_path}/shared")
    return str(tmp_path)


def test_exported_objects(spark, cluster):
    got = {(r["bucket"], r["object_key"], r["length"]) for r in QUERIES["exported_objects"](spark, cluster).collect()}
    assert got == {(f"{b}host{k % 2}", f"en/{k}.html", 8) for b in ("", "copy-") for k in range(4)}


def test_image_ingest(spark, cluster):
    got = {(r["minio_object_key"], r["length"], r["patient_external_id"]) for r in QUERIES["image_ingest"](spark, cluster).collect()}
    # the fourth file has a broken header, the third patient no name, and others are unknown
    keys = {k: f"HOSP-{k:06d}/HOSP-{k:06d}_xray{k}.png" for k in (1, 2, 3, 5, 6)}
    assert got == {(key, 8 + len(key.split("/")[1]), f"HOSP-{k:06d}" if k < 3 else None) for k, key in keys.items()}


def test_second_load(spark, cluster):
    got = {r["item"]: r["total"] for r in QUERIES["second_load"](spark, cluster).collect()}
    # of the three valid patients one has only an image with a broken header
    assert got == {"first call: uploaded": 5, "second call: already there": 5, "written": 5, "attached": 2, "patients": 3, "runs": 1}
