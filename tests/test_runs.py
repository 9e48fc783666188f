from datetime import date

import pytest

from wardlake import fs
from wardlake.plans import serve
from wardlake.plans.pipeline import initial_load, run_batches, run_from_files
from wardlake.plans.store import ClinicalStore
from wardlake.schemas import ADMISSION_COLUMNS, PATIENT_COLUMNS, PNG_SIGNATURE

DAY = date(2026, 4, 21)


@pytest.fixture
def store(spark, tmp_path):
    return ClinicalStore(spark, str(tmp_path / "store"))


def test_a_whole_run(spark, store, inputs):
    result = run_from_files(store, *inputs, reference=DAY)
    assert result.status == "success"
    # 2 patients, 4 admissions (one is an orphan, which counts); 2 + 1 rejects
    assert (result.records_processed, result.records_rejected) == (6, 3)
    docs = {d["external_id"]: d for d in store.documents().collect()}
    assert set(docs) == {"HOSP-000001", "HOSP-000002"}
    ana = docs["HOSP-000001"]
    assert ana["age"] == 54 and ana["_source_file"] == "patients.csv"
    assert {a["diagnosis_category"] for a in ana["admissions"]} == {"Pneumonia", "COVID-19"}
    assert docs["HOSP-000002"]["name"] == "Oriol Sanz" and len(docs["HOSP-000002"]["admissions"]) == 1

    rejects = {(r["source_file"], r["rejection_reason"]) for r in store.rejected(result.run_id).collect()}
    assert rejects == {("patients.csv", "missing name"), ("patients.csv", "invalid birth_date"), ("admissions.csv", "invalid admission_date")}
    bad_day = store.rejected().filter("rejection_reason = 'invalid admission_date'").head()["raw_data"]
    assert bad_day["admission_date"] == "14/08/2024" and bad_day["discharge_date"] is None
    assert set(bad_day) == {*ADMISSION_COLUMNS, "_source_file"}

    run = serve.latest_run(store)
    assert (run["run_id"], run["status"], run["records_processed"], run["records_rejected"], run["images_processed"]) == (
        result.run_id,
        "success",
        6,
        3,
        0,
    )
    assert fs.names(spark, f"{store.root}/_landing") == []


def test_running_twice(store, inputs):
    first = run_from_files(store, *inputs)
    second = run_from_files(store, *inputs)
    assert first[2:] == second[2:]
    assert store.patients().count() == 2 and store.admissions().count() == 3
    assert store.runs().count() == 2
    assert store.rejected().count() == 6 and store.rejected(second.run_id).count() == 3


def test_a_run_opened_beforehand(store, inputs):
    run_id = store.open_run("manual")
    assert run_from_files(store, *inputs, run_id=run_id).run_id == run_id
    assert store.runs().count() == 1


def test_a_missing_file_fails_the_run(spark, store, tmp_path):
    missing = str(tmp_path / "none.csv")
    with pytest.raises(FileNotFoundError):
        run_from_files(store, missing, missing)
    run = serve.latest_run(store)
    assert run["status"] == "failed" and run["error_message"].startswith("FileNotFoundError: ")


def test_missing_columns_fail_the_run(store, write_text, inputs):
    bad = write_text("bad.csv", PATIENT_COLUMNS[1:], "Nuria,1971-11-04,F,A+")
    with pytest.raises(ValueError):
        run_from_files(store, bad, inputs[1])
    assert serve.latest_run(store)["error_message"].startswith("MissingColumnsError: ")
    assert store.is_empty()


def test_the_first_error_goes_on_when_the_run_cannot_be_closed(store, monkeypatch, tmp_path):
    def broken(*args, **kwargs):
        raise OSError("ledger away")

    monkeypatch.setattr(store, "close_run", broken)
    with pytest.raises(FileNotFoundError):
        run_from_files(store, str(tmp_path / "none.csv"), "x")


def test_no_run_when_it_cannot_be_opened(store, monkeypatch, inputs):
    def broken(*args, **kwargs):
        raise OSError("ledger away")

    monkeypatch.setattr(store, "open_run", broken)
    with pytest.raises(OSError):
        run_from_files(store, *inputs)
    assert store.runs().count() == 0


def test_without_valid_patients_nothing_is_stored(store, write_text, inputs):
    patients = write_text("p.csv", PATIENT_COLUMNS, "BAD,Nuria,1971-11-04,F,A+")
    result = run_from_files(store, patients, inputs[1])
    assert store.is_empty() and store.admissions().count() == 0
    assert (result.records_processed, result.records_rejected) == (4, 2)


def test_initial_load(spark, store, inputs, tmp_path):
    images = tmp_path / "images"
    images.mkdir()
    for name in ["HOSP-000001_a.png", "HOSP-000001_b.PNG", "HOSP-000009_a.png", "random.png", "HOSP-000001_c.txt"]:
        (images / name).write_bytes(PNG_SIGNATURE + name.encode())
    (images / "HOSP-000002_bad.png").write_bytes(b"not a real png")
    first = initial_load(store, *inputs, str(images), reference=DAY)
    assert first == {"uploaded": 3, "already there": 0, "attached": 2, "orphans": 1, "added": 2}
    second = initial_load(store, *inputs, str(images), reference=DAY)
    assert second == {"uploaded": 0, "already there": 3, "attached": 2, "orphans": 1, "added": 0}
    assert store.runs().count() == 1 and serve.latest_run(store)["trigger_type"] == "bootstrap"
    assert serve.radiographies_page(store).total == 2
    keys = {r["object_key"] for r in store.blobs().collect()}
    assert keys == {"HOSP-000001/HOSP-000001_a.png", "HOSP-000001/HOSP-000001_b.PNG", "HOSP-000009/HOSP-000009_a.png"}
    with pytest.raises(FileNotFoundError):
        initial_load(store, *inputs, str(tmp_path / "no-images"))


@pytest.fixture
def three_pairs(write_text, inputs):
    """The fixture's pair; one with a patient of it, a new one, a reject and an orphan; one without valid patients."""
    second = (
        write_text("two/patients.csv", PATIENT_COLUMNS, "HOSP-000001,Nuria Vidal Mas,1971-11-04,F,A-", "HOSP-000007,Pau,1980-01-01,M,O+", "BAD,Pau,1980-01-01,M,O+"),
        write_text("two/admissions.csv", ADMISSION_COLUMNS, "HOSP-000001,2025-01-01,,UCI,R05,Cough,admitted", "HOSP-000002,2025-01-01,,UCI,R05,Cough,admitted"),
    )
    third = (write_text("three/patients.csv", PATIENT_COLUMNS, "HOSP-000001,,1971-11-04,F,A-"), second[1])
    return [inputs, second, third]


def rows_of(store):
    stamps = ["created_at", "updated_at", "admissions_load", "admissions_at"]
    people = sorted(map(str, store.patients().drop(*stamps).collect()))
    stays = sorted(map(str, store.admissions().collect()))
    runs = sorted((r["trigger_type"], r["status"], r["records_processed"], r["records_rejected"]) for r in store.runs().collect())
    rejects = sorted((r["source_file"], r["rejection_reason"], str(sorted(r["raw_data"].items(), key=str))) for r in store.rejected().collect())
    return people, stays, runs, rejects


def test_pairs_together_end_as_one_after_another(spark, store, three_pairs, tmp_path):
    names = ["one", "two", "three"]
    results = run_batches(store, three_pairs, names, reference=DAY)
    assert [(r.status, r.records_processed, r.records_rejected) for r in results] == [("success", 6, 3), ("success", 4, 1), ("success", 2, 1)]
    alone = ClinicalStore(spark, str(tmp_path / "alone"))
    for pair, name in zip(three_pairs, names):
        run_from_files(alone, *pair, trigger_type=name, reference=DAY)
    assert rows_of(store) == rows_of(alone)
    assert store.patients().filter("external_id = 'HOSP-000001'").head()["name"] == "Nuria Vidal Mas"
    assert fs.names(spark, f"{store.root}/_landing") == []


def test_a_broken_pair_does_not_hold_up_the_others(spark, store, three_pairs, tmp_path):
    broken = (str(tmp_path / "none.csv"), three_pairs[1][1])
    results = run_batches(store, [three_pairs[0], broken, three_pairs[1]], ["one", "none", "two"], reference=DAY)
    assert [r.status for r in results] == ["success", "failed", "success"]
    assert [(r["trigger_type"], r["status"]) for r in sorted(store.runs().collect(), key=lambda r: r["trigger_type"])] == [("none", "failed"), ("one", "success"), ("two", "success")]
    assert store.patients().count() == 3 and store.rejected().count() == 4
