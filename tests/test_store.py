import pytest
from pyspark.sql import functions as F

from wardlake import fs
from wardlake.plans import serve
from wardlake.plans.store import ClinicalStore
from wardlake.schemas import ADMISSION_COLUMNS


@pytest.fixture
def store(spark, tmp_path):
    return ClinicalStore(spark, str(tmp_path / "store"))


def patients(spark, *rows):
    return spark.createDataFrame(list(rows), "external_id string, name string, age int")


def admissions(spark, *rows):
    df = spark.createDataFrame(list(rows), "patient_external_id string, admission_date string, department string")
    return df.withColumn("status", F.lit("admitted"))


def images(spark, *rows):
    df = spark.createDataFrame(list(rows), "patient_external_id string, minio_object_key string")
    return df.select(
        "*",
        F.lit("f.png").alias("original_filename"),
        F.lit(67).cast("long").alias("file_size_bytes"),
        F.lit("2026-04-20").alias("ingested_at"),
        F.lit(None).cast("string").alias("classification"),
    )


def test_an_empty_store(store):
    assert store.is_empty()
    assert store.patients().count() == store.admissions().count() == store.radiographies().count() == 0
    assert store.documents().count() == store.rejected().count() == store.blobs().count() == 0
    assert serve.admissions_page(store).total == 0 and serve.admissions_page(store).items.count() == 0
    assert serve.latest_run(store) is None


def test_upsert_counts_and_overwrites(spark, store):
    first = patients(spark, ("HOSP-000001", "Nuria", 40), ("HOSP-000002", "Bob", 55))
    assert store.upsert_patients(first) == {"upserted": 2, "modified": 0}
    born = {r["external_id"]: r["created_at"] for r in store.patients().collect()}
    assert store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria", 41))) == {"upserted": 0, "modified": 1}
    rows = {r["external_id"]: r for r in store.patients().collect()}
    assert rows["HOSP-000001"]["age"] == 41 and rows["HOSP-000002"]["age"] == 55
    assert {k: r["created_at"] for k, r in rows.items()} == born
    assert rows["HOSP-000001"]["updated_at"] > rows["HOSP-000002"]["updated_at"]


def test_an_empty_batch_changes_nothing(spark, store):
    version = store._state()["version"]
    assert store.upsert_patients(patients(spark)) == {"upserted": 0, "modified": 0}
    some = admissions(spark, ("HOSP-000001", "2024-07-09", "UCI"))
    assert store.load_batch(patients(spark), some) == {"upserted": 0, "modified": 0}
    assert store.is_empty() and store._state()["version"] == version
    store.load_batch(patients(spark, ("HOSP-000001", "Nuria", 1)), some)
    assert store.load_batch(patients(spark), some) == {"upserted": 0, "modified": 0}
    assert store.admissions().count() == 1


def test_admissions_are_replaced_and_orphans_stay_out(spark, store):
    both = patients(spark, ("HOSP-000001", "Nuria", 40), ("HOSP-000002", "Bob", 55))
    rows = [("HOSP-000001", "2024-07-09", "UCI"), ("HOSP-000001", "2024-10-02", "Urgencias"), ("HOSP-000002", "2024-08-14", "UCI")]
    for _ in range(2):
        store.load_batch(both, admissions(spark, *rows, ("HOSP-000009", "2024-08-14", "UCI")))
        assert store.admissions().count() == 3
    # only Nuria comes again, with one admission; Bob's load is untouched
    store.load_batch(both.filter("name = 'Nuria'"), admissions(spark, ("HOSP-000001", "2026-01-01", "UCI"), ("HOSP-000002", "2026-01-01", "UCI")))
    got = sorted((r[0], r[1]) for r in store.admissions().collect())
    assert got == [("HOSP-000001", "2026-01-01"), ("HOSP-000002", "2024-08-14")]
    # the first load is named by nobody any more
    assert len(store._state()["admissions"]) == 2
    # a patient loaded without admissions has an empty array
    store.load_batch(both.filter("name = 'Bob'"), admissions(spark))
    docs = {d["external_id"]: d for d in store.documents().collect()}
    assert docs["HOSP-000002"]["admissions"] == [] and len(docs["HOSP-000001"]["admissions"]) == 1
    # an update of the patient alone keeps them
    store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria Maria", 41)))
    assert store.admissions().count() == 1 and serve.total(store, "n_admissions") == 1


def test_a_batch_may_name_a_patient_twice(spark, store):
    twice = patients(spark, ("HOSP-000001", "Nuria", 40), ("HOSP-000001", "Zoe", 41))
    assert store.upsert_patients(twice) == {"upserted": 1, "modified": 0}
    assert store.load_batch(twice, admissions(spark, ("HOSP-000001", "2025-01-01", "UCI"))) == {"upserted": 0, "modified": 1}
    assert [r["name"] for r in store.patients().collect()] == ["Nuria"]
    assert store.admissions().count() == 1


def prefixes_written(store):
    """Directories that the latest patients load wrote, by prefix."""
    loads = {of["load"] for of in store._state()["patients"].values()}
    return [n for n in fs.names(store.spark, f"{store.root}/patients/load={max(loads)}") if n.startswith("prefix=")]


def test_a_merge_rewrites_the_prefixes_it_touches(spark, store):
    everyone = spark.range(0, 1_000_000, 2_000).select(F.format_string("HOSP-%06d", "id").alias("external_id"), F.lit("n").alias("name"), F.lit(1).alias("age"))
    assert store.upsert_patients(everyone) == {"upserted": 500, "modified": 0}
    assert len(prefixes_written(store)) == 100
    before = store.pinned()
    few = patients(spark, *[(f"HOSP-{k:02d}0001", "new", 2) for k in range(9)], ("HOSP-500000", "changed", 3))
    assert store.upsert_patients(few) == {"upserted": 9, "modified": 1}
    assert prefixes_written(store) == [f"prefix={k:02d}" for k in (*range(9), 50)]
    assert store.patients().count() == 509 == store.total("n") and before.patients().count() == 500
    assert store.patients().filter("name = 'changed'").head()["external_id"] == "HOSP-500000"
    # a lookup opens one file
    found = serve.find_patient(store, "HOSP-500000")
    assert found.head()["age"] == 3 and len(found.inputFiles()) == 1
    assert serve.find_patient(store, "someone").isEmpty()
    # images move only their patients' prefixes, admissions too
    assert store.attach_radiographies(images(spark, ("HOSP-990000", "HOSP-990000/a.png"))) == 1
    assert prefixes_written(store) == ["prefix=99"]
    store.load_batch(few.limit(1), admissions(spark, ("HOSP-000001", "2025-01-01", "UCI")))
    assert prefixes_written(store) == ["prefix=00"]
    for own in ("prefix", "load", "n_admissions", "admissions_at"):
        with pytest.raises(ValueError):
            store.upsert_patients(few.withColumn(own, F.lit(1)))
    for offset in (0, 17, 498, 508, 600):
        ids = [r["external_id"] for r in serve.patients_page(store, 5, offset).items.collect()]
        assert ids == sorted(r["external_id"] for r in store.patients().collect())[offset : offset + 5]


def test_a_deep_admissions_page_opens_few_files(spark, store, monkeypatch):
    from wardlake.operators import ordinals

    monkeypatch.setattr(ordinals, "MAX_FILE_ROWS", 100_000)
    two = patients(spark, ("HOSP-000001", "Nuria", 40), ("HOSP-000002", "Bob", 50))
    days = spark.range(0, 600_000, 1, 8).select(
        F.format_string("HOSP-%06d", F.when(F.col("id") < 1000, 1).otherwise(2)).alias("patient_external_id"),
        F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("id") % 20_000).cast("int")), "yyyy-MM-dd").alias("admission_date"),
        F.format_string("d%05d", (F.col("id") / 20_000).cast("int")).alias("department"),
    )
    store.load_batch(two, days)
    store.load_batch(two.limit(1), days.filter("id < 10"))
    page = serve.admissions_page(store, 50, 500_000)
    expected = store.admissions().orderBy("patient_external_id", "admission_date", "department").offset(500_000).limit(50)
    assert page.total == 599_010 == store.admissions().count()
    assert [tuple(r)[:4] for r in page.items.collect()] == [tuple(r)[:4] for r in expected.select(*ADMISSION_COLUMNS).collect()]
    assert 1 <= len(page.items.inputFiles()) <= 2 and len(store.all_ordinals("admissions")[0].files) > 5
    # the border between two patients of two loads
    border = serve.admissions_page(store, 4, 8).items.collect()
    assert [r["patient_external_id"] for r in border] == ["HOSP-000001"] * 2 + ["HOSP-000002"] * 2


def test_strange_ids_are_refused(spark, store):
    with pytest.raises(ValueError):
        store.upsert_patients(patients(spark, ("someone", "Nuria", 40)))
    assert store.is_empty()


def test_radiographies(spark, store):
    store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria", 40), ("HOSP-000002", "Bob", 55)))
    batch = images(spark, ("HOSP-000001", "HOSP-000001/a.png"), ("HOSP-000001", "HOSP-000001/a.png"), ("HOSP-000009", "HOSP-000009/a.png"))
    stamps = {r["external_id"]: r["updated_at"] for r in store.patients().collect()}
    assert [store.attach_radiographies(batch) for _ in range(3)] == [1, 0, 0]
    after = {r["external_id"]: r["updated_at"] for r in store.patients().collect()}
    assert after["HOSP-000001"] > stamps["HOSP-000001"] and after["HOSP-000002"] == stamps["HOSP-000002"]
    assert store.attach_radiographies(images(spark, ("HOSP-000001", "HOSP-000001/b.png"))) == 1
    # they survive an update of the patient
    store.load_batch(patients(spark, ("HOSP-000001", "Nuria", 41)), admissions(spark))
    doc = next(d for d in store.documents().collect() if d["external_id"] == "HOSP-000001")
    assert [r["minio_object_key"] for r in doc["radiographies"]] == ["HOSP-000001/a.png", "HOSP-000001/b.png"]
    assert serve.total(store, "n_radiographies") == 2


def test_objects(spark, store):
    def objects(*rows):
        return spark.createDataFrame(list(rows), "bucket string, object_key string, content binary")

    store.put_objects(objects(("b", "p1/x", b"one"), ("b", "p2/y", b"two"), ("c", "p1/x", b"three")), "text/plain")
    store.put_objects(objects(("b", "p1/x", b"newer")))
    store.remove_objects(objects(("b", "p2/y", b"")))
    index = {(r["bucket"], r["object_key"]): (r["length"], r["content_type"]) for r in store.blobs().collect()}
    assert index == {("b", "p1/x"): (5, "application/octet-stream"), ("c", "p1/x"): (5, "text/plain")}
    contents = {bytes(r["content"]) for r in store.blob_contents().collect()}
    assert contents == {b"newer", b"three"}
    one = store.blobs().filter("bucket = 'c'")
    assert [bytes(r["content"]) for r in store.blob_contents(one).collect()] == [b"three"]
    from wardlake.operators.blobs import list_objects, object_exists

    assert [r[0] for r in list_objects(store.blobs(), "b", "p1/").collect()] == ["p1/x"]
    assert object_exists(store.blobs(), "b", "p1/x") and not object_exists(store.blobs(), "b", "p2/y")
    with pytest.raises(ValueError):
        store.put_objects(objects(("b", "k", b"1"), ("b", "k", b"2")))
    assert store.blobs().count() == 2


def test_bytes_stay_in_place_at_any_number_of_stale_objects(spark, store, monkeypatch):
    from wardlake.plans import store as plans

    def objects(keys, text):
        rows = keys.select(F.lit("b").alias("bucket"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("object_key"))
        return rows.withColumn("content", F.encode(F.concat(F.lit(text), "object_key"), "UTF-8"))

    store.put_objects(objects(spark.range(0, 400, 1, 4), "old "))
    store.put_objects(objects(spark.range(100, 300, 1, 2), "new "))
    store.remove_objects(objects(spark.range(250, 350, 1, 3), ""))
    expected = {f"k{i}": ("new " if 100 <= i < 300 else "old ") + f"k{i}" for i in range(400) if not 250 <= i < 350}
    for at_once in (1_000_000, 70, 1):
        monkeypatch.setattr(plans, "PLACES_AT_ONCE", at_once)
        found = store.blob_contents()
        assert {r["object_key"]: bytes(r["content"]).decode() for r in found.collect()} == expected
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        for exchange in [line for line in plan.split("\n") if "Exchange" in line]:
            assert "content" not in exchange
        some = store.blobs().filter("object_key IN ('k5', 'k120', 'k260')")
        assert {bytes(r["content"]) for r in store.blob_contents(some).collect()} == {b"old k5", b"new k120"}
    assert plans._together({(1, "a"): 3, (1, "b"): 9, (2, "c"): 1}) == [[(1, "a")], [(1, "b")], [(2, "c")]]


def test_compaction_keeps_what_is_visible(spark, store):
    both = patients(spark, ("HOSP-000001", "Nuria", 40), ("HOSP-000002", "Bob", 55))
    store.load_batch(both, admissions(spark, ("HOSP-000001", "2024-07-09", "UCI"), ("HOSP-000002", "2024-07-09", "UCI")))
    store.load_batch(both.filter("name = 'Nuria'"), admissions(spark, ("HOSP-000001", "2026-01-01", "UCI")))
    store.attach_radiographies(images(spark, ("HOSP-000001", "HOSP-000001/a.png")))
    store.put_objects(spark.createDataFrame([("b", "k", b"1")], "bucket string, object_key string, content binary"))
    store.put_objects(spark.createDataFrame([("b", "k", b"22")], "bucket string, object_key string, content binary"))
    before = sorted(map(str, store.documents().collect())), store.blobs().drop("load").collect()
    store.compact()
    state = store._state()
    assert [len(state[t]) for t in ("admissions", "radiographies", "blobs")] == [1, 1, 1]
    assert (sorted(map(str, store.documents().collect())), store.blobs().drop("load").collect()) == before


def test_uncommitted_files_are_invisible(spark, store, monkeypatch):
    store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria", 40)))
    monkeypatch.setattr(store, "_commit", lambda state: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        store.upsert_patients(patients(spark, ("HOSP-000002", "Bob", 40)))
    monkeypatch.undo()
    assert store.patients().count() == 1
    assert store.upsert_patients(patients(spark, ("HOSP-000003", "Eva", 40)))["upserted"] == 1
    assert store.patients().count() == 2


def test_a_second_writer_is_refused(spark, store):
    store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria", 40)))
    with pytest.raises(FileExistsError):
        store._commit(store._state())
    assert fs.names(spark, f"{store.root}/_commits") == ["0000000001.json"]


def test_runs(store):
    run = store.open_run()
    opened = store.runs().head()
    assert (opened["run_id"], opened["status"], opened["trigger_type"], opened["finished_at"]) == (run, "running", "manual", None)
    store.close_run(run, "success", {"records_processed": 1234, "records_rejected": 12, "images_processed": 56})
    row = serve.latest_run(store)
    assert row["status"] == "success" and row["finished_at"] >= row["started_at"]
    assert (row["records_processed"], row["records_rejected"], row["images_processed"]) == (1234, 12, 56)
    other = store.open_run("bootstrap")
    store.close_run(other, "failed", error_message="ValueError: x")
    page = serve.runs_page(store, limit=1)
    assert page.total == 2 and [r["run_id"] for r in page.items.collect()] == [other]
    assert serve.latest_run(store)["error_message"] == "ValueError: x"


def test_rejects_are_kept_per_run(spark, store):
    packed = spark.createDataFrame(
        [("patients.csv", "missing name", {"name": None}), ("patients.csv", "invalid gender", {"gender": "X"})],
        "source_file string, rejection_reason string, raw_data map<string,string>",
    )
    assert store.write_rejected(packed, "r1") == 2
    assert store.write_rejected(packed, "r2") == 2
    assert store.write_rejected(packed.limit(0), "r3") == 0
    assert store.rejected().count() == 4
    assert {r["pipeline_run_id"] for r in store.rejected("r1").collect()} == {"r1"}
    assert all(r["created_at"] for r in store.rejected("r1").collect())


def test_pages(spark, store):
    people = patients(spark, *[(f"HOSP-{i:06d}", f"n{i}", i) for i in range(25)])
    rows = [(f"HOSP-{i:06d}", f"2025-01-{d + 1:02d}", "UCI") for i in range(25) for d in range(i % 4)]
    store.load_batch(people, admissions(spark, *rows))
    # keys of both forms: with the patient's id in front, and in an order of their own
    keys = [(f"HOSP-{i:06d}", f"HOSP-{i:06d}/x{n}.png" if n else f"scans/{97 - i}.png") for i in range(0, 25, 2) for n in range(3)]
    store.attach_radiographies(images(spark, *keys))

    page = serve.patients_page(store, limit=10, offset=20)
    items = page.items.collect()
    assert page.total == 25 and [r["external_id"] for r in items] == [f"HOSP-{i:06d}" for i in range(20, 25)]
    assert [r["n_admissions"] for r in items] == [0, 1, 2, 3, 0]
    assert [r["n_radiographies"] for r in items] == [3, 0, 3, 0, 3]
    parts = serve.patient_parts(store, [r["external_id"] for r in items]).collect()
    assert [len(r["admissions"]) for r in parts] == [0, 1, 2, 3, 0] and {r["n_parts"] for r in parts} == {1}
    assert [len(r["radiographies"]) for r in parts] == [3, 0, 3, 0, 3]
    assert "admissions_load" not in page.items.columns

    for offset in (0, 3, 17, len(rows) - 2, len(rows), 1000):
        page = serve.admissions_page(store, limit=5, offset=offset)
        assert page.total == len(rows)
        assert [tuple(r)[:2] for r in page.items.collect()] == [r[:2] for r in sorted(rows)[offset : offset + 5]]
        page = serve.radiographies_page(store, limit=5, offset=offset)
        assert page.total == len(keys)
        assert [r["minio_object_key"] for r in page.items.collect()] == sorted(k for _, k in keys)[offset : offset + 5]
    assert "diagnosis_category" in serve.admissions_page(store).items.columns
    assert set(ADMISSION_COLUMNS) <= set(serve.admissions_page(store).items.columns)

    assert serve.find_patient(store, "HOSP-000003").head()["name"] == "n3"
    assert serve.find_patient(store, "HOSP-999999").isEmpty()
    assert [r["external_id"] for r in serve.patients_after(store, "HOSP-000022", 5).collect()] == ["HOSP-000023", "HOSP-000024"]
    after = serve.admissions_after(store, list(sorted(rows)[4]), 3).collect()
    assert [tuple(r)[:2] for r in after] == [r[:2] for r in sorted(rows)[5:8]]
    with pytest.raises(ValueError):
        serve.admissions_page(store, limit=501)


def test_a_pinned_store_stays_as_it_was(spark, store):
    store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria", 40)))
    before = store.pinned()
    store.upsert_patients(patients(spark, ("HOSP-000002", "Bob", 40)))
    assert before.patients().count() == 1 and store.patients().count() == 2
    with pytest.raises(ValueError):
        before.upsert_patients(patients(spark, ("HOSP-000003", "Eva", 40)))


def test_a_large_patient_is_one_row(spark, store):
    days = spark.range(25_000).selectExpr("'HOSP-000001' AS patient_external_id", "date_format(date_add(date'1950-01-01', cast(id AS int)), 'yyyy-MM-dd') AS admission_date", "'UCI' AS department")
    store.load_batch(patients(spark, ("HOSP-000001", "Nuria", 40), ("HOSP-000002", "Bob", 50)), days)
    found = serve.find_patient(store, "HOSP-000001").collect()
    assert [(r["n_admissions"], r["n_parts"]) for r in found] == [(25_000, 3)]
    assert [r["external_id"] for r in serve.patients_page(store, limit=1).items.collect()] == ["HOSP-000001"]
    parts = serve.patient_parts(store, ["HOSP-000001"]).selectExpr("part", "size(admissions) AS n").collect()
    assert [r["part"] for r in parts] == [0, 1, 2] and sum(r["n"] for r in parts) == 25_000


def test_image_records_need_only_their_key(spark, store):
    store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria", 40)))
    few = spark.createDataFrame([("HOSP-000001", "scans/a.png")], "patient_external_id string, minio_object_key string")
    assert store.attach_radiographies(few) == 1
    assert store.radiographies().head()["file_size_bytes"] is None


def test_a_losing_writer_leaves_the_winner_alone(spark, store, monkeypatch):
    store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria", 40)))
    second = ClinicalStore(spark, store.root)
    real = second._commit

    def late(state):
        # the other writer commits first, from the same version
        monkeypatch.setattr(second, "_commit", real)
        assert store.upsert_patients(patients(spark, ("HOSP-000002", "Bob", 50))) == {"upserted": 1, "modified": 0}
        real(state)

    monkeypatch.setattr(second, "_commit", late)
    with pytest.raises(FileExistsError):
        second.upsert_patients(patients(spark, ("HOSP-000777", "Eva", 60)))
    assert sorted(r["external_id"] for r in store.patients().collect()) == ["HOSP-000001", "HOSP-000002"]


def test_a_batch_may_bring_fields_of_its_own(spark, store):
    store.upsert_patients(patients(spark, ("HOSP-000001", "Nuria", 40), ("HOSP-000002", "Bob", 50)))
    more = spark.createDataFrame([("HOSP-000002", "north", 3), ("HOSP-000003", "south", 4)], "external_id string, ward string, bed int")
    assert store.upsert_patients(more) == {"upserted": 1, "modified": 1}
    assert store.upsert_patients(spark.createDataFrame([("HOSP-000003", 5)], "external_id string, bed long")) == {"upserted": 0, "modified": 1}
    rows = {r["external_id"]: (r["name"], r["ward"], r["bed"]) for r in store.patients().collect()}
    assert rows == {"HOSP-000001": ("Nuria", None, None), "HOSP-000002": ("Bob", "north", 3), "HOSP-000003": (None, "south", 5)}
    assert {d["external_id"]: d["ward"] for d in store.documents().collect()} == {"HOSP-000001": None, "HOSP-000002": "north", "HOSP-000003": "south"}
    store.compact()
    assert store.patients().filter("ward = 'south'").count() == 1


def test_kept_counts_equal_a_count_of_all_rows(spark, store):
    from wardlake.operators import metrics
    from wardlake.operators.clean import enrich_admissions

    def batch(k):
        people = patients(spark, *[(f"HOSP-{i % 3:02d}{i:04d}", "n", i) for i in range(3 * k, 3 * k + 12)])
        rows = [(f"HOSP-{i % 3:02d}{i:04d}", f"20{20 + (i + k) % 5}-0{1 + d}-01", "UCI" if (i + d + k) % 3 else "Urgencias") for i in range(3 * k, 3 * k + 15) for d in range((i + k) % 4)]
        stays = admissions(spark, *rows).withColumns({"diagnosis_code": F.when(F.col("department") == "UCI", "U07.1")})
        return people, enrich_admissions(stays)

    def same():
        now = store.admissions()
        counted = {"department": metrics.admissions_by_department(now), "month": metrics.admissions_by_month(now), "category": metrics.admissions_by_diagnosis_category(now)}
        for kind, expected in counted.items():
            assert sorted(map(tuple, store.summary(kind).collect())) == sorted(map(tuple, expected.collect())), kind

    same()
    for k in range(5):
        store.load_batch(*batch(k))
        same()
    store.upsert_patients(patients(spark, ("HOSP-000000", "other", 1)))
    store.load_batch(*batch(0))
    store.compact()
    same()


def test_a_lookup_opens_the_files_that_may_hold_the_id(spark, store, monkeypatch):
    from wardlake.operators import ordinals

    monkeypatch.setattr(ordinals, "MAX_FILE_ROWS", 20)
    people = patients(spark, *[(f"HOSP-{i:06d}", "n", i) for i in range(40)])
    rows = [(f"HOSP-{i:06d}", f"2025-01-{d + 1:02d}", "UCI") for i in range(40) for d in range(25 if i == 7 else 5)]
    store.load_batch(people, admissions(spark, *rows))
    for i, most in ((0, 1), (7, 4), (13, 2), (39, 2), (77, 1)):
        found = store.admissions([f"HOSP-{i:06d}"])
        assert [r["patient_external_id"] for r in found.collect()] == [r[0] for r in rows if r[0] == f"HOSP-{i:06d}"]
        assert len([f for f in found.inputFiles() if "/admissions/" in f]) <= most
    assert len(store.all_ordinals("admissions")[0].files) > 8
    both = store.admissions(["HOSP-000002", "HOSP-000039"]).count()
    assert both == 10
