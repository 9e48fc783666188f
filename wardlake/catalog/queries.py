"""One entry per operator: a function of (spark, sf_dir) that returns a DataFrame."""

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake import fs
from wardlake.functions import patient_of
from wardlake.operators import blobs as B
from wardlake.operators import metrics as M
from wardlake.operators.clean import clean_admissions, clean_patients, enrich_admissions, enrich_patients
from wardlake.operators.images import accepted_images, attach_report, classify_images, image_records, sync_report
from wardlake.operators.links import with_patient, without_patient
from wardlake.operators.merge import merge_stats, merge_upsert, new_radiographies, replace_admissions
from wardlake.operators.nest import patient_documents, unnest_admissions, unnest_radiographies
from wardlake.operators.ordinals import write_sorted
from wardlake.operators.paging import Page, page_rows, rows_after, sorted_page
from wardlake.operators.runs import run_states
from wardlake.operators.validate import (
    Rule,
    admission_rules,
    pack_rejected,
    patient_rules,
    reject_report,
    tag,
    validate_admissions,
    validate_patients,
)
from wardlake.plans import serve
from wardlake.plans.pipeline import attach_images, initial_load, run_batches, run_from_files, sync_images
from wardlake.plans.serve import newest_runs
from wardlake.plans.store import ClinicalStore
from wardlake.schemas import ADMISSIONS_FILE, ADMISSION_ORDER, IMAGES_BUCKET, PATIENTS_FILE, REASON, SOURCE_FILE
from wardlake.sources import testdata as T
from wardlake.sources.csv import MissingColumnsError, read_admissions, read_patients, write_csv
from wardlake.sources.generate import generate_admissions, generate_images, generate_patients, padded_id
from wardlake.sources.images import export_blobs, read_images
from wardlake.streaming.arrivals import process_arrivals

Query = Callable[[SparkSession, str], DataFrame]

REFERENCE_DAY = date(2026, 4, 21)
LOADED_AT = datetime(2026, 4, 21, tzinfo=timezone.utc)
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SEED = 42


# ---- stages shared by several queries ----


def _clean_patients(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_patients(clean_patients(validate_patients(T.patients_raw(spark, sf)).valid), REFERENCE_DAY)


def _clean_admissions(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_admissions(clean_admissions(validate_admissions(T.admissions_raw(spark, sf)).valid))


def _visible_admissions(spark: SparkSession, sf: str) -> DataFrame:
    return with_patient(_clean_admissions(spark, sf), _patient_ids(spark, sf))


def _patient_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of the clean patients: those of the valid rows. Deduplicated where they are used."""
    return validate_patients(T.patients_raw(spark, sf)).valid.select("external_id")


def _images(spark: SparkSession, sf: str) -> DataFrame:
    return image_records(accepted_images(T.image_files(spark, sf)), LOADED_AT)


def _visible_images(spark: SparkSession, sf: str) -> DataFrame:
    return with_patient(_images(spark, sf), _patient_ids(spark, sf))


def _documents(spark: SparkSession, sf: str, **options: int) -> DataFrame:
    return patient_documents(_clean_patients(spark, sf), _clean_admissions(spark, sf), _images(spark, sf), **options)


def _admission_text(array: str) -> Column:
    def line(a: Column) -> Column:
        code = F.coalesce(a["diagnosis_code"], F.lit("-"))
        return F.concat_ws(":", a["admission_date"], a["department"], code, a["status"], a["diagnosis_category"])

    return F.array_join(F.transform(array, line), ";")


def _flat_documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        "external_id",
        "part",
        "n_parts",
        "name",
        "age",
        F.size("admissions").cast("long").alias("n_admissions"),
        _admission_text("admissions").alias("admissions"),
        F.size("radiographies").cast("long").alias("n_radiographies"),
        F.array_join(F.transform("radiographies", lambda r: r["minio_object_key"]), ";").alias("radiographies"),
    )


# ---- queries ----


def patient_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Per patient: age, admissions, and how many of them are COVID-19 and pneumonia.

    Counts per patient combine before their shuffle; the arrays are never built.
    """
    category = F.col("diagnosis_category")
    per_patient = (
        _clean_admissions(spark, sf)
        .groupBy(F.col("patient_external_id").alias("external_id"))
        .agg(
            F.count(F.lit(1)).alias("n_admissions"),
            F.count_if(category == "COVID-19").alias("n_covid"),
            F.count_if(category == "Pneumonia").alias("n_pneumonia"),
        )
    )
    joined = _clean_patients(spark, sf).join(per_patient, "external_id", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ["n_admissions", "n_covid", "n_pneumonia"]]
    return joined.select("external_id", "name", "age", *counts)


def read_contract_patients(spark: SparkSession, sf: str) -> DataFrame:
    path = fs.work_dir(spark, "read-patients")
    write_csv(T.patients_raw(spark, sf), path)
    return _source_shown(read_patients(spark, path))


def read_contract_admissions(spark: SparkSession, sf: str) -> DataFrame:
    path = fs.work_dir(spark, "read-admissions")
    # shuffled columns and an extra one: the header decides
    rows = T.admissions_raw(spark, sf)
    write_csv(rows.select(*reversed(rows.columns), F.lit("x").alias("extra")), path)
    return _source_shown(read_admissions(spark, path))


def _source_shown(df: DataFrame) -> DataFrame:
    return df.withColumn("has_source", F.col(SOURCE_FILE).rlike(r"^part-.*\.csv$")).drop(SOURCE_FILE)


def contract_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Which error each breach of the input contract is: a path, a column that lacks, bounds of a page."""
    root = fs.work_dir(spark, "errors")
    rows = T.patients_raw(spark, sf)
    for column in rows.columns:
        write_csv(rows.drop(column), f"{root}/{column}")
    write_csv(rows, f"{root}/whole")
    whole = read_patients(spark, f"{root}/whole")
    cases = {
        "nothing there": lambda: read_patients(spark, f"{root}/none"),
        **{f"without {c}": lambda c=c: read_patients(spark, f"{root}/{c}") for c in rows.columns},
        **{f"limit {limit}": lambda limit=limit: page_rows(whole, ["external_id"], limit) for limit in (0, 1, 500, 501)},
        "offset -1": lambda: page_rows(whole, ["external_id"], 1, -1),
    }

    def outcome(attempt: Callable[[], DataFrame]) -> str:
        try:
            attempt()
        except (ValueError, OSError) as error:
            return type(error).__name__
        return "none"

    lines = [F.struct(F.lit(case).alias("breach"), F.lit(outcome(attempt)).alias("error")) for case, attempt in cases.items()]
    return whole.limit(1).select(F.inline(F.array(*lines)))


def _rule(dirty: Query, rules: Callable[[], list[Rule]], reason: str) -> Query:
    """Rows of the dirty table that break one rule, whatever other rules they break."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        broken = next(r.broken for r in rules() if r.reason == reason)
        return dirty(spark, sf).filter(broken)

    return query


def validate_patients_query(spark: SparkSession, sf: str) -> DataFrame:
    return tag(T.patients_raw(spark, sf), patient_rules())


def validate_admissions_query(spark: SparkSession, sf: str) -> DataFrame:
    return tag(T.admissions_raw(spark, sf), admission_rules())


def validate_patients_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return tag(T.patients_dirty(spark, sf), patient_rules())


def validate_admissions_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return tag(T.admissions_dirty(spark, sf), admission_rules())


def reject_report_query(spark: SparkSession, sf: str) -> DataFrame:
    return reject_report(
        patients=validate_patients_query(spark, sf),
        admissions=validate_admissions_query(spark, sf),
    )


def rejected_records(spark: SparkSession, sf: str) -> DataFrame:
    packed = pack_rejected(validate_patients(T.patients_dirty(spark, sf)).rejected, PATIENTS_FILE).unionByName(
        pack_rejected(validate_admissions(T.admissions_dirty(spark, sf)).rejected, ADMISSIONS_FILE)
    )
    pairs = F.array_sort(F.map_entries("raw_data"))
    text = F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("NULL")))), "|")
    return packed.select("source_file", REASON, text.alias("raw_data"))


def clean_patients_query(spark: SparkSession, sf: str) -> DataFrame:
    return clean_patients(validate_patients(T.patients_raw(spark, sf)).valid)


def clean_admissions_query(spark: SparkSession, sf: str) -> DataFrame:
    return clean_admissions(validate_admissions(T.admissions_raw(spark, sf)).valid)


def admissions_by_department(spark: SparkSession, sf: str) -> DataFrame:
    return M.admissions_by_department(clean_admissions_query(spark, sf))


def admissions_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return M.admissions_by_month(clean_admissions_query(spark, sf))


def admissions_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return M.admissions_by_diagnosis_category(clean_admissions_query(spark, sf))


def patient_documents_query(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_documents(_documents(spark, sf))


def patient_document_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Small parts, so that most patients need several."""
    return _flat_documents(_documents(spark, sf, part_size=4))


def admissions_flat(spark: SparkSession, sf: str) -> DataFrame:
    docs = patient_documents(_clean_patients(spark, sf), _clean_admissions(spark, sf))
    return unnest_admissions(docs)


def radiographies_flat(spark: SparkSession, sf: str) -> DataFrame:
    return unnest_radiographies(_documents(spark, sf)).drop("classification")


def nested_totals(spark: SparkSession, sf: str) -> DataFrame:
    """What the arrays of all documents hold: the children of known patients, counted where they lie."""
    return M.table_totals(
        patients=_patient_ids(spark, sf).distinct(),
        admissions=_visible_admissions(spark, sf),
        radiographies=_visible_images(spark, sf),
    )


def orphan_admissions(spark: SparkSession, sf: str) -> DataFrame:
    return without_patient(_clean_admissions(spark, sf), _patient_ids(spark, sf))


def orphan_images(spark: SparkSession, sf: str) -> DataFrame:
    return without_patient(_images(spark, sf), _patient_ids(spark, sf)).select(
        "patient_external_id", "minio_object_key", "file_size_bytes"
    )


def duplicate_patients(spark: SparkSession, sf: str) -> DataFrame:
    return M.duplicate_keys(T.patients_raw(spark, sf), ["external_id"])


def duplicate_admissions(spark: SparkSession, sf: str) -> DataFrame:
    return M.duplicate_keys(T.admissions_raw(spark, sf), ADMISSION_ORDER)


def patients_page(spark: SparkSession, sf: str) -> DataFrame:
    return page_rows(_clean_patients(spark, sf), ["external_id"], limit=50, offset=20)


def admissions_page(spark: SparkSession, sf: str) -> DataFrame:
    return page_rows(_visible_admissions(spark, sf), ADMISSION_ORDER, limit=50, offset=100)


def admissions_deep_page(spark: SparkSession, sf: str) -> DataFrame:
    """From a sorted table, by its directory: only the files that hold the page are opened."""
    visible = _visible_admissions(spark, sf)
    directory = write_sorted(visible, ADMISSION_ORDER, fs.work_dir(spark, "deep-page"))
    return sorted_page(visible, [directory], ADMISSION_ORDER, limit=50, offset=800).items


def admissions_after(spark: SparkSession, sf: str) -> DataFrame:
    return rows_after(_visible_admissions(spark, sf), ADMISSION_ORDER, ["HOSP-000042", "1996-12-31", "UCI"], limit=50)


def radiographies_page(spark: SparkSession, sf: str) -> DataFrame:
    images = _visible_images(spark, sf).select("patient_external_id", "minio_object_key", "file_size_bytes")
    return page_rows(images, ["minio_object_key"], limit=50, offset=10)


def served_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The three pages as the store serves them, each row with the grand total."""
    store = ClinicalStore(spark, fs.work_dir(spark, "serve"))
    store.load_batch(_clean_patients(spark, sf), _clean_admissions(spark, sf), cleaned=True)
    store.attach_radiographies(_images(spark, sf))
    patients = serve.patients_page(store, limit=50, offset=20)
    admissions = serve.admissions_page(store, limit=50, offset=800)
    radiographies = serve.radiographies_page(store, limit=10, offset=5)

    def rows(kind: str, page: Page, text: Column) -> DataFrame:
        return page.items.select(F.lit(kind).alias("kind"), F.lit(page.total).cast("long").alias("total"), text.alias("item"))

    return (
        rows("patients", patients, F.concat_ws("|", "external_id", "name", "n_admissions", "n_radiographies"))
        .unionByName(rows("admissions", admissions, F.concat_ws("|", *ADMISSION_ORDER, "diagnosis_category")))
        .unionByName(rows("radiographies", radiographies, F.concat_ws("|", "minio_object_key", "patient_external_id")))
    )


def patient_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = _clean_patients(spark, sf).filter(F.col("external_id") == "HOSP-000042")
    return _flat_documents(patient_documents(found, _clean_admissions(spark, sf), _images(spark, sf)))


def _load_time() -> Column:
    return F.lit("2026-04-21").cast("timestamp")


def _merged(spark: SparkSession, sf: str, times: int = 1) -> DataFrame:
    batch = enrich_patients(clean_patients(validate_patients(T.batch_patients(spark, sf)).valid), REFERENCE_DAY)
    merged = T.stored_patients(spark, sf)
    for _ in range(times):
        merged = merge_upsert(merged, batch, "external_id", _load_time())
    return merged


def _stamps_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.date_format(c, STAMP) for c in ["created_at", "updated_at"]})


def merge_patients(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps_as_text(_merged(spark, sf))


def merge_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps_as_text(_merged(spark, sf, times=2))


def merge_stats_query(spark: SparkSession, sf: str) -> DataFrame:
    return merge_stats(_merged(spark, sf), _load_time())


def replace_admissions_query(spark: SparkSession, sf: str) -> DataFrame:
    """All admissions are stored; the batch brings those of the customers who owe nothing, as UCI."""
    stored = _visible_admissions(spark, sf)
    batch = validate_patients(T.batch_patients(spark, sf)).valid
    incoming = _clean_admissions(spark, sf).filter("status = 'admitted'")
    return replace_admissions(stored, batch, incoming)


def stored_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The three summary counts as the store keeps them, after a batch has replaced admissions."""
    store = ClinicalStore(spark, fs.work_dir(spark, "counts"))
    admissions = _clean_admissions(spark, sf)
    store.load_batch(_clean_patients(spark, sf), admissions, cleaned=True)
    batch = enrich_patients(clean_patients(validate_patients(T.batch_patients(spark, sf)).valid), REFERENCE_DAY)
    store.load_batch(batch, admissions.filter("status = 'admitted'"), cleaned=True)
    kinds = [store.summary(kind).select(F.lit(kind).alias("kind"), "key", "count") for kind in ("department", "month", "category")]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def attach_radiographies(spark: SparkSession, sf: str) -> DataFrame:
    """Some images are attached already, and the batch brings every image twice."""
    images = _images(spark, sf)
    stored = with_patient(images, T.stored_patients(spark, sf))
    fresh = new_radiographies(stored, images.unionByName(images), _patient_ids(spark, sf))
    columns = ["patient_external_id", "minio_object_key", "file_size_bytes"]
    return stored.select(F.lit("stored").alias("state"), *columns).unionByName(
        fresh.select(F.lit("new").alias("state"), *columns)
    )


def image_dispositions(spark: SparkSession, sf: str) -> DataFrame:
    files = classify_images(T.image_files(spark, sf))
    return files.select("name", "length", patient_of(F.col("name")).alias("patient"), "disposition")


def image_totals(spark: SparkSession, sf: str) -> DataFrame:
    return classify_images(T.image_files(spark, sf)).groupBy("disposition").count()


def image_sync(spark: SparkSession, sf: str) -> DataFrame:
    images = _images(spark, sf)
    before = with_patient(images, T.stored_patients(spark, sf)).select(F.col("minio_object_key").alias("object_key"))
    synced = attach_report(sync_report(images, before), _patient_ids(spark, sf))
    return synced.groupBy("sync_state", "attach_state").count()


def _write_images(spark: SparkSession, sf: str, root: str) -> str:
    files = T.image_files(spark, sf).select(
        F.lit("files").alias("bucket"), F.col("name").alias("object_key"), F.concat("content", F.encode("name", "UTF-8")).alias("content")
    )
    fs.make_dirs(spark, f"{root}/files")
    export_blobs(files, root).agg(F.sum("bytes_written")).collect()
    return f"{root}/files"


def image_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Real files: written, scanned as binary files, stored, attached; everything twice."""
    root = fs.work_dir(spark, "images")
    _write_images(spark, sf, root)
    store = ClinicalStore(spark, f"{root}/store")
    store.upsert_patients(_clean_patients(spark, sf))
    for _ in range(2):
        records, _tally = sync_images(store, f"{root}/files")
        attach_images(store, records)
    stored = store.blobs().filter(F.col("bucket") == IMAGES_BUCKET).select(F.col("object_key").alias("minio_object_key"), "length")
    attached = store.radiographies().select("minio_object_key", "patient_external_id", "file_size_bytes")
    return stored.join(attached, "minio_object_key", "left")


def chosen_images(spark: SparkSession, sf: str) -> DataFrame:
    """One file named by its path, and those of a glob."""
    folder = _write_images(spark, sf, fs.work_dir(spark, "chosen"))
    one = T.image_files(spark, sf).agg(F.min("name").alias("name")).head()["name"]
    parts = [classify_images(read_images(spark, f"{folder}/{path}")).select(F.lit(how).alias("how"), "name", "disposition") for how, path in (("file", one), ("glob", "HOSP-*1.png"))]
    return parts[0].unionByName(parts[1])


def second_load(spark: SparkSession, sf: str) -> DataFrame:
    """A store brought into use twice: what each call found to upload, and what was written in all."""
    root = fs.work_dir(spark, "second-load")
    images, inputs = _write_images(spark, sf, root), _csv_inputs(spark, sf, root)
    store = ClinicalStore(spark, f"{root}/store")
    keys = lambda view: view.blobs().filter(F.col("bucket") == IMAGES_BUCKET)
    found = []
    for call in ("first call", "second call"):
        before = store.pinned()
        initial_load(store, *inputs, images, reference=REFERENCE_DAY)
        report = sync_report(image_records(keys(store), LOADED_AT), keys(before).select("object_key"))
        found.append(report.groupBy(F.concat_ws(": ", F.lit(call), "sync_state").alias("item")).agg(F.count(F.lit(1)).alias("total")))
    written = M.table_totals(written=store.blob_log(), attached=store.radiographies(), patients=store.patients(), runs=store.runs())
    return found[0].unionByName(found[1]).unionByName(written)


def exported_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of many buckets written to files and read back; equal keys stay apart."""
    root = f"{fs.work_dir(spark, 'export')}/out"
    pages = T.page_blobs(spark, sf)
    twins = pages.unionByName(pages.withColumn("bucket", F.concat(F.lit("copy-"), "bucket")))
    export_blobs(twins, root).agg(F.sum("bytes_written")).collect()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.split(F.substring_index("path", "/out/", -1), "/", 2)
    return files.select(below[0].alias("bucket"), below[1].alias("object_key"), "length")


def rejects_of_run(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects of one of two stored runs, found by its id."""
    store = ClinicalStore(spark, fs.work_dir(spark, "rejects"))
    store.write_rejected(pack_rejected(tag(T.patients_raw(spark, sf), patient_rules()).filter(F.col(REASON).isNotNull()), PATIENTS_FILE), "one")
    store.write_rejected(pack_rejected(tag(T.admissions_raw(spark, sf), admission_rules()).filter(F.col(REASON).isNotNull()), ADMISSIONS_FILE), "two")
    return store.rejected("two").groupBy("source_file", "rejection_reason").count()


def store_states(spark: SparkSession, sf: str) -> DataFrame:
    """Whether any patient is stored, before and after a load; and which objects exist."""
    store = ClinicalStore(spark, fs.work_dir(spark, "states"))
    before = store.pinned()
    store.upsert_patients(_clean_patients(spark, sf))
    state = lambda item, holds: F.struct(F.lit(item).alias("item"), holds.alias("holds"))
    empty = [s.emptiness().select(F.lit(item).alias("item"), F.col("is_empty").alias("holds")) for item, s in (("empty before", before), ("empty after", store))]
    once = B.put_entries(T.page_blobs(spark, sf), "text/html").withColumn("load", F.lit(1).cast("long"))
    wanted = once.agg(F.min(F.struct(*B.BLOB_KEY)).alias("o")).select(
        F.inline(F.array(state("object", F.col("o")), state("no such object", F.col("o").withField("object_key", F.lit("no such key")))))
    )
    there = B.objects_exist(B.blob_index(once), wanted.select("item", "holds.*")).select("item", F.col("present").alias("holds"))
    return empty[0].unionByName(empty[1]).unionByName(there)


def _blob_log(spark: SparkSession, sf: str) -> DataFrame:
    """Pages put once, the French ones put again with other content, the German ones removed."""
    pages = T.page_blobs(spark, sf)
    again = pages.filter("object_key like 'fr/%'").withColumn("content", F.encode(F.lit("bonjour"), "UTF-8"))
    gone = pages.filter("object_key like 'de/%'")
    loads = [B.put_entries(pages, "text/html"), B.put_entries(again), B.remove_entries(gone)]
    numbered = [entries.withColumn("load", F.lit(i + 1).cast("long")) for i, entries in enumerate(loads)]
    return numbered[0].unionByName(numbered[1]).unionByName(numbered[2])


def blob_index(spark: SparkSession, sf: str) -> DataFrame:
    return B.blob_index(_blob_log(spark, sf))


def blob_list(spark: SparkSession, sf: str) -> DataFrame:
    """Every listing at once: objects per bucket and first folder."""
    index = B.blob_index(_blob_log(spark, sf))
    return index.groupBy("bucket", F.split_part("object_key", F.lit("/"), F.lit(1)).alias("folder")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")
    )


def blob_prefix(spark: SparkSession, sf: str) -> DataFrame:
    pages = T.page_blobs(spark, sf).withColumn("bucket", F.lit("pages"))
    log = B.put_entries(pages, "text/html").withColumn("load", F.lit(1).cast("long"))
    return B.list_objects(B.blob_index(log), "pages", "fr/")


def blob_contents(spark: SparkSession, sf: str) -> DataFrame:
    """The same log, stored: bytes of the current objects, read where they lie."""
    store = ClinicalStore(spark, fs.work_dir(spark, "contents"))
    pages = T.page_blobs(spark, sf)
    store.put_objects(pages, "text/html")
    store.put_objects(pages.filter("object_key like 'fr/%'").withColumn("content", F.encode(F.lit("bonjour"), "UTF-8")))
    store.remove_objects(pages.filter("object_key like 'de/%'"))
    return store.blob_contents().select("bucket", "object_key", F.md5("content").alias("digest"))


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    return run_states(T.run_events(spark, sf))


def _run_stamps(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.date_format(c, STAMP) for c in ["started_at", "finished_at"]})


def run_states_query(spark: SparkSession, sf: str) -> DataFrame:
    return _run_stamps(_runs(spark, sf))


def failed_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _runs(spark, sf).filter("status = 'failed'").select("run_id", "error_message")


def run_history(spark: SparkSession, sf: str) -> DataFrame:
    return _run_stamps(newest_runs(_runs(spark, sf), limit=50, offset=25))


def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    return _run_stamps(newest_runs(_runs(spark, sf), limit=1))


def run_totals(spark: SparkSession, sf: str) -> DataFrame:
    return M.table_totals(
        patients_processed=clean_patients_query(spark, sf),
        admissions_processed=clean_admissions_query(spark, sf),
        patients_rejected=validate_patients(T.patients_raw(spark, sf)).rejected,
        admissions_rejected=validate_admissions(T.admissions_raw(spark, sf)).rejected,
    )


def generated_patients(spark: SparkSession, sf: str) -> DataFrame:
    keys = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    return generate_patients(keys, edge_ratio=0.2, seed=SEED)


def generated_admissions(spark: SparkSession, sf: str) -> DataFrame:
    keys = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    patients = T.table(spark, sf, "customer").select(padded_id(F.col("c_custkey")).alias("external_id"))
    return generate_admissions(keys, patients, edge_ratio=0.2, seed=SEED)


def generated_images(spark: SparkSession, sf: str) -> DataFrame:
    keys = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    return generate_images(keys, seed=SEED).select("name", F.substring(F.hex("content"), 1, 16).alias("signature"))


def _csv_inputs(spark: SparkSession, sf: str, root: str) -> tuple[str, str]:
    patients, admissions = f"{root}/in/{PATIENTS_FILE}", f"{root}/in/{ADMISSIONS_FILE}"
    write_csv(T.patients_raw(spark, sf), patients)
    write_csv(T.admissions_raw(spark, sf), admissions)
    return patients, admissions


def etl_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run from CSV files into a store, and the documents it left there."""
    root = fs.work_dir(spark, "etl")
    store = ClinicalStore(spark, f"{root}/store")
    run_from_files(store, *_csv_inputs(spark, sf, root), reference=REFERENCE_DAY)
    return _flat_documents(store.documents())


def etl_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The same input twice: the tables stay as they were, each run keeps its own rejects."""
    root = fs.work_dir(spark, "etl-rerun")
    store = ClinicalStore(spark, f"{root}/store")
    inputs = _csv_inputs(spark, sf, root)
    for _ in range(2):
        run_from_files(store, *inputs, reference=REFERENCE_DAY)
    runs = store.runs()
    return M.table_totals(
        patients=store.patients(),
        admissions=store.admissions(),
        rejected=store.rejected(),
        successful_runs=runs.filter("status = 'success'"),
    ).unionByName(runs.select(F.lit("processed in a run").alias("item"), F.col("records_processed").alias("total")))


def run_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """A run opened beforehand, one whose input breaks the contract, and one after it."""
    root = fs.work_dir(spark, "outcomes")
    store = ClinicalStore(spark, f"{root}/store")
    patients, admissions = _csv_inputs(spark, sf, root)
    write_csv(T.admissions_raw(spark, sf).drop("status"), f"{root}/broken")
    run_from_files(store, patients, admissions, run_id=store.open_run("opened before"), reference=REFERENCE_DAY)
    try:
        run_from_files(store, patients, f"{root}/broken", "broken", reference=REFERENCE_DAY)
    except MissingColumnsError:
        pass  # it has reached the caller, and the run is closed as failed
    run_from_files(store, patients, admissions, "after", reference=REFERENCE_DAY)
    error = F.split_part("error_message", F.lit(":"), F.lit(1)).alias("error")
    return store.runs().select("trigger_type", "status", "records_processed", "records_rejected", error)


def _incoming(spark: SparkSession, sf: str, root: str) -> str:
    """A batch directory per market segment, with both files."""
    for rows, name in [(T.patients_by_segment, PATIENTS_FILE), (T.admissions_by_segment, ADMISSIONS_FILE)]:
        write_csv(rows(spark, sf), f"{root}/out/{name}", ["c_mktsegment"])
        for folder in fs.names(spark, f"{root}/out/{name}"):
            if folder.startswith("c_mktsegment="):
                fs.move(spark, f"{root}/out/{name}/{folder}", f"{root}/incoming/{folder.split('=', 1)[1]}/{name}")
    return f"{root}/incoming"


def archived_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the files that lie in the archive after every batch was processed."""
    root = fs.work_dir(spark, "archive")
    process_arrivals(spark, _incoming(spark, sf, root), f"{root}/state", lambda p, a: None, processed=f"{root}/processed")
    steps = F.split(F.substring_index("_metadata.file_path", "/processed/", -1), "/")
    files = [read.select(steps[0].alias("batch"), steps[1].alias("file")) for read in (spark.read.option("header", True).csv(f"{root}/processed/*/{name}") for name in (PATIENTS_FILE, ADMISSIONS_FILE))]
    return files[0].unionByName(files[1]).groupBy("batch", "file").count()


def incremental_batches(spark: SparkSession, sf: str) -> DataFrame:
    """One batch directory per market segment, picked up by the stream and run on arrival."""
    root = fs.work_dir(spark, "batches")
    incoming = _incoming(spark, sf, root)
    store = ClinicalStore(spark, f"{root}/store")
    name = lambda path: path.split("/")[-2]

    def together(pairs: list[tuple[str, str]]) -> list[bool]:
        return [r.status == "success" for r in run_batches(store, pairs, [name(p) for p, _ in pairs], REFERENCE_DAY)]

    process_arrivals(
        spark,
        incoming,
        f"{root}/state",
        lambda p, a: run_from_files(store, p, a, trigger_type=name(p), reference=REFERENCE_DAY),
        processed=f"{root}/processed",
        on_all=together,
    )
    return store.runs().select(
        F.col("trigger_type").alias("batch"), "status", "records_processed", "records_rejected"
    )


QUERIES: dict[str, Query] = {
    "patient_summary": patient_summary,
    "read_contract_patients": read_contract_patients,
    "read_contract_admissions": read_contract_admissions,
    "rule_invalid_external_id": _rule(T.patients_dirty, patient_rules, "invalid external_id"),
    "rule_missing_name": _rule(T.patients_dirty, patient_rules, "missing name"),
    "rule_invalid_birth_date": _rule(T.patients_dirty, patient_rules, "invalid birth_date"),
    "rule_invalid_gender": _rule(T.patients_dirty, patient_rules, "invalid gender"),
    "rule_invalid_blood_type": _rule(T.patients_dirty, patient_rules, "invalid blood_type"),
    "rule_invalid_patient_external_id": _rule(T.admissions_dirty, admission_rules, "invalid patient_external_id"),
    "rule_invalid_admission_date": _rule(T.admissions_dirty, admission_rules, "invalid admission_date"),
    "rule_missing_department": _rule(T.admissions_dirty, admission_rules, "missing department"),
    "rule_invalid_status": _rule(T.admissions_dirty, admission_rules, "invalid status"),
    "validate_patients": validate_patients_query,
    "validate_admissions": validate_admissions_query,
    "validate_patients_dirty": validate_patients_dirty,
    "validate_admissions_dirty": validate_admissions_dirty,
    "reject_report": reject_report_query,
    "rejected_records": rejected_records,
    "clean_patients": clean_patients_query,
    "clean_admissions": clean_admissions_query,
    "patients_with_age": _clean_patients,
    "admissions_with_category": _clean_admissions,
    "admissions_by_department": admissions_by_department,
    "admissions_by_month": admissions_by_month,
    "admissions_by_category": admissions_by_category,
    "patient_documents": patient_documents_query,
    "patient_document_parts": patient_document_parts,
    "admissions_flat": admissions_flat,
    "radiographies_flat": radiographies_flat,
    "nested_totals": nested_totals,
    "orphan_admissions": orphan_admissions,
    "orphan_images": orphan_images,
    "duplicate_patients": duplicate_patients,
    "duplicate_admissions": duplicate_admissions,
    "patients_page": patients_page,
    "admissions_page": admissions_page,
    "admissions_deep_page": admissions_deep_page,
    "admissions_after": admissions_after,
    "radiographies_page": radiographies_page,
    "served_pages": served_pages,
    "patient_lookup": patient_lookup,
    "merge_patients": merge_patients,
    "merge_stats": merge_stats_query,
    "merge_idempotent": merge_idempotent,
    "replace_admissions": replace_admissions_query,
    "stored_counts": stored_counts,
    "attach_radiographies": attach_radiographies,
    "image_dispositions": image_dispositions,
    "image_totals": image_totals,
    "image_sync": image_sync,
    "image_ingest": image_ingest,
    "chosen_images": chosen_images,
    "second_load": second_load,
    "exported_objects": exported_objects,
    "rejects_of_run": rejects_of_run,
    "store_states": store_states,
    "blob_index": blob_index,
    "blob_list": blob_list,
    "blob_prefix": blob_prefix,
    "blob_contents": blob_contents,
    "run_states": run_states_query,
    "failed_runs": failed_runs,
    "run_history": run_history,
    "latest_run": latest_run,
    "run_totals": run_totals,
    "generated_patients": generated_patients,
    "generated_admissions": generated_admissions,
    "generated_images": generated_images,
    "etl_run": etl_run,
    "etl_rerun": etl_rerun,
    "incremental_batches": incremental_batches,
    "archived_batches": archived_batches,
    "run_outcomes": run_outcomes,
    "contract_errors": contract_errors,
}
