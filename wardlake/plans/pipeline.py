"""The runs: one pair of CSV inputs into the store, images into the store, first load."""

import logging
from collections.abc import Callable
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake import fs
from wardlake import schemas as S
from wardlake.operators.clean import clean_admissions, clean_patients, enrich_admissions, enrich_patients
from wardlake.operators.images import accepted_images, attach_report, changed_files, image_records, keyed_names, sync_report
from wardlake.operators.links import bounded_ids
from wardlake.operators.validate import Rule, Validated, admission_rules, pack_rejected, patient_rules, tag
from wardlake.plans.store import ClinicalStore, utc_now
from wardlake.sources.csv import read_admissions, read_patients
from wardlake.sources.images import read_images, read_these

log = logging.getLogger(__name__)

IMAGE_TYPE = "image/png"


class RunResult(NamedTuple):
    run_id: str
    status: str
    records_processed: int
    records_rejected: int


def _land(spark: SparkSession, tagged: DataFrame, path: str) -> Validated:
    """Write the tagged rows once, accepted and rejected apart, and read them back.

    Both halves are used several times. Files outlive executors, a cached frame does not, and
    the text is parsed only once.
    """
    accepted = F.col(S.REASON).isNull()
    # both output files of a task open at once: no sort of the rows by where they go
    with fs.settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):
        tagged.withColumn("accepted", accepted).write.mode("overwrite").partitionBy("accepted").parquet(path)
    landed = spark.read.schema(f"{tagged.schema.toDDL()}, accepted boolean").parquet(path)
    return Validated(
        valid=landed.filter("accepted").drop("accepted", S.REASON),
        rejected=landed.filter("not accepted").drop("accepted"),
    )


def process_patients(valid: DataFrame, reference: date | None = None) -> DataFrame:
    return enrich_patients(clean_patients(valid), reference)


def process_admissions(valid: DataFrame) -> DataFrame:
    return enrich_admissions(clean_admissions(valid))


def run_from_files(
    store: ClinicalStore,
    patients_csv: str,
    admissions_csv: str,
    trigger_type: str = "manual",
    run_id: str | None = None,
    reference: date | None = None,
) -> RunResult:
    """Read, check, clean, enrich, merge, keep the rejects, record the run.

    A run opened beforehand is continued with its ``run_id``. On an error the run is marked as
    failed and the error goes on to the caller.
    """
    spark = store.spark
    landing = None
    try:
        if run_id is None:
            run_id = store.open_run(trigger_type)
        landing = f"{store.root}/_landing/{run_id}"
        raw_patients = read_patients(spark, patients_csv)
        raw_admissions = read_admissions(spark, admissions_csv)
        patients = _land(spark, tag(raw_patients, patient_rules()), f"{landing}/patients")
        admissions = _land(spark, tag(raw_admissions, admission_rules()), f"{landing}/admissions")

        clean = process_admissions(admissions.valid)
        merged = store.load_batch(process_patients(patients.valid, reference), clean, cleaned=True)
        n_patients = merged["upserted"] + merged["modified"]
        # orphans count as processed, also when no patient came in and nothing was written
        n_admissions = store.loaded_rows("admissions") if n_patients else clean.count()

        packed = pack_rejected(patients.rejected, S.PATIENTS_FILE).unionByName(
            pack_rejected(admissions.rejected, S.ADMISSIONS_FILE)
        )
        n_rejected = store.write_rejected(packed, run_id)

        stats = {"records_processed": n_patients + n_admissions, "records_rejected": n_rejected, "images_processed": 0}
        store.close_run(run_id, "success", stats)
        return RunResult(run_id, "success", n_patients + n_admissions, n_rejected)
    except Exception as exc:
        log.exception("run %s failed", run_id)
        if run_id is not None:
            try:
                store.close_run(run_id, "failed", error_message=f"{type(exc).__name__}: {exc}")
            except Exception:
                log.exception("could not mark run %s as failed", run_id)
        raise
    finally:
        if landing is not None:
            fs.remove(spark, landing)


#: Pairs that share one merge. More are merged in turns; it bounds the plan, not the rows.
PAIRS_AT_ONCE = 16


def run_batches(
    store: ClinicalStore, pairs: list[tuple[str, str]], trigger_types: list[str], reference: date | None = None
) -> list[RunResult]:
    """Run several pairs of CSV inputs; the tables end as if they had been run one after another.

    They share one scan per entity and one merge, and each has a run, counts and rejects of its
    own. When that fails, every pair is run alone under the run it has, and the results tell which
    ones failed. A patient whom several pairs bring for the first time counts as inserted once.
    """
    results = []
    for at in range(0, len(pairs), PAIRS_AT_ONCE):
        some = pairs[at : at + PAIRS_AT_ONCE]
        run_ids = store.open_runs(trigger_types[at : at + PAIRS_AT_ONCE])
        try:
            results += _run_together(store, some, run_ids, reference)
        except Exception:
            log.exception("%d pairs could not be merged together and are run alone", len(some))
            results += [_run_alone(store, pair, run_id, reference) for pair, run_id in zip(some, run_ids)]
    return results


def _run_alone(store: ClinicalStore, pair: tuple[str, str], run_id: str, reference: date | None) -> RunResult:
    store.forget_rejected(run_id)
    try:
        return run_from_files(store, *pair, run_id=run_id, reference=reference)
    except Exception:
        return RunResult(run_id, "failed", 0, 0)


def _run_together(
    store: ClinicalStore, pairs: list[tuple[str, str]], run_ids: list[str], reference: date | None
) -> list[RunResult]:
    spark = store.spark
    landing = f"{store.root}/_landing/{run_ids[0]}"

    def land(read: Callable, which: int, rules: list[Rule], name: str) -> Validated:
        of_pairs = [read(spark, pair[which]).withColumn("pair", F.lit(k)) for k, pair in enumerate(pairs)]
        return _land(spark, tag(reduce(DataFrame.unionByName, of_pairs), rules), f"{landing}/{name}")

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{landing}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{landing}/{name}")

    try:
        patients = land(read_patients, 0, patient_rules(), "patients")
        admissions = land(read_admissions, 1, admission_rules(), "admissions")
        people = kept(enrich_patients(clean_patients(patients.valid, "pair"), reference), "people")
        stays = kept(enrich_admissions(clean_admissions(admissions.valid, "pair")), "stays")

        # the last pair that brings a patient counts, with the admissions of that pair
        fields = [c for c in people.columns if c not in ("pair", "external_id")]
        last = people.groupBy("external_id").agg(F.max_by(F.struct("pair", *fields), "pair").alias("last")).select("external_id", "last.*")
        owners = bounded_ids(last, "pair").withColumnRenamed("pair", "of_pair")
        same = (stays["patient_external_id"] == owners["external_id"]) & (stays["pair"] == owners["of_pair"])
        store.load_batch(last.drop("pair"), stays.join(owners, same, "left_semi").drop("pair"), cleaned=True)

        run_of = F.element_at(F.array(*[F.lit(i) for i in run_ids]), F.col("pair") + 1)
        packed = pack_rejected(patients.rejected, S.PATIENTS_FILE, "pair").unionByName(
            pack_rejected(admissions.rejected, S.ADMISSIONS_FILE, "pair")
        )
        n_rejected = store.write_rejected_of_runs(packed.withColumn("pipeline_run_id", run_of).drop("pair"))
        # orphans count as processed, too
        n_processed = _tally(people.select("pair").unionByName(stays.select("pair")), "pair")
        results = [RunResult(i, "success", n_processed.get(k, 0), n_rejected.get(i, 0)) for k, i in enumerate(run_ids)]
        store.close_runs({r.run_id: {"records_processed": r.records_processed, "records_rejected": r.records_rejected} for r in results}, "success")
        return results
    finally:
        fs.remove(spark, landing)


def sync_images(store: ClinicalStore, images_dir: str, bucket: str = S.IMAGES_BUCKET) -> tuple[DataFrame, dict[str, int]]:
    """Store every acceptable image that is new or has changed; records of all of them and a tally.

    The listing (name, length, time) is compared with what the store knows of each object's file,
    and only files that differ are opened; when none does, nothing is written. Bytes go from the
    files to the store without a shuffle. The records are read back from what is stored, so none
    exists for an image that did not get there.
    """
    spark, before = store.spark, store.pinned()
    images = read_images(spark, images_dir)
    listing = keyed_names(images.drop("content"))
    stored = before.source_times(bucket)
    fresh = images if before.blob_log().isEmpty() else read_these(spark, images_dir, changed_files(listing, stored))
    if fresh is not None:
        files = accepted_images(fresh)
        store.put_objects(files.select(F.lit(bucket).alias("bucket"), "object_key", "content", F.col("modified").alias("source_time")), IMAGE_TYPE)
    there = store.blobs().filter(F.col("bucket") == bucket).join(listing.select("object_key"), "object_key", "left_semi")
    records = image_records(there, utc_now())
    counted = _tally(sync_report(records, stored.select("object_key")), "sync_state")
    return records, {"uploaded": counted.get("uploaded", 0), "already there": counted.get("already there", 0)}


def attach_images(store: ClinicalStore, records: DataFrame) -> dict[str, int]:
    """Put image records under their patients; tally of known and unknown patients."""
    counted = _tally(attach_report(records, store.patients()), "attach_state")
    added = store.attach_radiographies(records)
    return {"attached": counted.get("attached", 0), "orphans": counted.get("orphan", 0), "added": added}


def initial_load(
    store: ClinicalStore, patients_csv: str, admissions_csv: str, images_dir: str, reference: date | None = None
) -> dict[str, int]:
    """Bring a store into use; a second call changes nothing.

    All inputs must be there. The CSV run is skipped once there are patients.
    """
    for needed in (patients_csv, admissions_csv, images_dir):
        if not fs.exists(store.spark, needed):
            raise FileNotFoundError(f"missing input: {needed}")
    records, synced = sync_images(store, images_dir)
    if store.is_empty():
        run_from_files(store, patients_csv, admissions_csv, "bootstrap", reference=reference)
    return {**synced, **attach_images(store, records)}


def _tally(df: DataFrame, column: str) -> dict[str, int]:
    """Counts per value of a column that has only a few fixed values."""
    return {r[column]: r["count"] for r in df.groupBy(column).count().collect()}
