"""The stored tables, in one folder that all executors reach.

Patients (few, see operators/links.py) lie in one small directory per id prefix. A merge rewrites
those its batch touches, as new directories, and its commit names the current one of each prefix.
Admissions, image metadata and objects, which hold the bulk, are only ever appended, one
directory per load. A patient row names the load its admissions come from, so replacing a
patient's admissions costs no rewrite, and admissions of unknown patients are in no document.
Sorted loads keep a directory of their files (operators/ordinals.py), from which pages are read.

A load becomes visible when its commit file appears, written last and only if no other has that
version. Every attempt writes folders of its own, so a writer that comes second fails on the
commit file and leaves the winner's rows alone. A job that died before its commit leaves folders
no commit names.
"""

import json
import secrets
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake import fs
from wardlake import schemas as S
from wardlake.operators import blobs as B
from wardlake.operators import metrics as M
from wardlake.operators.clean import deduplicate
from wardlake.operators import ordinals as O
from wardlake.operators.links import bounded_ids, with_patient
from wardlake.operators.merge import merge_counts, merge_upsert, new_radiographies
from wardlake.operators.nest import patient_documents
from wardlake.operators.runs import run_states

LOAD = T.StructField("load", T.LongType())
PREFIX = T.StructField("prefix", T.StringType())
#: Row positions that one scan of objects is told to skip or to take; bounds what is broadcast.
PLACES_AT_ONCE = 1_000_000
#: The sums a commit keeps per prefix.
SUMS = ["n", "n_admissions", "n_radiographies"]
# objects may be large: let the writer look at its buffer often enough
BLOB_OPTIONS = {
    "parquet.page.size.row.check.min": 1,
    "parquet.block.size.row.check.min": 1,
    "parquet.enable.dictionary": False,
}


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _of_patients(df: DataFrame, ids: list[str] | None, column: str = "patient_external_id") -> DataFrame:
    return df if ids is None else df.filter(F.col(column).isin(ids))


def _together(counts: dict[tuple[int, str], int]) -> list[list[tuple[int, str]]]:
    """Files in groups of at most ``PLACES_AT_ONCE`` positions, or of one file with more."""
    groups: list[list[tuple[int, str]]] = []
    room = 0
    for file, n in sorted(counts.items()):
        if n > room or not groups:
            groups.append([])
            room = PLACES_AT_ONCE
        groups[-1].append(file)
        room -= n
    return groups


def id_prefix(external_id: Column) -> Column:
    """"HOSP-" and six digits: the first two. Ten thousand ids each, null for what is no id."""
    return F.when(external_id.rlike(S.PATIENT_ID), F.substring(external_id, 6, 2))


def nest_stored(patients: DataFrame, admissions: DataFrame, radiographies: DataFrame) -> DataFrame:
    """Documents of stored patients, who know how many children they have."""
    sizes = patients.select(
        "external_id", F.col("n_admissions").alias("admissions"), F.col("n_radiographies").alias("radiographies")
    )
    return patient_documents(patients.drop(*S.STORE_COLUMNS), admissions, radiographies, sizes=sizes)


class ClinicalStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = str(root).rstrip("/")
        self._pinned: dict | None = None

    def pinned(self) -> "ClinicalStore":
        """The store as of its latest commit, for several reads that have to fit together."""
        view = ClinicalStore(self.spark, self.root)
        view._pinned = self._state()
        return view

    # ---- commits ----

    def _state(self) -> dict:
        if self._pinned is not None:
            return self._pinned
        commits = [n for n in fs.names(self.spark, f"{self.root}/_commits") if n.endswith(".json")]
        if not commits:
            return {"version": 0, "patients": {}, "admissions": [], "radiographies": [], "blobs": [], "summaries": []}
        return json.loads(fs.read_text(self.spark, f"{self.root}/_commits/{commits[-1]}"))

    def _commit(self, state: dict) -> None:
        fs.create_text(self.spark, f"{self.root}/_commits/{state['version']:010d}.json", json.dumps(state))

    def _next(self) -> dict:
        if self._pinned is not None:
            raise ValueError("a pinned store is for reading")
        state = self._state()
        return {**state, "version": state["version"] + 1}

    @staticmethod
    def _attempt(state: dict) -> int:
        """Number of a load: rises with the version and is never another writer's."""
        return state["version"] << 32 | secrets.randbits(32)

    def _dir(self, table: str, load: int) -> str:
        return f"{self.root}/{table}/load={load}"

    def _empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def _loads(self, table: str, loads: list[int], schema: T.StructType) -> DataFrame:
        full = T.StructType([*schema.fields, LOAD])
        if not loads:
            return self._empty(full)
        reader = self.spark.read.schema(full).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*[self._dir(table, n) for n in loads])

    # ---- reads ----

    def patients(self, ids: list[str] | None = None) -> DataFrame:
        """All patients, or those of the given ids, whose prefixes alone are opened then."""
        state = self._state()
        if ids is None:
            return self._patients(state)
        return self._patients(state, {i[5:7] for i in ids}).filter(F.col("external_id").isin(ids))

    def _patients(self, state: dict, prefixes: set[str] | None = None) -> DataFrame:
        kept = [(p, of["load"]) for p, of in state["patients"].items() if prefixes is None or p in prefixes]
        full = T.StructType([*self._patient_schema(state).fields, LOAD, PREFIX])
        if not kept:
            return self._empty(full).drop("load", "prefix")
        reader = self.spark.read.schema(full).option("basePath", f"{self.root}/patients")
        return reader.parquet(*[f"{self._dir('patients', load)}/prefix={p}" for p, load in kept]).drop("load", "prefix")

    def patients_of(self, prefixes: set[str]) -> DataFrame:
        """The patients of some id prefixes."""
        return self._patients(self._state(), prefixes)

    def sums(self) -> dict[str, dict[str, int]]:
        """Patients, admissions and radiographies per id prefix in ascending order, from the commit."""
        return {p: {c: of[c] for c in SUMS} for p, of in sorted(self._state()["patients"].items())}

    def total(self, column: str) -> int:
        return sum(of[column] for of in self.sums().values())

    @staticmethod
    def _patient_schema(state: dict) -> T.StructType:
        """The fixed fields and those that batches have brought so far."""
        more = [T.StructField(name, T.StructType.fromDDL(f"v {kind}")["v"].dataType) for name, kind in state.get("patient_fields", {}).items()]
        return T.StructType([*S.PATIENTS.fields, *more])

    def admissions(self, ids: list[str] | None = None) -> DataFrame:
        """Admissions of stored patients, each patient's from its own latest load.

        Of given ids only the files that may hold them are opened, and the ids reach their scan.
        """
        state = self._state()
        if ids is None:
            rows = self._loads("admissions", state["admissions"], S.ADMISSIONS)
        else:
            rows = self._admissions_between(state, [(i, i) for i in ids]).filter(F.col("patient_external_id").isin(ids))
        return self._of_owners(rows, self.patients(ids))

    @staticmethod
    def _of_owners(rows: DataFrame, patients: DataFrame) -> DataFrame:
        """Rows of the load that their patient names."""
        owners = bounded_ids(patients, "admissions_load")
        same = (rows["patient_external_id"] == owners["external_id"]) & (rows["load"] == owners["admissions_load"])
        return rows.join(owners, same, "left_semi").drop("load")

    def _admissions_between(self, state: dict, ranges: list[tuple[str, str]]) -> DataFrame:
        """Rows of the files that may hold ids of some ranges, whatever else these hold."""
        paths = [p for load in state["admissions"] for o in [self.ordinals("admissions", load)] for low, high in ranges for p in o.files_between([low], [high])]
        full = T.StructType([*S.ADMISSIONS.fields, LOAD])
        if not paths:
            return self._empty(full)
        reader = self.spark.read.schema(full).option("basePath", f"{self.root}/admissions")
        return reader.parquet(*dict.fromkeys(paths))

    def summary(self, kind: str) -> DataFrame:
        """Admissions per department, month or category as (key, count), from the counts kept at each load."""
        schema = T.StructType.fromDDL("kind string, key string, n long")
        partial = self._loads("_summaries", self._state()["summaries"], schema).filter(F.col("kind") == kind)
        return M.combined_counts(partial).select("key", F.col("n").alias("count"))

    def radiographies(self, ids: list[str] | None = None) -> DataFrame:
        rows = self._loads("radiographies", self._state()["radiographies"], S.RADIOGRAPHIES)
        return _of_patients(rows, ids).drop("load")

    def documents(self) -> DataFrame:
        """Patients with nested admissions and radiographies, see operators/nest.py."""
        now = self.pinned()
        return nest_stored(now.patients(), now.admissions(), now.radiographies())

    def is_empty(self) -> bool:
        """By the commit's sums: no job."""
        return self.total("n") == 0

    def emptiness(self) -> DataFrame:
        """One row: whether no patient is stored; a scan stops at the first one."""
        return self.patients().limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))

    # ---- patients and admissions ----

    def upsert_patients(self, batch: DataFrame) -> dict[str, int]:
        """Insert or update patients; their admissions stay as they are.

        A batch may bring fields of its own, which the store keeps from then on.
        Of several rows with one id the smallest counts, as in operators/clean.py.
        """
        return self._merge(deduplicate(batch, S.PATIENT_KEY), None)

    def load_batch(self, patients: DataFrame, admissions: DataFrame, cleaned: bool = False) -> dict[str, int]:
        """Insert or update patients and replace their admissions as a whole.

        Admissions must be unique by patient, day and department. ``cleaned`` says that the
        patients are unique, too. Without patients nothing is stored, even if there are
        admissions.
        """
        return self._merge(patients if cleaned else deduplicate(patients, S.PATIENT_KEY), admissions)

    def _merge(self, batch: DataFrame, admissions: DataFrame | None) -> dict[str, int]:
        now = utc_now()
        state = self._next()
        known = {f.name: f.dataType for f in self._patient_schema(state)}
        own = {f.name: f.dataType.simpleString() for f in batch.schema if f.name not in known}
        taken = {LOAD.name, PREFIX.name, *S.STORE_COLUMNS} & set(batch.columns)
        if taken:
            raise ValueError(f"the store itself uses the columns {sorted(taken)}")
        # a field that came earlier keeps its type
        kept = {name: F.col(name).cast(known[name]) for name in state.get("patient_fields", {}) if name in batch.columns}
        batch = batch.withColumns(kept) if kept else batch
        state["patient_fields"] = {**state.get("patient_fields", {}), **own}
        load = self._attempt(state)
        # the batch is read twice, for its prefixes and for the merge
        staged_at = f"{self.root}/_landing/batch-{load}"
        batch.write.parquet(staged_at)
        try:
            staged = self.spark.read.schema(batch.schema).parquet(staged_at)
            prefixes = self._prefixes_of(staged)
            if not prefixes:
                # no patients came in: leave the store as it is
                return {"upserted": 0, "modified": 0}
            if admissions is not None:
                self._write_admissions(admissions, load)
                staged = staged.join(self._admission_sizes(load), "external_id", "left").withColumns(
                    {
                        "admissions_load": F.lit(load).cast("long"),
                        "n_admissions": F.coalesce("n_admissions", F.lit(0).cast("long")),
                    }
                )
            before = self._patients(state, prefixes)
            if admissions is not None:
                self._keep_summary(before, staged.select("external_id"), prefixes, load, state)
            merged = merge_upsert(before, staged, "external_id", now)
            stats = self._rewrite(merged, load, state, now)
            if admissions is not None:
                # loads that no patient names any more are left behind
                named = {n for of in state["patients"].values() for n in of["loads"]}
                state["admissions"] = [n for n in [*state["admissions"], load] if n in named]
        finally:
            fs.remove(self.spark, staged_at)
        self._commit(state)
        return stats

    def _keep_summary(self, before: DataFrame, batch: DataFrame, prefixes: set[str], load: int, state: dict) -> None:
        """Counts of a load's visible admissions, less those its patients had: a few lines next to the load."""
        added = with_patient(self._loads("admissions", [load], S.ADMISSIONS), batch)
        replaced = before.join(F.broadcast(batch), "external_id", "left_semi").filter("n_admissions > 0")
        ranges = [(f"HOSP-{p}0000", f"HOSP-{p}9999\uffff") for p in sorted(prefixes)]
        gone = self._of_owners(self._admissions_between(state, ranges), replaced)
        lines = M.partial_counts(added).unionByName(M.partial_counts(gone).withColumn("n", -F.col("n")))
        M.combined_counts(lines).coalesce(1).write.parquet(self._dir("_summaries", load))
        state["summaries"] = [*state["summaries"], load]

    @staticmethod
    def _prefixes_of(rows: DataFrame) -> set[str]:
        """The id prefixes that rows touch, at most a hundred; refuses what is no patient id."""
        found = rows.groupBy(id_prefix(F.col("external_id")).alias("prefix")).agg(F.min("external_id").alias("one")).collect()
        strange = [r["one"] for r in found if r["prefix"] is None]
        if strange:
            raise ValueError(f"not a patient id: {strange[0]}")
        return {r["prefix"] for r in found}

    def _rewrite(self, rows: DataFrame, load: int, state: dict, now: datetime) -> dict[str, int]:
        """Write patients, one file per prefix, and let the state name these prefixes' new directories.

        Rows have to be whole prefixes. Returns what changed at ``now``.
        """
        fields = self._patient_schema(state).fieldNames()
        rows = rows.select(*fields, id_prefix(F.col("external_id")).alias("prefix"))
        rows = rows.repartition("prefix").sortWithinPartitions("prefix", "external_id")
        rows.write.mode("overwrite").partitionBy("prefix").parquet(self._dir("patients", load))
        full = T.StructType([*self._patient_schema(state).fields, PREFIX])
        written = self.spark.read.schema(full).parquet(self._dir("patients", load))
        held = {"n": F.count(F.lit(1)), **{c: F.coalesce(F.sum(c), F.lit(0)) for c in SUMS[1:]}, "loads": F.collect_set("admissions_load")}
        counts = written.groupBy("prefix").agg(*merge_counts(now), *[c.alias(n) for n, c in held.items()]).collect()
        state["patients"] = {**state["patients"], **{r["prefix"]: {"load": load, "loads": sorted(r["loads"]), **{c: r[c] for c in SUMS}} for r in counts}}
        return {c: sum(r[c] for r in counts) for c in ("upserted", "modified")}

    def _admission_sizes(self, load: int) -> DataFrame:
        """Per patient: rows in one load, and where the first of them is."""
        rows = self._loads("admissions", [load], S.ADMISSIONS)
        own = rows.groupBy(F.col("patient_external_id").alias("external_id"))
        return own.agg(F.count(F.lit(1)).alias("n_admissions"), F.min(O.place_in_table()).alias("admissions_at"))

    def _write_sorted(self, table: str, rows: DataFrame, order: list[str], load: int) -> O.Ordinals:
        schema = {"admissions": S.ADMISSIONS, "radiographies": S.RADIOGRAPHIES}[table]
        have = set(rows.columns)
        fields = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        written = O.write_sorted(rows.select(*fields), order, self._dir(table, load))
        O.keep_ordinals(self.spark, f"{self.root}/_ordinals/{table}/{load}.json", written)
        return written

    def ordinals(self, table: str, load: int) -> O.Ordinals:
        """The directory of one sorted load."""
        return O.load_ordinals(self.spark, f"{self.root}/_ordinals/{table}/{load}.json", self._dir(table, load))

    def all_ordinals(self, table: str) -> list[O.Ordinals]:
        return [self.ordinals(table, load) for load in self._state()[table]]

    def _write_admissions(self, rows: DataFrame, load: int) -> O.Ordinals:
        # ranges over the whole key: a patient with very many admissions spans several files,
        # and a lookup by id skips the files that cannot hold it
        return self._write_sorted("admissions", rows, S.ADMISSION_ORDER, load)

    def loaded_rows(self, table: str) -> int:
        """Rows of the latest load of a sorted table, by its directory."""
        return sum(self.ordinals(table, load).total for load in self._state()[table][-1:])

    def compact(self) -> None:
        """Rewrite the visible rows of every appended table as one load."""
        state = self._next()
        load = self._attempt(state)
        self._write_admissions(self.admissions(), load)
        owner_load = F.when(F.col("admissions_load").isNotNull(), F.lit(load).cast("long"))
        placed = self._admission_sizes(load).select("external_id", "admissions_at")
        owners = self.patients().drop("admissions_at").join(placed, "external_id", "left")
        if state["patients"]:
            self._rewrite(owners.withColumn("admissions_load", owner_load), load, state, utc_now())
        self._write_sorted("radiographies", self.radiographies(), S.RADIOGRAPHY_ORDER, load)
        self.blob_contents().drop("load").write.mode("overwrite").options(**BLOB_OPTIONS).parquet(self._dir("blobs", load))
        M.partial_counts(self.admissions()).coalesce(1).write.parquet(self._dir("_summaries", load))
        state.update(admissions=[load], radiographies=[load], blobs=[load], summaries=[load])
        self._commit(state)

    # ---- radiographies ----

    def attach_radiographies(self, images: DataFrame) -> int:
        """Append image records of stored patients, once per object key; returns how many.

        Only the patient and the key are needed; other fields a record lacks stay null.

        ``updated_at`` moves only for patients who really got one.
        """
        state = self._next()
        load = self._attempt(state)
        stored = self._loads("radiographies", state["radiographies"], S.RADIOGRAPHIES)
        have = set(images.columns)
        if not set(S.RADIOGRAPHY_KEY) <= have:
            raise ValueError(f"images need {S.RADIOGRAPHY_KEY}")
        known = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in S.RADIOGRAPHIES]
        fresh = new_radiographies(stored, images.select(*known), self._patients(state))
        added = self._write_sorted("radiographies", fresh, S.RADIOGRAPHY_ORDER, load).total
        if added:
            own = self._loads("radiographies", [load], S.RADIOGRAPHIES).groupBy(F.col("patient_external_id").alias("external_id"))
            sizes = own.agg(F.count(F.lit(1)).alias("n_new"))
            prefixes = self._prefixes_of(sizes)
            patients = self._patients(state, prefixes)
            grown = F.coalesce("n_radiographies", F.lit(0).cast("long")) + F.col("n_new")
            touched = patients.join(sizes, "external_id").select("external_id", grown.alias("n_radiographies"))
            now = utc_now()
            self._rewrite(merge_upsert(patients, touched, "external_id", now, insert=False), load, state, now)
            state["radiographies"] = [*state["radiographies"], load]
            self._commit(state)
        return added

    # ---- objects ----

    def blob_log(self) -> DataFrame:
        return self._loads("blobs", self._state()["blobs"], S.BLOBS)

    def blobs(self) -> DataFrame:
        """Index of the current objects: no bytes."""
        return B.blob_index(self.blob_log())

    def source_times(self, bucket: str) -> DataFrame:
        """Keys of a bucket with the length and time of the file each object came from."""
        return B.source_times(self.blob_log()).filter(F.col("bucket") == bucket).drop("bucket")

    def blob_contents(self, index: DataFrame | None = None) -> DataFrame:
        """Objects with their bytes: those of the given index rows, or all.

        Which rows these are is found on the metadata and written down as positions. Then every
        file is scanned with the positions that lie in it: files are taken together while they
        have at most ``PLACES_AT_ONCE``, so what is broadcast is bounded and bytes stay in place.
        """
        log = self.blob_log()
        if not self._state()["blobs"]:
            return log
        entries = log.select(*B.BLOB_KEY, "load", "deleted", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
        found = B.stale_places(entries) if index is None else B.wanted_places(entries, index)
        path = fs.work_dir(self.spark, "places")
        found.write.parquet(path)
        places = self.spark.read.schema(found.schema).parquet(path)
        counts = {(r["load"], r["file"]): r["n"] for r in places.groupBy("load", "file").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = [self._at_places(places, group, index is not None) for group in _together(counts)]
        if index is None:
            whole = [(load, name) for load in self._state()["blobs"] for name in self._files("blobs", load) if (load, name) not in counts]
            parts += [self._scan_blobs(whole)] if whole else []
        return reduce(DataFrame.unionByName, parts) if parts else log.limit(0)

    def _files(self, table: str, load: int) -> list[str]:
        return [n for n in fs.names(self.spark, self._dir(table, load)) if n.startswith("part-")]

    def _scan_blobs(self, files: list[tuple[int, str]]) -> DataFrame:
        reader = self.spark.read.schema(T.StructType([*S.BLOBS.fields, LOAD])).option("basePath", f"{self.root}/blobs")
        return reader.parquet(*[f"{self._dir('blobs', load)}/{name}" for load, name in files])

    def _at_places(self, places: DataFrame, files: list[tuple[int, str]], take: bool) -> DataFrame:
        """Rows of some files that are, or are not, at the given places."""
        here = places.filter(F.col("file").isin([name for _, name in files])).select(F.col("file").alias("_file"), F.col("row").alias("_row"))
        scan = self._scan_blobs(files).select("*", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.row_index").alias("_r"))
        same = (scan["_f"] == here["_file"]) & (scan["_r"] == here["_row"])
        return scan.join(F.broadcast(here), same, "left_semi" if take else "left_anti").drop("_f", "_r")

    def load_of_blobs(self, load: int) -> DataFrame:
        """Entries of one load, as written."""
        return self._loads("blobs", [load], S.BLOBS)

    def _append_blobs(self, entries: DataFrame) -> int | None:
        state = self._next()
        load = self._attempt(state)
        entries.write.mode("overwrite").options(**BLOB_OPTIONS).parquet(self._dir("blobs", load))
        written = self.load_of_blobs(load)
        B.check_unique(written)
        if written.isEmpty():
            fs.remove(self.spark, self._dir("blobs", load))
            return None
        state["blobs"] = [*state["blobs"], load]
        self._commit(state)
        return load

    def put_objects(self, objects: DataFrame, content_type: str = S.DEFAULT_CONTENT_TYPE) -> int | None:
        """Store (bucket, object_key, content) rows; a key stored before is overwritten. Returns the load, if any."""
        return self._append_blobs(B.put_entries(objects, content_type))

    def remove_objects(self, keys: DataFrame) -> None:
        self._append_blobs(B.remove_entries(keys))

    # ---- rejects ----

    def write_rejected(self, packed: DataFrame, run_id: str) -> int:
        """Append rejects of a run, stamped; returns how many the run now has.

        Counted from the files, since a count taken on the way would include retried tasks.
        """
        # few rows from very many tasks: gather them into files of a fair size
        stamped = packed.withColumn("created_at", F.lit(utc_now())).hint("rebalance")
        stamped.write.mode("append").parquet(f"{self.root}/rejected/pipeline_run_id={run_id}")
        return self.rejected(run_id).count()

    def write_rejected_of_runs(self, packed: DataFrame) -> dict[str, int]:
        """The same for several runs at once, which ``pipeline_run_id`` names; rows per run."""
        stamped = packed.withColumn("created_at", F.lit(utc_now())).hint("rebalance")
        stamped.write.mode("append").partitionBy("pipeline_run_id").parquet(f"{self.root}/rejected")
        runs = [r["pipeline_run_id"] for r in packed.select("pipeline_run_id").distinct().collect()]
        counts = self.rejected().filter(F.col("pipeline_run_id").isin(runs)).groupBy("pipeline_run_id").count()
        return {r["pipeline_run_id"]: r["count"] for r in counts.collect()}

    def forget_rejected(self, run_id: str) -> None:
        """Take back the rejects of a run that starts over."""
        fs.remove(self.spark, f"{self.root}/rejected/pipeline_run_id={run_id}")

    def rejected(self, run_id: str | None = None) -> DataFrame:
        path = f"{self.root}/rejected"
        if not fs.names(self.spark, path):
            return self._empty(S.REJECTED)
        rows = self.spark.read.schema(S.REJECTED).parquet(path)
        return rows if run_id is None else rows.filter(F.col("pipeline_run_id") == run_id)

    # ---- run history ----

    def _events(self, *events: dict) -> None:
        rows = [F.struct(*[F.lit(e.get(f.name)).cast(f.dataType).alias(f.name) for f in S.RUN_EVENTS]) for e in events]
        one = self.spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))
        one.write.mode("append").parquet(f"{self.root}/runs")

    def open_run(self, trigger_type: str = "manual") -> str:
        return self.open_runs([trigger_type])[0]

    def open_runs(self, trigger_types: list[str]) -> list[str]:
        zeros = dict(records_processed=0, records_rejected=0, images_processed=0)
        ids = [uuid.uuid4().hex for _ in trigger_types]
        self._events(*[dict(run_id=i, event_at=utc_now(), trigger_type=t, status="running", **zeros) for i, t in zip(ids, trigger_types)])
        return ids

    def close_run(self, run_id: str, status: str, stats: dict | None = None, error_message: str | None = None) -> None:
        self.close_runs({run_id: stats or {}}, status, error_message)

    def close_runs(self, stats: dict[str, dict], status: str, error_message: str | None = None) -> None:
        zeros = dict(records_processed=0, records_rejected=0, images_processed=0)
        self._events(*[dict(run_id=i, event_at=utc_now(), status=status, error_message=error_message, **{**zeros, **of}) for i, of in stats.items()])

    def runs(self) -> DataFrame:
        if not fs.names(self.spark, f"{self.root}/runs"):
            return run_states(self._empty(S.RUN_EVENTS))
        return run_states(self.spark.read.schema(S.RUN_EVENTS).parquet(f"{self.root}/runs"))
