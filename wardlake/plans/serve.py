"""Read side: pages, lookups and totals over the store.

The patient table is small by its id space (operators/links.py) and knows how many admissions
and radiographies each patient has; a commit keeps the sums per id prefix. Totals and the prefixes
of a page come from the commit, without a job. An admissions page takes one small job over these
prefixes, which names the patients on it, and one over the files their rows are in; the other
pages take one job.
"""

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from wardlake.operators.nest import PART_SIZE
from wardlake.operators.ordinals import Stretch, rows_of
from wardlake.operators.paging import MAX_LIMIT, Page, check_bounds, page_rows, rows_after, sorted_page
from wardlake.plans.store import ClinicalStore, id_prefix, nest_stored
from wardlake.schemas import ADMISSIONS, ADMISSION_COLUMNS, ADMISSION_ORDER, PATIENT_COLUMNS, RADIOGRAPHY_ORDER

PATIENT_VIEW = [*PATIENT_COLUMNS[:3], "age", *PATIENT_COLUMNS[3:]]
ADMISSION_VIEW = [*ADMISSION_COLUMNS[:6], "diagnosis_category", "status"]


def _one_row_each(patients: DataFrame) -> DataFrame:
    """Fields of each patient, how many children it has, and in how many parts they are read."""
    sizes = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_admissions", "n_radiographies")}
    most = F.greatest(*sizes.values(), F.lit(1).cast("long"))
    parts = F.ceil(most / PART_SIZE).cast("long")
    return patients.withColumns({**sizes, "n_parts": parts}).select(*PATIENT_VIEW, *sizes, "n_parts").orderBy("external_id")


def _prefixes(store: ClinicalStore, column: str, limit: int, offset: int) -> dict[str, int]:
    """Id prefixes with rows of the page, and how many rows come before each."""
    touched, before = {}, 0
    for prefix, sums in store.sums().items():
        if before < offset + limit and before + sums[column] > offset:
            touched[prefix] = before
        before += sums[column]
    return touched


def patients_page(store: ClinicalStore, limit: int = 50, offset: int = 0) -> Page:
    """Patients by id, one row each whatever their size; children are in ``patient_parts``."""
    check_bounds(limit, offset)
    store = store.pinned()
    touched = _prefixes(store, "n", limit, offset)
    rows = page_rows(store.patients_of(set(touched)), ["external_id"], limit, offset - min(touched.values(), default=offset))
    return Page(store.total("n"), limit, offset, _one_row_each(rows))


def patients_after(store: ClinicalStore, external_id: str, limit: int = 50) -> DataFrame:
    return _one_row_each(rows_after(store.patients(), ["external_id"], [external_id], limit))


def find_patient(store: ClinicalStore, external_id: str) -> DataFrame:
    """The one row of a patient, none when there is no such patient."""
    return _one_row_each(store.patients([external_id]))


def patient_parts(store: ClinicalStore, external_ids: list[str]) -> DataFrame:
    """Documents of at most a page of patients with their nested children, by (external_id, part).

    Every patient has ``n_parts`` of them; no array holds more than about ``PART_SIZE`` children.
    """
    if len(external_ids) > MAX_LIMIT:
        raise ValueError(f"at most {MAX_LIMIT} patients at once")
    store = store.pinned()
    found = store.patients(external_ids)
    docs = nest_stored(found, store.admissions(external_ids).select(*ADMISSION_VIEW), store.radiographies(external_ids))
    return docs.select(*PATIENT_VIEW, "part", "n_parts", "admissions", "radiographies").orderBy("external_id", "part")


def total(store: ClinicalStore, size: str) -> int:
    return store.total(size)


def _stretches(store: ClinicalStore, limit: int, offset: int) -> list[Stretch]:
    """Where the admissions of a page are: the rows of at most ``limit`` patients, by their loads' directories."""
    touched = _prefixes(store, "n_admissions", limit, offset)
    if not touched:
        return []
    owners = store.patients_of(set(touched)).filter("n_admissions > 0").withColumn("prefix", id_prefix(F.col("external_id")))
    base = F.element_at(F.create_map(*[F.lit(x) for kv in touched.items() for x in kv]), F.col("prefix"))
    # at most ten thousand patients per prefix
    earlier = Window.partitionBy("prefix").orderBy("external_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = owners.withColumn("before", base + F.coalesce(F.sum("n_admissions").over(earlier), F.lit(0)))
    on_page = placed.filter((F.col("before") < offset + limit) & (F.col("before") + F.col("n_admissions") > offset))
    directories, out = {}, []
    for r in on_page.select("admissions_load", "admissions_at", "n_admissions", "before").collect():
        load = r["admissions_load"]
        if load not in directories:
            directories[load] = store.ordinals("admissions", load)
        directory = directories[load]
        first = directory.rank(r["admissions_at"]) - r["before"]
        out += directory.stretches(first + max(r["before"], offset), first + min(r["before"] + r["n_admissions"], offset + limit))
    return out


def admissions_page(store: ClinicalStore, limit: int = 50, offset: int = 0) -> Page:
    check_bounds(limit, offset)
    store = store.pinned()
    rows = rows_of(store.spark, ADMISSIONS, _stretches(store, limit, offset)).select(*ADMISSION_VIEW)
    return Page(store.total("n_admissions"), limit, offset, rows.orderBy(*ADMISSION_ORDER).limit(limit))


def admissions_after(store: ClinicalStore, after: list[str], limit: int = 50) -> DataFrame:
    return rows_after(store.admissions().select(*ADMISSION_VIEW), ADMISSION_ORDER, after, limit)


def radiographies_page(store: ClinicalStore, limit: int = 50, offset: int = 0) -> Page:
    """By object key over all images, whatever the keys begin with."""
    store = store.pinned()
    return sorted_page(store.radiographies(), store.all_ordinals("radiographies"), RADIOGRAPHY_ORDER, limit, offset)


def newest_runs(runs: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    age = runs.withColumn("_age", -F.unix_micros(F.col("started_at").cast("timestamp")))
    return page_rows(age, ["_age", "run_id"], limit, offset).drop("_age")


def runs_page(store: ClinicalStore, limit: int = 50, offset: int = 0) -> Page:
    runs = store.runs()
    return Page(runs.count(), limit, offset, newest_runs(runs, limit, offset))


def latest_run(store: ClinicalStore) -> Row | None:
    return newest_runs(store.runs(), 1).head()
