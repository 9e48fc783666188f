"""The same results in plain SQL, for a check against another engine.

Each statement is a SELECT over named subqueries; only those it needs are put in front.
"""

import re

from wardlake.functions.draws import PRIME
from wardlake.schemas import BLOOD_TYPES, GENDERS, STATUSES
from wardlake.sources.generate import (
    BLOOD_TYPE_ODDS,
    DEPARTMENTS,
    DIAGNOSES,
    DUPLICATE_RATIO,
    FAMILY_NAMES,
    GENDER_ODDS,
    GIVEN_NAMES,
)
from wardlake.sources.testdata import BLOOD_BY_KEY, CODE_BY_KEY, DEPARTMENT_BY_KEY

DAY = "DATE '2026-04-21'"
P_COLS = "external_id, name, birth_date, gender, blood_type"
A_COLS = "patient_external_id, admission_date, discharge_date, department, diagnosis_code, diagnosis_description, status"


def _list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


DESCRIBE = "CASE " + " ".join(f"WHEN diagnosis_code = '{c}' THEN '{d}'" for c, d in DIAGNOSES.items()) + " END"

PATIENT_REASON = """CASE
  WHEN external_id IS NULL OR NOT regexp_matches(external_id, '^HOSP-[0-9]{6}$') THEN 'invalid external_id'
  WHEN name IS NULL OR trim(name) = '' THEN 'missing name'
  WHEN birth_date IS NULL OR NOT regexp_matches(birth_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN 'invalid birth_date'
  WHEN gender IS NULL OR gender NOT IN ('M', 'F', 'Other') THEN 'invalid gender'
  WHEN blood_type IS NULL OR blood_type NOT IN ('A+', 'A-', 'B+', 'B-', 'AB+', 'AB-', 'O+', 'O-')
    THEN 'invalid blood_type' END AS rejection_reason"""

ADMISSION_REASON = """CASE
  WHEN patient_external_id IS NULL OR NOT regexp_matches(patient_external_id, '^HOSP-[0-9]{6}$')
    THEN 'invalid patient_external_id'
  WHEN admission_date IS NULL OR NOT regexp_matches(admission_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')
    THEN 'invalid admission_date'
  WHEN department IS NULL OR trim(department) = '' THEN 'missing department'
  WHEN status IS NULL OR status NOT IN ('admitted', 'discharged', 'transferred') THEN 'invalid status'
  END AS rejection_reason"""

AGE = f"CAST(floor(datesub('month', TRY_CAST(birth_date AS DATE), {DAY}) / 12.0) AS INTEGER) AS age"

CATEGORY = """CASE WHEN diagnosis_code IS NULL THEN 'Unknown'
  WHEN starts_with(diagnosis_code, 'U07') THEN 'COVID-19'
  WHEN substr(diagnosis_code, 1, 3) IN ('J12', 'J13', 'J14', 'J15', 'J16', 'J17', 'J18') THEN 'Pneumonia'
  ELSE 'Other' END AS diagnosis_category"""


def _with_copies(source: str, key: str) -> str:
    """Every 33rd row twice."""
    return f"""SELECT * EXCLUDE (copy) FROM
  (SELECT *, unnest(CASE WHEN {key} % 33 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM {source})"""


def _clean_patients(source: str, extra_key: str = "") -> str:
    key = f"{extra_key}external_id"
    return f"""SELECT {extra_key}external_id, trim(name) AS name, birth_date, gender, blood_type FROM {source}
  WHERE rejection_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY trim(name) ASC NULLS FIRST, birth_date ASC NULLS FIRST,
    gender ASC NULLS FIRST, blood_type ASC NULLS FIRST) = 1"""


def _clean_admissions(source: str, extra_key: str = "") -> str:
    key = f"{extra_key}patient_external_id, admission_date, trim(department)"
    return f"""SELECT {extra_key}patient_external_id, admission_date, discharge_date, trim(department) AS department,
    diagnosis_code, diagnosis_description, status FROM {source}
  WHERE rejection_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY discharge_date ASC NULLS FIRST,
    diagnosis_code ASC NULLS FIRST, diagnosis_description ASC NULLS FIRST, status ASC NULLS FIRST) = 1"""


def _documents(part_size: int, images: str) -> str:
    """Documents cut into parts, as (external_id, part) with the children as text."""

    def kind(source: str, key: str, text: str, order: str, name: str) -> str:
        return f"""
  {name}_n AS (SELECT patient_external_id AS pid, CAST(ceil(count(*) / {part_size}.0) AS BIGINT) AS parts
    FROM {source} GROUP BY 1 HAVING count(*) > {part_size}),
  {name}_part AS (SELECT c.*, CASE WHEN n.parts IS NULL THEN 0
      ELSE CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % n.parts END AS part
    FROM {source} c LEFT JOIN {name}_n n ON c.patient_external_id = n.pid),
  {name}_doc AS (SELECT patient_external_id AS pid, part, count(*) AS n, string_agg({text}, ';' ORDER BY {order}) AS t
    FROM {name}_part GROUP BY 1, 2)"""

    line = (
        "concat_ws(':', admission_date, department, coalesce(diagnosis_code, '-'), status, diagnosis_category)"
    )
    return (
        "WITH "
        + kind("visible", "admission_date || '|' || department", line, "admission_date, department", "a").lstrip()
        + ","
        + kind(images, "minio_object_key", "minio_object_key", "minio_object_key", "r")
        + """,
  n_parts AS (SELECT pid, max(parts) AS n FROM (SELECT * FROM a_n UNION ALL SELECT * FROM r_n) GROUP BY 1),
  parts AS (SELECT p.*, coalesce(n.n, 1) AS n_parts, unnest(range(0, coalesce(n.n, 1))) AS part
    FROM patients p LEFT JOIN n_parts n ON p.external_id = n.pid)
SELECT external_id, parts.part, n_parts, name, age, coalesce(a.n, 0) AS n_admissions, coalesce(a.t, '') AS admissions,
  coalesce(r.n, 0) AS n_radiographies, coalesce(r.t, '') AS radiographies
FROM parts LEFT JOIN a_doc a ON external_id = a.pid AND parts.part = a.part
  LEFT JOIN r_doc r ON external_id = r.pid AND parts.part = r.part"""
    )


def _draw(seed: int, key: str = "key") -> str:
    base = f"({key} % {PRIME})"
    first = f"(({base} * 48271 + {seed * 7919 + 12345}) % {PRIME})"
    second = f"(({first} * {first} + {base}) % {PRIME})"
    third = f"(({second} * 69621 + {first}) % {PRIME})"
    return f"(({third} * {third} + {second}) % {PRIME})"


def _below(seed: int, ratio: float) -> str:
    return f"{_draw(seed)} < {int(ratio * PRIME)}"


def _pick(seed: int, values: list[str]) -> str:
    return f"{_list(values)}[{_draw(seed)} % {len(values)} + 1]"


def _weighted(seed: int, values: list[str], odds: list[float]) -> str:
    edges = [int(sum(odds[: i + 1]) * PRIME) for i in range(len(odds) - 1)]
    arms = " ".join(f"WHEN {_draw(seed)} < {e} THEN '{v}'" for v, e in zip(values, edges))
    return f"CASE {arms} ELSE '{values[-1]}' END"


# named subqueries; a later one may use earlier ones
SUBQUERIES = {
    "patients_once": f"""SELECT c_custkey, c_mktsegment, c_acctbal,
  printf('HOSP-%06d', c_custkey) AS external_id,
  CASE WHEN c_custkey % 40 = 3 THEN '' WHEN c_custkey % 7 = 2 THEN '  ' || c_name || ' ' ELSE c_name END AS name,
  CASE WHEN c_custkey % 40 = 13 THEN NULL WHEN c_custkey % 40 = 23 THEN '04/11/1971'
    WHEN c_custkey % 400 = 77 THEN '1999-02-30'
    ELSE CAST(1940 + c_custkey * 7 % 75 AS VARCHAR) || '-' || lpad(CAST(1 + c_custkey * 5 % 12 AS VARCHAR), 2, '0')
      || '-' || lpad(CAST(1 + c_custkey * 11 % 28 AS VARCHAR), 2, '0') END AS birth_date,
  CASE WHEN c_custkey % 40 = 33 THEN NULL WHEN c_custkey % 25 = 0 THEN 'Other'
    WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  {_list(BLOOD_BY_KEY)}[c_custkey % 8 + 1] AS blood_type FROM customer""",
    "patients_all": _with_copies("patients_once", "c_custkey"),
    "patients_raw": f"SELECT {P_COLS} FROM patients_all",
    "admissions_once": f"""SELECT *, {DESCRIBE} AS diagnosis_description FROM (SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 20 = 7 THEN 'HOSP-' || CAST(900000 + o_orderkey % 100000 AS VARCHAR)
    ELSE printf('HOSP-%06d', o_custkey) END AS patient_external_id,
  CASE WHEN o_orderkey % 20 = 11 THEN strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y')
    ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS admission_date,
  CASE WHEN o_orderstatus <> 'O'
    THEN strftime(CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 30 AS INTEGER), '%Y-%m-%d') END AS discharge_date,
  {_list(DEPARTMENT_BY_KEY)}[o_orderkey % 10 + 1] AS department,
  {_list(CODE_BY_KEY)}[(o_orderkey + o_custkey) % 11 + 1] AS diagnosis_code,
  CASE o_orderstatus WHEN 'O' THEN 'admitted' WHEN 'F' THEN 'discharged' WHEN 'P' THEN 'transferred' END AS status
  FROM orders)""",
    "admissions_all": _with_copies("admissions_once", "o_orderkey"),
    "admissions_raw": f"SELECT {A_COLS} FROM admissions_all",
    "patients_dirty": f"""SELECT CASE WHEN c_custkey % 31 = 5 THEN NULL
    WHEN c_custkey % 31 = 9 THEN 'BAD-' || CAST(c_custkey AS VARCHAR)
    WHEN c_custkey % 31 = 11 THEN substr(external_id, 1, 10) WHEN c_custkey % 31 = 13 THEN lower(external_id)
    ELSE external_id END AS external_id,
  CASE WHEN c_custkey % 19 = 3 THEN '   ' WHEN c_custkey % 19 = 5 THEN chr(9) WHEN c_custkey % 19 = 7 THEN NULL
    ELSE name END AS name,
  birth_date,
  CASE WHEN c_custkey % 23 = 2 THEN 'X' WHEN c_custkey % 23 = 4 THEN 'm' ELSE gender END AS gender,
  CASE WHEN c_custkey % 29 = 3 THEN NULL WHEN c_custkey % 29 = 7 THEN 'C+' WHEN c_custkey % 29 = 9 THEN 'a+'
    ELSE blood_type END AS blood_type FROM patients_all""",
    "admissions_dirty": """SELECT CASE WHEN o_orderkey % 37 = 1 THEN NULL
    WHEN o_orderkey % 37 = 3 THEN 'X' || patient_external_id ELSE patient_external_id END AS patient_external_id,
  CASE WHEN o_orderkey % 47 = 2 THEN NULL WHEN o_orderkey % 47 = 4 THEN '2025-1-5' ELSE admission_date END AS admission_date,
  discharge_date,
  CASE WHEN o_orderkey % 41 = 2 THEN NULL WHEN o_orderkey % 41 = 5 THEN '   ' ELSE department END AS department,
  diagnosis_code, diagnosis_description,
  CASE WHEN o_orderkey % 43 = 1 THEN NULL WHEN o_orderkey % 43 = 4 THEN 'unknown'
    WHEN o_orderkey % 43 = 6 THEN 'Admitted' ELSE status END AS status FROM admissions_all""",
    "patients_tagged": f"SELECT *, {PATIENT_REASON} FROM patients_raw",
    "admissions_tagged": f"SELECT *, {ADMISSION_REASON} FROM admissions_raw",
    "patients_dirty_tagged": f"SELECT *, {PATIENT_REASON} FROM patients_dirty",
    "admissions_dirty_tagged": f"SELECT *, {ADMISSION_REASON} FROM admissions_dirty",
    "patients_clean": _clean_patients("patients_tagged"),
    "admissions_clean": _clean_admissions("admissions_tagged"),
    "patients": f"SELECT *, {AGE} FROM patients_clean",
    "admissions": f"SELECT *, {CATEGORY} FROM admissions_clean",
    "visible": "SELECT * FROM admissions WHERE patient_external_id IN (SELECT external_id FROM patients)",
    "image_files": """SELECT vec_id, CASE WHEN vec_id % 20 = 7 THEN 'random_' || CAST(vec_id AS VARCHAR) || '.png'
    WHEN vec_id % 20 = 9 THEN pid || '_notes' || CAST(vec_id AS VARCHAR) || '.txt'
    WHEN vec_id % 20 = 11 THEN pid || '_xray' || CAST(vec_id AS VARCHAR) || '.PNG'
    ELSE pid || '_xray' || CAST(vec_id AS VARCHAR) || '.png' END AS name, 67 + vec_id AS length,
    vec_id % 25 <> 4 AS good FROM
    (SELECT vec_id, printf('HOSP-%06d', CASE WHEN vec_id % 8 = 0 THEN vec_id % 5 ELSE vec_id END) AS pid FROM embeddings)""",
    "image_classes": """SELECT name, length, regexp_extract(name, '^(HOSP-[0-9]{6})_', 1) AS patient,
  CASE WHEN NOT ends_with(lower(name), '.png') THEN 'not_png'
    WHEN NOT regexp_matches(name, '^HOSP-[0-9]{6}_') THEN 'bad_name'
    WHEN good THEN 'ok' ELSE 'corrupt' END AS disposition FROM image_files""",
    "images": """SELECT patient AS patient_external_id, patient || '/' || name AS minio_object_key,
  name AS original_filename, length AS file_size_bytes FROM image_classes WHERE disposition = 'ok'""",
    "visible_images": "SELECT * FROM images WHERE patient_external_id IN (SELECT external_id FROM patients)",
    "attached": "SELECT DISTINCT * FROM visible_images",
    "stored_patients": """SELECT external_id, min('old ' || trim(name)) AS name, 1 AS age, min(c_mktsegment) AS ward
  FROM patients_all WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1""",
    "batch_tagged": f"SELECT *, {PATIENT_REASON} FROM patients_all WHERE c_acctbal >= 0",
    "batch_clean": _clean_patients("batch_tagged"),
    "batch": f"SELECT *, {AGE} FROM batch_clean",
    "merged": """SELECT coalesce(b.external_id, s.external_id) AS external_id,
  CASE WHEN b.external_id IS NOT NULL THEN b.name ELSE s.name END AS name,
  CASE WHEN b.external_id IS NOT NULL THEN b.age ELSE s.age END AS age, s.ward,
  CASE WHEN s.external_id IS NOT NULL THEN '2026-01-01 00:00:00.000000' ELSE '2026-04-21 00:00:00.000000' END AS created_at,
  CASE WHEN b.external_id IS NULL THEN '2026-01-01 00:00:00.000000' ELSE '2026-04-21 00:00:00.000000' END AS updated_at,
  b.birth_date, b.gender, b.blood_type
  FROM stored_patients s FULL JOIN batch b ON s.external_id = b.external_id""",
    "attached_before": "SELECT * FROM images WHERE patient_external_id IN (SELECT external_id FROM stored_patients)",
    "replaced": """SELECT * FROM visible WHERE patient_external_id NOT IN (SELECT external_id FROM batch)
UNION ALL SELECT * FROM admissions WHERE status = 'admitted' AND patient_external_id IN (SELECT external_id FROM batch)""",
    "page_objects": """SELECT split_part(url, '/', 3) AS bucket,
  split_part(url, '/', 4) || '/' || CAST(page_id AS VARCHAR) || '.html' AS object_key, html FROM pages""",
    "objects_now": """SELECT bucket, object_key, CASE WHEN starts_with(object_key, 'fr/') THEN 'bonjour' ELSE html END AS body,
  CASE WHEN starts_with(object_key, 'fr/') THEN 'application/octet-stream' ELSE 'text/html' END AS content_type,
  CAST(CASE WHEN starts_with(object_key, 'fr/') THEN 2 ELSE 1 END AS BIGINT) AS load
  FROM page_objects WHERE NOT starts_with(object_key, 'de/')""",
    "run_events": """SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS event_at, event_type AS trigger_type,
  'running' AS status, false AS closing, CAST(0 AS BIGINT) AS records_processed, CAST(0 AS BIGINT) AS records_rejected,
  NULL AS error_message FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), ts + INTERVAL 1 HOUR, NULL,
  CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END, true, CAST(floor(value * 10) AS BIGINT), user_id,
  CASE WHEN event_type = 'error' THEN 'RuntimeError: ' || props END FROM events WHERE event_type <> 'view'""",
    "runs": """SELECT run_id, max(trigger_type) OVER same AS trigger_type,
  strftime(min(event_at) OVER same, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
  CASE WHEN closing THEN strftime(event_at, '%Y-%m-%d %H:%M:%S.%f') END AS finished_at,
  status, records_processed, records_rejected, CAST(0 AS BIGINT) AS images_processed, error_message
  FROM run_events WINDOW same AS (PARTITION BY run_id)
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY closing DESC, event_at DESC, status DESC,
    records_processed DESC, records_rejected DESC, error_message DESC NULLS LAST) = 1""",
    "segment_patients": f"SELECT c_mktsegment, {P_COLS}, {PATIENT_REASON} FROM patients_all",
    "segment_admissions": f"""SELECT c_mktsegment, {A_COLS}, {ADMISSION_REASON}
  FROM admissions_all JOIN (SELECT c_custkey, min(c_mktsegment) AS c_mktsegment FROM customer GROUP BY 1)
  ON o_custkey = c_custkey""",
    "segment_patients_clean": _clean_patients("segment_patients", "c_mktsegment, "),
    "segment_admissions_clean": _clean_admissions("segment_admissions", "c_mktsegment, "),
}

S42 = 4200

STATEMENTS = {
    "patient_summary": """SELECT external_id, name, age, coalesce(n, 0) AS n_admissions, coalesce(covid, 0) AS n_covid,
  coalesce(pneumonia, 0) AS n_pneumonia FROM patients LEFT JOIN (SELECT patient_external_id AS pid, count(*) AS n,
    count(*) FILTER (WHERE diagnosis_category = 'COVID-19') AS covid,
    count(*) FILTER (WHERE diagnosis_category = 'Pneumonia') AS pneumonia FROM admissions GROUP BY 1)
  ON external_id = pid""",
    "read_contract_patients": """SELECT external_id, nullif(name, '') AS name, birth_date, gender, blood_type,
  true AS has_source FROM patients_raw""",
    "read_contract_admissions": f"SELECT {A_COLS}, true AS has_source FROM admissions_raw",
    "rule_invalid_external_id": """SELECT * FROM patients_dirty
  WHERE external_id IS NULL OR NOT regexp_matches(external_id, '^HOSP-[0-9]{6}$')""",
    "rule_missing_name": "SELECT * FROM patients_dirty WHERE name IS NULL OR trim(name) = ''",
    "rule_invalid_birth_date": """SELECT * FROM patients_dirty
  WHERE birth_date IS NULL OR NOT regexp_matches(birth_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')""",
    "rule_invalid_gender": "SELECT * FROM patients_dirty WHERE gender IS NULL OR gender NOT IN ('M', 'F', 'Other')",
    "rule_invalid_blood_type": """SELECT * FROM patients_dirty WHERE blood_type IS NULL
  OR blood_type NOT IN ('A+', 'A-', 'B+', 'B-', 'AB+', 'AB-', 'O+', 'O-')""",
    "rule_invalid_patient_external_id": """SELECT * FROM admissions_dirty
  WHERE patient_external_id IS NULL OR NOT regexp_matches(patient_external_id, '^HOSP-[0-9]{6}$')""",
    "rule_invalid_admission_date": """SELECT * FROM admissions_dirty
  WHERE admission_date IS NULL OR NOT regexp_matches(admission_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')""",
    "rule_missing_department": "SELECT * FROM admissions_dirty WHERE department IS NULL OR trim(department) = ''",
    "rule_invalid_status": """SELECT * FROM admissions_dirty
  WHERE status IS NULL OR status NOT IN ('admitted', 'discharged', 'transferred')""",
    "validate_patients": "SELECT * FROM patients_tagged",
    "validate_admissions": "SELECT * FROM admissions_tagged",
    "validate_patients_dirty": "SELECT * FROM patients_dirty_tagged",
    "validate_admissions_dirty": "SELECT * FROM admissions_dirty_tagged",
    "reject_report": """SELECT 'patients' AS entity, rejection_reason, count(*) AS count FROM patients_tagged GROUP BY 2
UNION ALL SELECT 'admissions', rejection_reason, count(*) FROM admissions_tagged GROUP BY 2""",
    "rejected_records": """SELECT 'patients.csv' AS source_file, rejection_reason,
  concat_ws('|', 'birth_date=' || coalesce(birth_date, 'NULL'), 'blood_type=' || coalesce(blood_type, 'NULL'),
    'external_id=' || coalesce(external_id, 'NULL'), 'gender=' || coalesce(gender, 'NULL'),
    'name=' || coalesce(name, 'NULL')) AS raw_data
  FROM patients_dirty_tagged WHERE rejection_reason IS NOT NULL
UNION ALL SELECT 'admissions.csv', rejection_reason,
  concat_ws('|', 'admission_date=' || coalesce(admission_date, 'NULL'), 'department=' || coalesce(department, 'NULL'),
    'diagnosis_code=' || coalesce(diagnosis_code, 'NULL'),
    'diagnosis_description=' || coalesce(diagnosis_description, 'NULL'),
    'discharge_date=' || coalesce(discharge_date, 'NULL'),
    'patient_external_id=' || coalesce(patient_external_id, 'NULL'), 'status=' || coalesce(status, 'NULL'))
  FROM admissions_dirty_tagged WHERE rejection_reason IS NOT NULL""",
    "clean_patients": "SELECT * FROM patients_clean",
    "clean_admissions": "SELECT * FROM admissions_clean",
    "patients_with_age": "SELECT * FROM patients",
    "admissions_with_category": "SELECT * FROM admissions",
    "admissions_by_department": "SELECT department, count(*) AS count FROM admissions_clean GROUP BY 1 ORDER BY 2 DESC, 1",
    "admissions_by_month": """SELECT strftime(TRY_CAST(admission_date AS DATE), '%Y-%m') AS month, count(*) AS count
  FROM admissions_clean GROUP BY 1 ORDER BY 1""",
    "admissions_by_category": "SELECT diagnosis_category, count(*) AS count FROM admissions GROUP BY 1 ORDER BY 2 DESC, 1",
    "patient_documents": _documents(10_000, "visible_images"),
    "patient_document_parts": _documents(4, "visible_images"),
    "admissions_flat": "SELECT * FROM visible",
    "radiographies_flat": """SELECT patient_external_id, minio_object_key, original_filename, file_size_bytes,
  '2026-04-21T00:00:00+00:00' AS ingested_at FROM visible_images""",
    "nested_totals": """SELECT 'patients' AS item, count(*) AS total FROM patients
UNION ALL SELECT 'admissions', count(*) FROM visible UNION ALL SELECT 'radiographies', count(*) FROM visible_images""",
    "orphan_admissions": "SELECT * FROM admissions WHERE patient_external_id NOT IN (SELECT external_id FROM patients)",
    "orphan_images": """SELECT patient_external_id, minio_object_key, file_size_bytes FROM images
  WHERE patient_external_id NOT IN (SELECT external_id FROM patients)""",
    "duplicate_patients": "SELECT external_id, count(*) AS count FROM patients_raw GROUP BY 1 HAVING count(*) > 1",
    "duplicate_admissions": """SELECT patient_external_id, admission_date, department, count(*) AS count
  FROM admissions_raw GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "patients_page": "SELECT * FROM patients ORDER BY external_id LIMIT 50 OFFSET 20",
    "admissions_page": """SELECT * FROM visible ORDER BY patient_external_id, admission_date, department
  LIMIT 50 OFFSET 100""",
    "admissions_deep_page": """SELECT * FROM visible ORDER BY patient_external_id, admission_date, department
  LIMIT 50 OFFSET 800""",
    "admissions_after": """SELECT * FROM visible
  WHERE (patient_external_id, admission_date, department) > ('HOSP-000042', '1996-12-31', 'UCI')
  ORDER BY patient_external_id, admission_date, department LIMIT 50""",
    "radiographies_page": """SELECT patient_external_id, minio_object_key, file_size_bytes FROM visible_images
  ORDER BY minio_object_key LIMIT 50 OFFSET 10""",
    "served_pages": """SELECT 'patients' AS kind, (SELECT count(*) FROM patients) AS total, concat_ws('|', external_id, name,
    CAST((SELECT count(*) FROM visible v WHERE v.patient_external_id = p.external_id) AS VARCHAR),
    CAST((SELECT count(*) FROM attached v WHERE v.patient_external_id = p.external_id) AS VARCHAR)) AS item
  FROM (SELECT * FROM patients ORDER BY external_id LIMIT 50 OFFSET 20) p
UNION ALL SELECT 'admissions', (SELECT count(*) FROM visible), concat_ws('|', patient_external_id, admission_date,
    department, diagnosis_category)
  FROM (SELECT * FROM visible ORDER BY patient_external_id, admission_date, department LIMIT 50 OFFSET 800)
UNION ALL SELECT 'radiographies', (SELECT count(*) FROM attached),
    concat_ws('|', minio_object_key, patient_external_id)
  FROM (SELECT * FROM attached ORDER BY minio_object_key LIMIT 10 OFFSET 5)""",
    "patient_lookup": f"SELECT * FROM ({_documents(10_000, 'visible_images')}) WHERE external_id = 'HOSP-000042'",
    "merge_patients": "SELECT * FROM merged",
    "merge_idempotent": "SELECT * FROM merged",
    "merge_stats": """SELECT count(*) FILTER (WHERE external_id NOT IN (SELECT external_id FROM stored_patients)) AS upserted,
  count(*) FILTER (WHERE external_id IN (SELECT external_id FROM stored_patients)) AS modified FROM batch""",
    "replace_admissions": "SELECT * FROM replaced",
    "stored_counts": """SELECT 'department' AS kind, department AS key, count(*) AS count FROM replaced GROUP BY 2
UNION ALL SELECT 'month', strftime(TRY_CAST(admission_date AS DATE), '%Y-%m'), count(*) FROM replaced GROUP BY 2
UNION ALL SELECT 'category', diagnosis_category, count(*) FROM replaced GROUP BY 2""",
    "attach_radiographies": """SELECT 'stored' AS state, patient_external_id, minio_object_key, file_size_bytes
  FROM attached_before
UNION ALL SELECT DISTINCT 'new', patient_external_id, minio_object_key, file_size_bytes FROM visible_images
  WHERE minio_object_key NOT IN (SELECT minio_object_key FROM attached_before)""",
    "image_dispositions": "SELECT * FROM image_classes",
    "image_totals": "SELECT disposition, count(*) AS count FROM image_classes GROUP BY 1",
    "image_sync": """SELECT CASE WHEN original_filename IN (SELECT original_filename FROM attached_before)
    THEN 'already there' ELSE 'uploaded' END AS sync_state,
  CASE WHEN patient_external_id IN (SELECT external_id FROM patients) THEN 'attached' ELSE 'orphan' END AS attach_state,
  count(*) AS count FROM images GROUP BY 1, 2""",
    "image_ingest": """SELECT i.minio_object_key, 8 + length(i.original_filename) AS length, v.patient_external_id,
  8 + length(v.original_filename) AS file_size_bytes
  FROM (SELECT DISTINCT minio_object_key, original_filename FROM images) i
  LEFT JOIN (SELECT DISTINCT * FROM visible_images) v ON i.minio_object_key = v.minio_object_key""",
    "chosen_images": """SELECT 'file' AS how, name, disposition FROM image_classes WHERE name = (SELECT min(name) FROM image_classes)
UNION ALL SELECT 'glob', name, disposition FROM image_classes WHERE starts_with(name, 'HOSP-') AND ends_with(name, '1.png')""",
    "second_load": """SELECT 'first call: uploaded' AS item, count(DISTINCT minio_object_key) AS total FROM images
UNION ALL SELECT 'second call: already there', count(DISTINCT minio_object_key) FROM images
UNION ALL SELECT 'written', count(DISTINCT minio_object_key) FROM images UNION ALL SELECT 'attached', count(*) FROM attached
UNION ALL SELECT 'patients', count(*) FROM patients UNION ALL SELECT 'runs', 1""",
    "exported_objects": """SELECT b || split_part(url, '/', 3) AS bucket, split_part(url, '/', 4) || '/' || CAST(page_id AS VARCHAR) || '.html'
    AS object_key, octet_length(encode(html)) AS length FROM pages, (VALUES (''), ('copy-')) t(b)""",
    "rejects_of_run": """SELECT 'admissions.csv' AS source_file, rejection_reason, count(*) AS count FROM admissions_tagged
  WHERE rejection_reason IS NOT NULL GROUP BY 2""",
    "store_states": """SELECT 'empty before' AS item, true AS holds UNION ALL SELECT 'empty after', (SELECT count(*) FROM patients) = 0
UNION ALL SELECT 'object', (SELECT count(*) FROM pages) > 0 UNION ALL SELECT 'no such object', false""",
    "blob_index": """SELECT bucket, object_key, octet_length(encode(body)) AS length, content_type, load
  FROM objects_now""",
    "blob_list": """SELECT bucket, split_part(object_key, '/', 1) AS folder, count(*) AS n,
  CAST(sum(octet_length(encode(body))) AS BIGINT) AS bytes FROM objects_now GROUP BY 1, 2""",
    "blob_prefix": "SELECT object_key FROM page_objects WHERE starts_with(object_key, 'fr/')",
    "blob_contents": "SELECT bucket, object_key, md5(body) AS digest FROM objects_now",
    "run_states": "SELECT * FROM runs",
    "failed_runs": "SELECT run_id, error_message FROM runs WHERE status = 'failed'",
    "run_history": "SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 50 OFFSET 25",
    "latest_run": "SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 1",
    "run_totals": """SELECT 'patients_processed' AS item, count(*) AS total FROM patients_clean
UNION ALL SELECT 'admissions_processed', count(*) FROM admissions_clean
UNION ALL SELECT 'patients_rejected', count(*) FROM patients_tagged WHERE rejection_reason IS NOT NULL
UNION ALL SELECT 'admissions_rejected', count(*) FROM admissions_tagged WHERE rejection_reason IS NOT NULL""",
    "generated_patients": f"""SELECT external_id, name, birth_date, gender, blood_type FROM (SELECT
  printf('HOSP-%06d', key) AS external_id,
  CASE WHEN edge = 0 THEN '' ELSE full_name END AS name,
  CASE WHEN edge = 1 THEN '' WHEN edge = 3 THEN strftime(birth, '%d/%m/%Y') ELSE strftime(birth, '%Y-%m-%d') END AS birth_date,
  CASE WHEN edge = 2 THEN '' ELSE sex END AS gender, blood_type, unnest(range(0, copies)) AS copy
  FROM (SELECT key,
    CASE WHEN {_below(S42 + 2, 0.2)} THEN {_draw(S42 + 3)} % 4 ELSE -1 END AS edge,
    {DAY} - 1827 - CAST({_draw(S42 + 1)} % 29200 AS INTEGER) AS birth,
    concat_ws(' ', {_pick(S42 + 4, GIVEN_NAMES)}, {_pick(S42 + 5, FAMILY_NAMES)}, {_pick(S42 + 6, FAMILY_NAMES)}) AS full_name,
    {_weighted(S42 + 7, GENDERS, GENDER_ODDS)} AS sex,
    {_weighted(S42 + 8, BLOOD_TYPES, BLOOD_TYPE_ODDS)} AS blood_type,
    CASE WHEN {_below(S42 + 9, DUPLICATE_RATIO)} OR key = 0 THEN 2 ELSE 1 END AS copies
    FROM (SELECT c_custkey AS key FROM customer)))""",
    "generated_admissions": f"""SELECT patient_external_id,
  CASE WHEN bad_date THEN strftime(day, '%d/%m/%Y') ELSE strftime(day, '%Y-%m-%d') END AS admission_date,
  CASE WHEN status = 'admitted' THEN '' ELSE strftime(day + stay, '%Y-%m-%d') END AS discharge_date,
  department, diagnosis_code, {DESCRIBE} AS diagnosis_description, status
  FROM (SELECT
    CASE WHEN {_below(S42 + 1, 0.2)} THEN printf('HOSP-%06d', 900000 + {_draw(S42 + 2)} % 100000)
      ELSE external_id END AS patient_external_id,
    {DAY} - CAST({_draw(S42 + 4)} % 730 AS INTEGER) AS day,
    CAST({_draw(S42 + 5)} % 30 + 1 AS INTEGER) AS stay,
    {_pick(S42 + 6, STATUSES)} AS status,
    {_pick(S42 + 7, DEPARTMENTS)} AS department,
    {_pick(S42 + 8, list(DIAGNOSES))} AS diagnosis_code,
    {_below(S42 + 9, 0.2)} AS bad_date
    FROM (SELECT o_orderkey AS key FROM orders) JOIN
      (SELECT external_id, row_number() OVER (ORDER BY external_id) - 1 AS number FROM
        (SELECT printf('HOSP-%06d', c_custkey) AS external_id FROM customer))
      ON number = {_draw(S42 + 3)} % (SELECT count(*) FROM customer))""",
    "generated_images": f"""SELECT patient || '_xray' || CAST(n AS VARCHAR) || '.png' AS name, '89504E470D0A1A0A' AS signature
  FROM (SELECT printf('HOSP-%06d', key) AS patient, unnest(range(1, {_draw(S42 + 1)} % 3 + 2)) AS n
    FROM (SELECT c_custkey AS key FROM customer))""",
    "etl_run": "SELECT * REPLACE (CAST(0 AS BIGINT) AS n_radiographies, '' AS radiographies) FROM ("
    + _documents(10_000, "visible_images")
    + ")",
    "etl_rerun": """SELECT 'patients' AS item, count(*) AS total FROM patients
UNION ALL SELECT 'admissions', count(*) FROM visible
UNION ALL SELECT 'rejected', 2 * ((SELECT count(*) FROM patients_tagged WHERE rejection_reason IS NOT NULL)
  + (SELECT count(*) FROM admissions_tagged WHERE rejection_reason IS NOT NULL))
UNION ALL SELECT 'successful_runs', 2
UNION ALL SELECT 'processed in a run', (SELECT count(*) FROM patients) + (SELECT count(*) FROM admissions)
UNION ALL SELECT 'processed in a run', (SELECT count(*) FROM patients) + (SELECT count(*) FROM admissions)""",
    "incremental_batches": """SELECT c_mktsegment AS batch, 'success' AS status,
  CAST(sum(good) AS BIGINT) AS records_processed, CAST(sum(bad) AS BIGINT) AS records_rejected FROM (
    SELECT c_mktsegment, 1 AS good, 0 AS bad FROM segment_patients_clean
    UNION ALL SELECT c_mktsegment, 1, 0 FROM segment_admissions_clean
    UNION ALL SELECT c_mktsegment, 0, 1 FROM segment_patients WHERE rejection_reason IS NOT NULL
    UNION ALL SELECT c_mktsegment, 0, 1 FROM segment_admissions WHERE rejection_reason IS NOT NULL) GROUP BY 1""",
    "archived_batches": """SELECT c_mktsegment AS batch, 'patients.csv' AS file, count(*) AS count FROM segment_patients GROUP BY 1
UNION ALL SELECT c_mktsegment, 'admissions.csv', count(*) FROM segment_admissions GROUP BY 1""",
    "run_outcomes": """SELECT trigger_type, 'success' AS status, (SELECT count(*) FROM patients) + (SELECT count(*) FROM admissions) AS records_processed,
  (SELECT count(*) FROM patients_tagged WHERE rejection_reason IS NOT NULL)
  + (SELECT count(*) FROM admissions_tagged WHERE rejection_reason IS NOT NULL) AS records_rejected, NULL::VARCHAR AS error
  FROM (VALUES ('opened before'), ('after')) AS t(trigger_type)
UNION ALL SELECT 'broken', 'failed', 0, 0, 'MissingColumnsError'""",
    "contract_errors": """SELECT * FROM (VALUES ('nothing there', 'FileNotFoundError'), ('without external_id', 'MissingColumnsError'),
  ('without name', 'MissingColumnsError'), ('without birth_date', 'MissingColumnsError'), ('without gender', 'MissingColumnsError'),
  ('without blood_type', 'MissingColumnsError'), ('limit 0', 'ValueError'), ('limit 1', 'none'), ('limit 500', 'none'),
  ('limit 501', 'ValueError'), ('offset -1', 'ValueError')) AS t(breach, error)""",
}


def _needed(sql: str) -> set[str]:
    used = {n for n in SUBQUERIES if re.search(rf"\b{n}\b", sql)}
    return used.union(*[_needed(SUBQUERIES[n]) for n in used])


def _with_subqueries(sql: str) -> str:
    needed = _needed(sql)
    front = ",\n".join(f"{name} AS ({text})" for name, text in SUBQUERIES.items() if name in needed)
    if not front:
        return sql
    # a statement with subqueries of its own: ours go first
    if sql.startswith("WITH "):
        return f"WITH {front},\n{sql[len('WITH '):]}"
    return f"WITH {front}\n{sql}"


ORACLE = {name: _with_subqueries(sql) for name, sql in STATEMENTS.items()}
