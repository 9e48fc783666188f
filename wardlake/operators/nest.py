"""Patient documents with nested children, and back to rows.

One patient may own billions of admissions, which no single array can hold. A document is
therefore cut into parts: a patient with up to PART_SIZE children of each kind has one part
(part 0), a larger one has as many as needed, and each child is in exactly one part. The part
of a child follows from a hash of its own key, so a large patient is grouped by many tasks.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.operators.links import bounded_ids, with_patient

PART_SIZE = 10_000


def _counts(children: DataFrame) -> DataFrame:
    """Children per patient; combines before its shuffle."""
    return children.groupBy("patient_external_id").agg(F.count(F.lit(1)).alias("n"))


def _parts(counts: DataFrame, part_size: int) -> DataFrame:
    """Number of parts of the patients that need more than one."""
    large = counts.filter(F.col("n") > part_size)
    return large.select("patient_external_id", F.ceil(F.col("n") / part_size).cast("long").alias("n_parts"))


def _part_of(key: list[str]) -> Column:
    text = F.concat_ws("|", *key)
    spread = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.when(F.col("n_parts").isNull(), F.lit(0)).otherwise(spread % F.col("n_parts")).cast("long")


def nest_children(
    children: DataFrame, key: list[str], field: str, part_size: int = PART_SIZE, counts: DataFrame | None = None
) -> DataFrame:
    """(patient_external_id, part, <field>): sorted arrays of structs, ``key`` fields leading.

    ``key`` identifies a child within its patient. Children must name valid patients. Known
    ``counts`` (patient_external_id, n) save a pass over the children.
    """
    large = _parts(_counts(children) if counts is None else counts, part_size)
    large = bounded_ids(large, "n_parts", key="patient_external_id")
    rest = [c for c in children.columns if c not in key]
    return (
        children.join(large, "patient_external_id", "left")
        .groupBy("patient_external_id", _part_of(key).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct(*key, *rest))).alias(field))
    )


def patient_documents(
    patients: DataFrame,
    admissions: DataFrame,
    radiographies: DataFrame | None = None,
    part_size: int = PART_SIZE,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """One row per patient part, arrays never null. Children of unknown patients drop out.

    Without ``sizes`` the children are linked to the patients and counted first. A caller who
    has children of these patients only, and knows how many, passes the counts per patient
    (external_id, admissions, radiographies).
    """
    kinds = [("admissions", admissions, ["admission_date", "department"])]
    if radiographies is not None:
        kinds.append(("radiographies", radiographies, ["minio_object_key"]))

    nested, parts = {}, []
    for field, children, key in kinds:
        if sizes is None:
            children = with_patient(children, patients)
            counts = _counts(children)
        else:
            counts = sizes.select(F.col("external_id").alias("patient_external_id"), F.col(field).alias("n"))
        nested[field] = nest_children(children, key, field, part_size, counts)
        parts.append(_parts(counts, part_size))

    most = reduce(DataFrame.unionByName, parts).groupBy(F.col("patient_external_id").alias("external_id"))
    most = bounded_ids(most.agg(F.max("n_parts").alias("n_parts")), "n_parts")
    docs = patients.join(most, "external_id", "left").withColumn("n_parts", F.coalesce("n_parts", F.lit(1).cast("long")))
    docs = docs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1)))
    for field, arrays in nested.items():
        docs = docs.join(arrays.withColumnRenamed("patient_external_id", "external_id"), ["external_id", "part"], "left")
        docs = docs.withColumn(field, F.coalesce(field, F.array().cast(arrays.schema[field].dataType)))
    return docs


def unnest_admissions(documents: DataFrame) -> DataFrame:
    """Array elements as rows; empty and null arrays give none."""
    return documents.select(F.inline("admissions"))


def unnest_radiographies(documents: DataFrame) -> DataFrame:
    """As above; the parent's id overrides the one inside the element."""
    element = documents.select("external_id", F.explode("radiographies").alias("_r"))
    return element.select(F.col("_r").withField("patient_external_id", F.col("external_id")).alias("_r")).select("_r.*")
