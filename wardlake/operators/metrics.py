"""Summary counts. Each one combines before its shuffle and only sorts the few groups."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.functions import month_of
from wardlake.operators.clean import enrich_admissions


def _counts(df: DataFrame, key: str) -> DataFrame:
    # counts tie, so the key makes the order total
    return df.groupBy(key).count().orderBy(F.desc("count"), key)


def admissions_by_department(df: DataFrame) -> DataFrame:
    return _counts(df, "department")


def admissions_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(month_of(F.col("admission_date")).alias("month")).count().orderBy("month")


def admissions_by_diagnosis_category(df: DataFrame) -> DataFrame:
    enriched = df if "diagnosis_category" in df.columns else enrich_admissions(df)
    return _counts(enriched, "diagnosis_category")


def partial_counts(admissions: DataFrame) -> DataFrame:
    """All three summary counts of some enriched rows as (kind, key, n): they add up over any split of the rows."""
    keys = {"department": F.col("department"), "month": month_of(F.col("admission_date")), "category": F.col("diagnosis_category")}
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in keys.items()])
    return admissions.select(F.inline(pairs)).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))


def combined_counts(partial: DataFrame) -> DataFrame:
    """Partial counts added up; a count taken off is negative, and what is left at zero is no group."""
    return partial.groupBy("kind", "key").agg(F.sum("n").alias("n")).filter("n <> 0")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1")


def table_totals(**tables: DataFrame) -> DataFrame:
    """Row count per named table, zero for an empty one."""
    parts = [df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("item"), "total") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def nested_total(documents: DataFrame, field: str) -> DataFrame:
    """Sum of the sizes of a nested array; a null array counts as empty."""
    sizes = F.size(F.coalesce(F.col(field), F.array().cast(documents.schema[field].dataType)))
    return documents.agg(F.coalesce(F.sum(sizes), F.lit(0)).cast("long").alias("total"))
