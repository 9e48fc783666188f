"""CSV files of patients and admissions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake import fs
from wardlake.schemas import ADMISSION_COLUMNS, PATIENT_COLUMNS, SOURCE_FILE


class MissingColumnsError(ValueError):
    """A file lacks columns its entity needs."""


def read_entity(spark: SparkSession, path: str, columns: list[str], **options: str) -> DataFrame:
    """Read a CSV file, or a directory or glob of them, as nullable strings.

    The header decides which column is which, extra columns are dropped, and each row names
    the file it came from. Nothing is rejected here. Extra reader options pass through, such
    as ``escape='"'`` for doubled quotes.
    """
    if not fs.exists(spark, path):
        raise FileNotFoundError(f"no such CSV input: {path}")
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").options(**options)
    if not fs.is_file(spark, path):
        # the header of the first file serves for all: refuse files that differ from it
        reader = reader.option("enforceSchema", False)
    raw = reader.csv(path)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise MissingColumnsError(f"{path} lacks the columns {missing}")
    # Spark shows the name URL-encoded, in which a plus sign is a plus sign
    shown = F.col("_metadata.file_name")
    plain = F.url_decode(F.replace(shown, F.lit("+"), F.lit("%2B")))
    name = F.when(shown.contains("%"), plain).otherwise(shown)
    return raw.select(*[F.col(c).cast("string") for c in columns], name.alias(SOURCE_FILE))


def read_patients(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return read_entity(spark, path, PATIENT_COLUMNS, **options)


def read_admissions(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return read_entity(spark, path, ADMISSION_COLUMNS, **options)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """CSV with a header, values unchanged: blanks kept, nulls and empty strings left empty."""
    options = {"header": True, "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer = df.write.mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
