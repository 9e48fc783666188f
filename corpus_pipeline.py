"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, repeated
passages and secrets are removed, and what is left is packed into training sequences.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import near_dedup, packing, secret_scan, substring, toxicity
from wardlake.llm.common import Scratch, free_name
from wardlake.llm.queries import WORD_BPE, table


def _with_size(docs: DataFrame) -> DataFrame:
    """Bring ``n_chars`` up to date with the text where the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5, unchanged; the model is fitted on the labelled ones among them."""
    score = free_name(docs, "_toxicity")
    scored = toxicity.with_score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), score)
    return scored.filter(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of 50 words and more that an earlier one has."""
    kept, added = substring.remove_repeats(docs)
    return _with_size(kept.drop(*added.values()))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their secrets replaced."""
    return _with_size(secret_scan.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    return packing.pack(docs, WORD_BPE, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeats),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.keep(docs, name)
            if i:
                scratch.drop(STAGES[i - 1][0])
    return docs


#: No stage can be said in SQL as a whole; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None
