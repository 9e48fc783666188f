"""Registered queries of the subpackage, each over its whole table with production parameters."""

import hashlib
import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.fs import work_dir
from wardlake.llm import byte_bpe, embedding_dedup, fingerprint, hard_negatives, near_dedup, packing, periodic_runs, secret_scan, sharding, substring, token_files, toxicity, transcripts
from wardlake.llm.common import chunks, split_words
from wardlake.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

#: Folder of the public vocabulary files; the same on every machine.
TOKENIZERS = "/opt/tokenizers"
WORD_BPE = os.path.join(TOKENIZERS, "word_bpe_49k.json")
BYTE_BPE = os.path.join(TOKENIZERS, "byte_bpe_multi_50k.tiktoken")
#: Fixed value: the published pattern that splits text before byte-level merges.
PIECE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_crc32(df: DataFrame, column: str = "ids") -> DataFrame:
    """Replace a binary column by its unsigned crc32 as ``ids_crc32``."""
    kept = [f for f in df.schema.fields if f.name != column]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = pa.array([zlib.crc32(x) for x in batch.column(column).to_pylist()], pa.int64())
            names = [f.name for f in kept]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), crc], [*names, "ids_crc32"])

    return df.mapInArrow(run, schema)


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_crc32(packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, end_id=2))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=1)
    return with_crc32(token_files.read_tokens(spark, path))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_PATTERN)
    decoded = byte_bpe.decode(encoded, BYTE_BPE)
    hashes = {"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}
    return decoded.select("doc_id", "n_tokens", *(h.alias(n) for n, h in hashes.items()))


def op5_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = transcripts.as_transcripts(table(spark, sf_dir, "conversations"))
    model = transcripts.train(raw.filter(transcripts.in_training(F.col("conv_id"))))
    return transcripts.render(transcripts.parse(raw.drop("role"), model))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_markov")


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept, names = substring.remove_repeats(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            digests = [hashlib.sha256(b" ".join(split_words(t))).hexdigest() for t in texts]
            columns = [part.column(c) for c in ("doc_id", names["n_words"], names["n_removed"])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return kept.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op8_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(table(spark, sf_dir, "documents"))


def op9_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.similar_vectors(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sharding.with_text_size(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32")
    placed = sharding.assign(records, [1.0] * 16, more=[1.0])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op12_vertical_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents, by id, the words from some place on repeat with a period."""

    def planted(doc_id: int | None, text: bytes) -> bytes:
        h = zlib.crc32(str(doc_id).encode())
        words, g = text.split(), h // 10
        n = len(words)
        if doc_id is None or h % 10 or not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join([*words[:a], *(words[a + i % p] for i in range(n - a))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            ids = part.column("doc_id")
            out = pa.array([planted(i, t) for i, t in zip(ids.to_pylist(), texts)], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, out.cast(pa.string())], ["doc_id", "text"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, text string")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, names = periodic_runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    runs = F.col(names["runs"])
    # runs come by start and period, so the first of those that tie is the one wanted
    more = lambda b, r: b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"])
    best = F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda b, r: F.when(more(b, r), r).otherwise(b))
    lines = F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col(names["collapsed"]).cast("binary"), 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", "best.*", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (op1_curve_packing, op2_order_minhash, op3_token_files, op4_byte_bpe, op5_transcripts, op6_secret_scan, op7_substring, op8_quartile_digest, op9_small_world, op10_toxicity, op11_rendezvous_shards, op12_vertical_negatives, op13_periodic_runs)}
