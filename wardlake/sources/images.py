"""Image files in a directory, and export of stored objects to files."""

import os
import re
import stat
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake import fs

#: Listed files in one file of a listing, which one task reads; bytes that leave Python at once.
FILES_TOGETHER, BYTES_TOGETHER = 1_000, 1 << 24
#: Paths that one read by Spark's own source names.
PATHS_AT_ONCE = 5_000
_LISTED = "path string, name string, length long, modified timestamp"


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Files directly in a directory, or one file, or those of a glob: path, name, length, modified, content.

    The bytes are read only when ``content`` is used. There is no row of an empty file, which is no
    image anyway, nor of a hidden one. A directory on disks that all executors reach is listed by a
    task into a table, so that the driver holds no file's status and a task reads many files;
    others, and globs, are read by Spark's own source.
    """
    if not fs.exists(spark, path):
        raise FileNotFoundError(f"no such image directory: {path}")
    # a glob names files, or directories whose files are meant
    if set(path) & set("*?[{") or fs.is_file(spark, path):
        return _named(spark.read.format("binaryFile").load(path))
    folder, shown = _shared_folder(spark, path), fs.qualified(spark, path).rstrip("/")
    if folder is not None:
        return _with_bytes(_in_many_files(_listing(spark, folder, shown)), folder, shown)
    parent = shown.split(":", 1)[-1].lstrip("/")
    files = spark.read.format("binaryFile").load(path)
    return _named(files.filter(F.regexp_replace(F.regexp_replace("path", r"^[a-z0-9]+:/*", ""), r"/[^/]*$", "") == parent))


def read_these(spark: SparkSession, path: str, files: DataFrame) -> DataFrame | None:
    """The given files of a directory, as ``read_images`` gives them; no other file is opened. None of no file."""
    folder = _shared_folder(spark, path)
    if folder is not None:
        listed = _in_many_files(files.select("path", "name", "length", "modified"))
        return None if listed.isEmpty() else _with_bytes(listed, folder, fs.qualified(spark, path).rstrip("/"))
    paths = (re.sub(r"([\\*?\[\]{}])", r"\\\1", r["path"]) for r in files.select("path").toLocalIterator())
    read = [_named(spark.read.format("binaryFile").load(some)) for some in iter(lambda: list(islice(paths, PATHS_AT_ONCE)), [])]
    return reduce(DataFrame.unionByName, read) if read else None


def _named(files: DataFrame) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    return files.select("path", name, "length", F.col("modificationTime").alias("modified"), "content")


def _shared_folder(spark: SparkSession, path: str) -> str | None:
    """Where a directory lies on disks that all executors reach, else None."""
    return fs.local_path(fs.resolved(spark, path)) if fs.all_reach(spark, path) else None


def _hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _listing(spark: SparkSession, folder: str, shown: str) -> DataFrame:
    """The files of a directory, listed by one task as its rows are asked for."""

    def files() -> Iterator[tuple]:
        with os.scandir(os.fsencode(folder)) as entries:
            for entry in entries:
                try:
                    name, state = entry.name.decode("utf-8"), entry.stat()
                except (FileNotFoundError, UnicodeDecodeError):  # Spark's own listing passes over these, too
                    continue
                if state.st_size and not stat.S_ISDIR(state.st_mode) and not _hidden(name):
                    yield f"{shown}/{name}", name, state.st_size, state.st_mtime_ns // 1_000_000 * 1000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            found = files()
            while some := list(islice(found, FILES_TOGETHER)):
                kinds = (pa.string(), pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"))
                columns = [pa.array(values, kind) for values, kind in zip(zip(*some), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["path", "name", "length", "modified"])

    return spark.range(0, 1, 1, 1).mapInArrow(run, _LISTED)


def _in_many_files(listed: DataFrame) -> DataFrame:
    """A listing written in small files, so that many tasks share the files it names."""
    spark = listed.sparkSession
    path = fs.work_dir(spark, "listing")
    listed.write.option("maxRecordsPerFile", FILES_TOGETHER).parquet(path)
    return spark.read.schema(_LISTED).parquet(path)


def _with_bytes(listed: DataFrame, folder: str, shown: str) -> DataFrame:
    """Add ``content`` to listed files: read on the executors, a bounded number of bytes at a time."""

    def read(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in paths:
            held, size = [], 0
            for path in some.to_pylist():
                with open(os.fsencode(folder + path[len(shown) :]), "rb") as file:
                    held.append(file.read())
                size += len(held[-1])
                if size >= BYTES_TOGETHER:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            yield pa.array(held, pa.binary())

    # never computed twice for a row, nor at all when it is not used
    content: Column = F.arrow_udf(read, "binary").asNondeterministic()("path")
    return listed.withColumn("content", content)


def export_blobs(blobs: DataFrame, target: str) -> DataFrame:
    """Write each object's bytes to ``target/<bucket>/<object_key>``; one result row per object.

    ``target`` is a folder all executors can reach; on a cluster a local one has to lie below the
    shared folder that ``spark.checkpoint.dir`` names. It is made here, and a task that does not
    see it fails. A key whose path would leave its bucket's folder fails the job. A retried task
    writes the same bytes to the same names, each through a draft and a rename, so no reader sees
    half a file.
    """
    spark = blobs.sparkSession
    if not fs.all_reach(spark, target):
        raise ValueError("executors of a cluster share no local folder but that of spark.checkpoint.dir")
    fs.make_dirs(spark, target)
    # Arrow knows the file systems, not the mount points of a view on them
    root = fs.resolved(spark, target).rstrip("/")
    local = fs.local_path(root)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs as arrow_fs

        if local is not None:
            system, base = arrow_fs.LocalFileSystem(), local
            if system.get_file_info(base).type != arrow_fs.FileType.Directory:
                raise FileNotFoundError(f"this executor does not see the target: {base}")
        else:
            system, base = arrow_fs.FileSystem.from_uri(root)
        for batch in batches:
            for bucket, key, content in zip(batch["bucket"], batch["object_key"], batch["content"]):
                steps = f"{bucket}/{key}".split("/")
                if not all(steps) or {".", ".."} & set(steps) or "/" in bucket:
                    raise ValueError(f"not a path below the target: {bucket}/{key}")
                folder, _, name = f"{base}/{bucket}/{key}".rpartition("/")
                system.create_dir(folder, recursive=True)
                draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as out:
                    out.write(content)
                system.move(draft, f"{folder}/{name}")
            sizes = batch["content"].map(len)
            yield pd.DataFrame({"bucket": batch["bucket"], "object_key": batch["object_key"], "bytes_written": sizes.astype("int64")})

    schema = "bucket string, object_key string, bytes_written long"
    return blobs.select("bucket", "object_key", "content").mapInPandas(write, schema)
