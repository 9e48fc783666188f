"""Small helpers over the Hadoop file system of the session: metadata calls only, no data."""

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """True when the path, or at least one match of the glob, exists."""
    p, fs = _handle(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def exists_exactly(spark: SparkSession, path: str) -> bool:
    """True when there is a file or directory of this very name: no glob."""
    p, fs = _handle(spark, path)
    return fs.exists(p)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 of the last change; 0 when there is no such file."""
    p, fs = _handle(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000 if fs.exists(p) else 0.0


def touch(spark: SparkSession, path: str) -> None:
    p, fs = _handle(spark, path)
    fs.setTimes(p, int(time.time() * 1000), -1)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename to a name that is free; fails when the source is gone."""
    s, fs = _handle(spark, source)
    t, _ = _handle(spark, target)
    if not fs.exists(s) or not fs.rename(s, t):
        raise FileNotFoundError(source)


def is_file(spark: SparkSession, path: str) -> bool:
    p, fs = _handle(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the direct children but hidden ones; empty when there is no directory."""
    p, fs = _handle(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in found if not n.startswith("."))


def qualified(spark: SparkSession, path: str) -> str:
    p, fs = _handle(spark, path)
    return fs.makeQualified(p).toString()


def resolved(spark: SparkSession, path: str) -> str:
    """Where a path really lies, behind the mount points of a view; its last steps need not exist."""
    p, fs = _handle(spark, path)
    p, rest = fs.makeQualified(p), ""
    while not fs.exists(p) and p.getParent() is not None:
        p, rest = p.getParent(), f"/{p.getName()}{rest}"
    return fs.resolvePath(p).toString().rstrip("/") + rest


def local_path(path: str) -> str | None:
    """The plain path of one on this machine's own file system, else None."""
    return os.path.normpath("/" + path[len("file:") :].lstrip("/")) if path.startswith("file:") else None


def checkpoint_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def all_reach(spark: SparkSession, path: str) -> bool:
    """True unless executors of a cluster may see another folder of this name than the driver.

    Those of a cluster share no local folder but the one that ``spark.checkpoint.dir`` names and
    what lies below it.
    """
    place = local_path(resolved(spark, path))
    if place is None or spark.sparkContext.master.startswith("local"):
        return True
    named = checkpoint_folder(spark)
    shared = local_path(resolved(spark, named)) if named else None
    return shared is not None and os.path.commonpath([shared, place]) == shared


def make_dirs(spark: SparkSession, path: str) -> None:
    p, fs = _handle(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _handle(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, replacing an older namesake."""
    s, fs = _handle(spark, source)
    t, _ = _handle(spark, target)
    fs.mkdirs(t.getParent())
    if fs.exists(t):
        fs.delete(t, True)
    if not fs.rename(s, t):
        raise OSError(f"could not move {source} to {target}")


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a small file at once; fails when the target already exists.

    On a local disk a hard link, which is refused for an existing name; elsewhere a rename, which
    the file system has to refuse in that case.
    """
    p, fs = _handle(spark, path)
    fs.mkdirs(p.getParent())
    draft, _ = _handle(spark, f"{p.getParent().toString()}/.{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.getScheme() == "file":
        try:
            os.link(draft.toUri().getPath(), p.toUri().getPath())
        finally:
            fs.delete(draft, False)
    elif fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _handle(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside the block.

    Jobs that other threads of the same session start meanwhile see them, too.
    """
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``. A temporary folder of this
    machine is taken only by a local session that names none, as in tests.
    """
    base = checkpoint_folder(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="wardlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{str(base).rstrip('/')}/{label}-{uuid.uuid4().hex}"
