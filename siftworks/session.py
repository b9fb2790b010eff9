"""Folders that all executors share, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where that is unset, a local one if everything runs on this machine, as in
    tests; on a cluster that would lose data, so it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not found:
        held = context._jsc.sc().getCheckpointDir()
        if held.isEmpty():
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir isn't set: it has to name a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="siftworks-"))
            held = context._jsc.sc().getCheckpointDir()
        found = held.get()
    return found.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/siftworks/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a checkpoint in the shared folder, so that a lost executor loses nothing of it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def there(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_small(spark: SparkSession, path: str) -> str | None:
    """A small file's text; null if it isn't there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file as a whole: written beside and renamed, so that readers see the old text or the new."""
    jvm = spark.sparkContext._jvm
    at, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.rename(beside, at):  # most stores don't rename onto a file that is there
        files.delete(at, False)
        if not files.rename(beside, at):
            raise OSError(f"{path} couldn't be written")


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def bytes_in(spark: SparkSession, path: str) -> int:
    """Of all files below a folder; 0 if it isn't there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(at).getLength() if files.exists(at) else 0


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in files.listStatus(at) if x.isDirectory()]
