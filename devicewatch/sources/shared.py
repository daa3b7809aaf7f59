"""Where intermediate tables go."""

from __future__ import annotations

import contextlib
import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

#: How tables are compressed. On reports, whose texts are much alike, to some 60 % of Spark's default.
CODEC = "zstd"
#: Rows that are moved at a time, about, where a table can be made slice by slice: a finished write
#: leaves no shuffle files, so they do not grow with the table.
SLICE_ROWS = 32_000_000


def slice_count(rows: int) -> int:
    """In how many slices so many rows are moved, at least one."""
    return max(1, math.ceil(rows / SLICE_ROWS))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``.

    Executors come and go, so the folder must be one that all of them see. Without the setting
    this is an error, but in a session that has no executors of its own (master ``local`` or
    ``local[n]``), where any folder is seen by all.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def writing(spark: SparkSession, partitions: int = 0) -> Iterator[None]:
    """While this is open, a finished write leaves no shuffle files behind.

    Spark else keeps them until the driver happens to collect its garbage, beside all that later
    steps write. ``partitions`` is how many partitions of a table a task may write side by side:
    up to that number, it need not sort its rows by them, through the disk where they are many.
    """
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if partitions:
        settings["spark.sql.maxConcurrentOutputFileWriters"] = str(partitions)
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def staged(df: DataFrame | Sequence[DataFrame], purpose: str) -> tuple[DataFrame, str]:
    """``df`` written to a new shared folder, as read from there, and the folder.

    Several of one schema are written one after the other, and read as one.
    """
    slices = [df] if isinstance(df, DataFrame) else df
    spark, schema = slices[0].sparkSession, slices[0].schema
    path = shared_folder(spark, purpose)
    for part in slices:
        with writing(spark):
            part.write.option("compression", CODEC).mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def move_folders(spark: SparkSession, source: str, path: str, prefix: str) -> None:
    """Rename the folders in ``source`` that begin so into ``path``, in place of their like there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, to = hadoop.Path(source), hadoop.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(to)
    for found in files.listStatus(at):
        name = found.getPath().getName()
        if name.startswith(prefix):
            final = hadoop.Path(to, name)
            files.delete(final, True)
            if not files.rename(found.getPath(), final):
                raise RuntimeError(f"{found.getPath()} could not be moved to {path}")
