"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devicewatch.sources.shared import shared_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the session's shared folder and read it back.

    What follows starts from files that every executor sees, so losing an executor costs the
    tasks that ran on it and nothing before them.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Places of a hash that samples are drawn from.
PLACES = 1 << 62


def places(wanted: int, there: int) -> int:
    """How many of ``PLACES`` draw about ``wanted`` of ``there`` rows: at least one, or all."""
    return PLACES if there <= wanted else max(1, PLACES * wanted // there)


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, once the memory that earlier tasks no longer use went back to the system.

    Python workers live from task to task, and would else hold the most that any task took.
    """
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        return run(batches)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(name: str) -> Column:
    """The text column, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
