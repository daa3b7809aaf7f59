"""The latest version of every report, kept up to date by a stream of landed pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from devicewatch.operators.dedup import order_values
from devicewatch.operators.flatten import flatten
from devicewatch.sources.landing import refuse_corrupt, stream_pages
from devicewatch.sources.shared import CODEC, exists

_BATCH = "_batch"


def keep_latest(bronze: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``report_number`` and these columns of its latest version, of a stream or of a table.

    The choice is the one of :func:`devicewatch.operators.dedup.latest_reports`; reports without
    a number are one report. A stream's state is one row of these columns a report, reduced per
    task before its shuffle. Leave texts out, and keep the state in RocksDB
    (``spark.sql.streaming.stateStore.providerClass``) where it is larger than memory.
    """
    newest = F.max_by(F.struct(*columns), F.struct(*order_values()))
    return bronze.groupBy("report_number").agg(newest.alias("_row")).select(
        "report_number", "_row.*")


def follow_latest(spark: SparkSession, landing: str, target: str, checkpoint: str,
                  columns: Sequence[str], whole_file_pages: bool = False,
                  max_files_per_batch: int = 10_000) -> StreamingQuery:
    """Take in all pages landed since the last call with this checkpoint.

    Pages may come late and in any order: no version is dropped for its age. Each batch writes
    the reports it touched to a folder of its own, which a repeat after a failure replaces.
    What cannot be parsed stops the stream.
    """
    pages = stream_pages(spark, landing, whole_file_pages, max_files_per_batch)
    found = keep_latest(flatten(refuse_corrupt(pages)), columns)

    def save(rows: DataFrame, batch: int) -> None:
        (rows.write.option("compression", CODEC).mode("overwrite")
         .parquet(f"{target.rstrip('/')}/{_BATCH}={batch}"))

    return (found.writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """What :func:`follow_latest` keeps: one row a report, from the last batch that touched it."""
    if not exists(spark, target):
        raise ValueError(f"no batch was written to {target}")
    rows = spark.read.parquet(target)
    columns = [c for c in rows.columns if c not in ("report_number", _BATCH)]
    last = F.max_by(F.struct(*columns), _BATCH)
    return rows.groupBy("report_number").agg(last.alias("_row")).select(
        "report_number", "_row.*")
