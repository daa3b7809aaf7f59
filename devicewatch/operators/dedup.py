"""Deterministic keep-the-latest deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicewatch import schemas as S


def recency() -> list[Column]:
    """Newest version first: fetch time, then report key, then content.

    Fetch times are compared as instants: as text, ``10:00:00Z`` would sort after
    ``10:00:00.5Z``. Report keys are compared as numbers where they are (``10`` is after ``9``);
    others come behind these, as text. Rows that tie on everything are copies of one record.
    """
    return [value.desc_nulls_last() for value in order_values()]


#: What tells the versions of a report apart.
VERSION = ("report_number", "_ingested_at", "mdr_report_key", S.RECORD_HASH)


def order_values() -> list[Column]:
    """What :func:`recency` orders by; as in it, NULL is the oldest."""
    return [
        F.try_to_timestamp("_ingested_at").alias("_time"), F.col("_ingested_at").alias("_text"),
        F.expr("try_cast(mdr_report_key AS DECIMAL(38, 0))").alias("_number"),
        F.col("mdr_report_key").alias("_key"), F.col(S.RECORD_HASH).alias("_hash"),
    ]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; NULL keys are equal.

    Spark limits the rank before the shuffle as well as after it, so a key that holds much
    of the data sends one row per input partition and not its whole group.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_reports(bronze: DataFrame) -> DataFrame:
    """One row per report number: its latest version."""
    return first_by(bronze, ["report_number"], recency())


def latest_unmoved(bronze: DataFrame, wanted: Column | None = None) -> DataFrame:
    """The rows of :func:`latest_reports`, for tables with wide columns: these are not shuffled.

    Versions are counted on their narrow key columns, and only report numbers with several rows
    take part in a join: theirs is the small side as long as few reports have several versions,
    and adaptive execution then sends it to the rows. Copies of one version are the one case in
    which rows have to meet; only these are. Of the latest rows, ``wanted`` tells which are
    returned: no others are joined.
    """
    # What versions are ordered by is made of them after their copies are counted, and names them.
    copies = bronze.groupBy(*VERSION).agg(F.count("*").alias("_copies"))
    winners = copies.groupBy("report_number").agg(
        F.max(F.struct(F.struct(*order_values()).alias("_version"), "_copies")).alias("_best"),
        F.sum("_copies").alias("_rows")
    ).where("_rows > 1").select(
        F.col("report_number").alias("_number"), F.lit(True).alias("_several"),
        F.col("_best._version._text").alias("_win_ingested_at"),
        F.col("_best._version._key").alias("_winmdr_report_key"),
        F.col("_best._version._hash").alias("_win" + S.RECORD_HASH),
        (F.col("_best._copies") > 1).alias("_copied"))
    rows = bronze if wanted is None else bronze.where(wanted)
    joined = rows.join(
        winners, F.col("report_number").eqNullSafe(F.col("_number")), "left")
    wins = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_win{c}")) for c in VERSION[1:]])
    alone = F.col("_several").isNull() | (wins & ~F.col("_copied"))
    single = joined.where(alone).select(*bronze.columns)
    copied = rows.join(winners.where("_copied"), F.col("report_number").eqNullSafe(
        F.col("_number"))).where(wins).select(*bronze.columns)
    return single.unionByName(latest_reports(copied))


def _is_numbered() -> Column:
    return F.coalesce(F.trim("report_number") != "", F.lit(False))


def numbered_reports(bronze: DataFrame) -> DataFrame:
    """Reports that carry a report number."""
    return bronze.where(_is_numbered())


def quarantined_reports(bronze: DataFrame) -> DataFrame:
    """Reports with a NULL or blank number: no version of anything, kept aside whole."""
    return bronze.where(~_is_numbered())
