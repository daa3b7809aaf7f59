"""Clean tables to analysis tables.

The functions do not sort: a sort before a write is lost work. ``ordered`` and ``top`` give
the reading order of each table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicewatch import schemas as S
from devicewatch.functions.columns import outcome_label, percentage, risk_tier
from devicewatch.functions.keywords import has_keyword, matched_keywords
from devicewatch.params import HIGH_RISK_KEYWORDS


def _sum_flag(flag: str) -> Column:
    return F.sum(F.col(flag).cast("int"))


def event_summary(events: DataFrame) -> DataFrame:
    """Report volume by year, month and event type."""
    return events.groupBy("year", "month", "event_type").agg(
        F.count("report_number").alias("report_count"),
        _sum_flag("is_adverse_event").alias("adverse_event_count"),
        _sum_flag("is_product_problem").alias("product_problem_count"))


def product_risk(events: DataFrame, one_row_per_report: bool = False) -> DataFrame:
    """Volume, adverse-event rate and risk tier by brand, generic name and device class.

    With ``one_row_per_report`` the caller vouches for distinct report numbers, as in the
    events table: the distinct count is then the plain count and needs no second shuffle.
    """
    unique = F.count("report_number") if one_row_per_report else F.countDistinct("report_number")
    return (
        events.groupBy("brand_name", "generic_name", "device_class")
        .agg(
            F.count("report_number").alias("total_reports"),
            _sum_flag("is_adverse_event").alias("adverse_events"),
            _sum_flag("is_product_problem").alias("product_problems"),
            unique.alias("unique_reports"),
            F.min("date_received").alias("first_report_date"),
            F.max("date_received").alias("last_report_date"))
        .withColumn("adverse_event_rate", percentage("adverse_events", "total_reports"))
        .withColumn("risk_tier", risk_tier("adverse_event_rate")))


def outcome_codes(events: DataFrame, *more: str) -> DataFrame:
    """One row per report and patient outcome code; a report without codes has one NULL.

    ``more`` columns of the events stay beside the code.
    """
    return events.select(
        "report_number", "year", *more,
        F.explode_outer(F.from_json("patient_outcome", S.OUTCOME_ARRAY)).alias("outcome_code"),
    ).withColumn("outcome_label", outcome_label("outcome_code"))


def outcome_breakdown(events: DataFrame) -> DataFrame:
    """Outcomes by year and label. A report counts once per outcome it lists."""
    return outcome_codes(events).groupBy("year", "outcome_label").agg(
        F.count("report_number").alias("report_count"))


#: What a flagged narrative says of its report.
REPORT_COLUMNS = ("report_number", "date_received", "brand_name", "generic_name", "event_type")


def flagged_narratives(narratives: DataFrame, events: DataFrame,
                       keywords: Sequence[str] = HIGH_RISK_KEYWORDS) -> DataFrame:
    """Narrative blocks that mention a keyword, with the report they belong to.

    The text is filtered before the join, so only hits are shuffled. Events are unique per
    report, and a report with very many hits is on the side an adaptive skew join can split.
    It does so where both sides are shuffled for the join: pass events as read from their
    table, as events straight from the deduplication are already partitioned.
    """
    hits = narratives.where(has_keyword("narrative_text", keywords)).select(
        "report_number", "text_type_code", "narrative_text",
        matched_keywords("narrative_text", keywords).alias("matched_keywords"))
    return hits.join(events.select(*REPORT_COLUMNS), "report_number", "left").select(
        *REPORT_COLUMNS, "text_type_code", "narrative_text", "matched_keywords")


def order_of(table: str) -> list[Column]:
    """The reading order of a gold table. Ties are broken, so a top n is reproducible.

    Narrative text enters as its digest: sort keys are sampled on the driver and stay small.
    The tie-breaks also let Spark split a date or report that many rows share; only identical
    copies stay together, which narratives of the latest versions have within one record.
    """
    def up(*names: str) -> list[Column]:
        return [F.col(n).asc_nulls_first() for n in names]

    def down(name: str) -> Column:
        return F.col(name).desc_nulls_last()

    if table == "event_summary":
        return up("year", "month", "event_type")
    if table == "product_risk":
        return [down("total_reports"), *up("brand_name", "generic_name", "device_class")]
    if table == "outcome_breakdown":
        return [*up("year"), down("report_count"), *up("outcome_label")]
    if table == "flagged_narratives":
        return [down("date_received"), *up("report_number", "text_type_code"),
                F.md5("narrative_text").asc_nulls_first()]
    raise ValueError(f"no order defined for {table!r}")


def ordered(df: DataFrame, table: str) -> DataFrame:
    """The table in its reading order."""
    return df.orderBy(*order_of(table))


def top(df: DataFrame, table: str, n: int = 20) -> DataFrame:
    """The first ``n`` rows in reading order, found per partition and then merged."""
    return ordered(df, table).limit(n)
