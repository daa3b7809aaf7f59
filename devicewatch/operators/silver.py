"""Flat raw layer to clean tables: one row per report, per device, per narrative block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicewatch import schemas as S
from devicewatch.functions.columns import is_yes, report_date
from devicewatch.operators.dedup import (
    VERSION,
    first_by,
    latest_reports,
    latest_unmoved,
    numbered_reports,
    recency,
)
from devicewatch.operators.flatten import with_record_hash


def _reports(bronze: DataFrame, quarantine_blank: bool) -> DataFrame:
    bronze = with_record_hash(bronze)
    return numbered_reports(bronze) if quarantine_blank else bronze


def events_silver(bronze: DataFrame, quarantine_blank: bool = True) -> DataFrame:
    """One row per report: latest version, typed dates, calendar parts, boolean flags."""
    return event_rows(latest_reports(_reports(bronze, quarantine_blank)))


def event_rows(reports: DataFrame, *more: str) -> DataFrame:
    """Raw reports as rows of the events table; ``more`` columns come after its own."""
    received = report_date("date_received")
    derived = {
        "date_received": received,
        "date_of_event": report_date("date_of_event"),
        "date_report": report_date("date_report"),
        "year": F.year(received),
        "month": F.month(received),
        "is_adverse_event": is_yes("adverse_event_flag"),
        "is_product_problem": is_yes("product_problem_flag"),
        "is_implant": is_yes("implant_flag"),
    }
    return reports.select(*[
        derived[name].alias(name) if name in derived else F.col(name)
        for name in S.EVENTS_SCHEMA.names], *more)


def devices_silver(bronze: DataFrame, latest_only: bool = True,
                   quarantine_blank: bool = True) -> DataFrame:
    """One row per report and device sequence number; a report without devices has one.

    ``latest_only`` takes the devices of the latest report version, the first listed winning.
    Otherwise devices of all versions count, the latest version of each winning.
    """
    narrow = _reports(bronze, quarantine_blank).select(*VERSION, "device_raw")
    return devices_of_each(latest_reports(narrow)) if latest_only else device_rows(narrow)


def device_rows(reports: DataFrame, *more: str) -> DataFrame:
    """The devices of raw reports, the latest report's first listed of each sequence number."""
    devices = reports.select(
        *VERSION, *more, F.posexplode_outer(F.from_json("device_raw", S.DEVICE_ARRAY))
        .alias("_position", "_device"))
    keys = ["report_number", "device_sequence_no"]
    kept = first_by(devices.withColumn("device_sequence_no", F.col("_device.device_sequence_no")),
                    keys, [*recency(), F.col("_position").asc_nulls_last()])
    return _device_columns(kept, *more)


def devices_of_each(reports: DataFrame, *more: str) -> DataFrame:
    """The same for reports of distinct numbers: chosen within each row, so that no row moves."""
    def number(device: Column) -> Column:
        # NULL numbers are equal, and no text.
        return F.coalesce(F.concat(F.lit("="), device["device_sequence_no"]), F.lit(""))

    listed = reports.withColumn("_listed", F.from_json("device_raw", S.DEVICE_ARRAY))
    numbers = F.transform("_listed", number)
    first = F.filter("_listed", lambda device, at:
                     F.array_position(numbers, number(device)) == at + 1)
    # One device, as most reports have, is the first of its number.
    kept = F.when(F.size("_listed") > 1, first).otherwise(F.col("_listed"))
    devices = listed.select(*VERSION, *more, F.explode_outer(kept).alias("_device"))
    return _device_columns(
        devices.withColumn("device_sequence_no", F.col("_device.device_sequence_no")), *more)


def _device_columns(devices: DataFrame, *more: str) -> DataFrame:
    return devices.select(
        "report_number",
        "_device.brand_name", "_device.generic_name",
        F.col("_device.manufacturer_d_name").alias("manufacturer_name"),
        "_device.model_number", "_device.catalog_number", "_device.lot_number",
        "device_sequence_no", "_device.implant_flag",
        F.col("_device.device_report_product_code").alias("product_code"),
        "_ingested_at", *more)


def narratives_silver(bronze: DataFrame, latest_only: bool = True,
                      quarantine_blank: bool = True) -> DataFrame:
    """One row per narrative block that has text (empty text counts, missing text does not).

    ``latest_only`` takes the blocks of the latest report version; otherwise every landed
    version adds its blocks. In neither case is the text shuffled, but that of exact copies.
    """
    narrow = _reports(bronze, quarantine_blank).select(
        *VERSION, "date_received", "mdr_text_raw")
    if latest_only:
        narrow = latest_unmoved(narrow, F.col("mdr_text_raw") != "[]")
    return narrative_rows(narrow)


def narrative_rows(reports: DataFrame, *more: str) -> DataFrame:
    """The narrative blocks of raw reports that have text."""
    # The text filter drops what an outer explode would add, so this is an inner one.
    blocks = reports.select(
        "report_number", report_date("date_received").alias("date_received"), "_ingested_at", *more,
        F.explode(F.from_json("mdr_text_raw", S.NARRATIVE_ARRAY)).alias("_block"))
    return blocks.select(
        "report_number", "date_received", "_block.text_type_code",
        F.col("_block.foi_text").alias("narrative_text"), "_block.mdr_text_key",
        "_ingested_at", *more).where(F.col("narrative_text").isNotNull())
