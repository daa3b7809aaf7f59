"""Raw nested reports to the flat raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicewatch import schemas as S
from devicewatch.functions.columns import json_list, variant_json


def flatten(raw: DataFrame) -> DataFrame:
    """One flat row of text columns per raw report.

    Device and patient columns come from the first array element; a missing, null or empty
    array, or a null element, leaves them NULL. Classification is looked up on the report and,
    where absent, in the first device. Arrays are kept whole as JSON text for the next layer.
    """
    first = with_record_hash(raw).select(
        "*",
        F.get(F.from_json("device", S.FIRST_DEVICE), F.lit(0)).alias("_dev"),
        F.get(F.from_json("patient", S.FIRST_PATIENT), F.lit(0)).alias("_pat"),
        F.from_json("openfda", S.OPENFDA).alias("_top"))

    def classified(field: str) -> Column:
        return json_list(F.coalesce(variant_json(F.col(f"_top.{field}")),
                                    variant_json(F.col(f"_dev.openfda.{field}"))))

    return first.select(
        *S.RAW_SCALARS,
        F.col("_dev.manufacturer_d_name").alias("manufacturer_name"),
        F.col("_dev.manufacturer_d_country").alias("manufacturer_country"),
        "_dev.brand_name", "_dev.generic_name", "_dev.model_number", "_dev.catalog_number",
        "_dev.lot_number", "_dev.device_sequence_no", "_dev.device_event_key",
        "_dev.implant_flag",
        F.col("_dev.device_report_product_code").alias("product_code"),
        classified("device_class").alias("device_class"),
        classified("regulation_number").alias("regulation_number"),
        classified("medical_specialty_description").alias("medical_specialty"),
        json_list(variant_json(F.col("_pat.sequence_number_outcome"))).alias("patient_outcome"),
        "_pat.date_of_birth",
        json_list(F.col("mdr_text")).alias("mdr_text_raw"),
        json_list(F.col("device")).alias("device_raw"),
        json_list(F.col("patient")).alias("patient_raw"),
        *S.STAMP_COLUMNS,
        *[c for c in (S.SOURCE_FILE, S.RUN_ID, S.CORRUPT) if c in raw.columns],
        S.RECORD_HASH)


def with_record_hash(reports: DataFrame) -> DataFrame:
    """Adds a content hash of the report, if absent: the last tie-break between versions.

    Ingest stores it, so that later layers need not read the whole report to compare two.
    """
    if S.RECORD_HASH in reports.columns:
        return reports
    # xxhash64 skips NULLs; the marker keeps (NULL, x) and (x, NULL) apart.
    content = [F.coalesce(F.col(c), F.lit("\u0001")) for c in reports.columns
               if c in S.RAW_SCHEMA.names or c in S.BRONZE_COLUMNS]
    return reports.withColumn(S.RECORD_HASH, F.xxhash64(*content))


def null_to_empty(bronze: DataFrame) -> DataFrame:
    """Empty text instead of NULL in every text column."""
    texts = [f.name for f in bronze.schema.fields if isinstance(f.dataType, T.StringType)]
    return bronze.fillna("", subset=texts)
