"""Explicit schemas of every layer. Nothing is inferred from data."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Lineage columns stamped on every record when it is fetched.
STAMP_COLUMNS = ("_ingested_at", "_manufacturer_filter", "_date_from", "_date_to")

# One raw report. Nested fields are read as their JSON text, so no key the schema
# does not know is lost.
RAW_SCALARS = (
    "report_number", "mdr_report_key", "report_source_code",
    "date_received", "date_of_event", "date_report",
    "event_type", "adverse_event_flag", "product_problem_flag", "single_use_flag",
    "manufacturer_g_name",
)
RAW_NESTED = ("device", "patient", "mdr_text", "openfda")
RAW_SCHEMA = T.StructType(_strings(*RAW_SCALARS, *RAW_NESTED, *STAMP_COLUMNS))

CORRUPT = "_corrupt_record"
RUN_ID = "_run_id"
SOURCE_FILE = "_source_file"
RECORD_HASH = "_record_hash"
FETCHED_AT = "_fetched_at"

# A saved response of the source: hit count plus one page of records, or an error.
RESPONSE_SCHEMA = T.StructType([
    T.StructField("error", T.StructType(_strings("code", "message"))),
    T.StructField("meta", T.StructType([
        T.StructField("results", T.StructType([T.StructField("total", T.LongType())]))])),
    T.StructField("results", T.ArrayType(RAW_SCHEMA)),
])

# What the raw layer keeps of the classification, the first device and the first patient.
# Values that may be any JSON are parsed as variants, so that they keep their JSON type.
OPENFDA = T.StructType([T.StructField(n, T.VariantType()) for n in (
    "device_class", "regulation_number", "medical_specialty_description")])

FIRST_DEVICE = T.ArrayType(T.StructType([
    *_strings(
        "manufacturer_d_name", "manufacturer_d_country", "brand_name", "generic_name",
        "model_number", "catalog_number", "lot_number", "device_sequence_no",
        "device_event_key", "implant_flag", "device_report_product_code"),
    T.StructField("openfda", OPENFDA)]))

FIRST_PATIENT = T.ArrayType(T.StructType([
    T.StructField("sequence_number_outcome", T.VariantType()),
    *_strings("date_of_birth")]))

# The names of the source's fields and of the layers' columns.
DEVICE_ARRAY = T.ArrayType(T.StructType(_strings(
    "brand_name", "generic_name", "manufacturer_d_name", "model_number", "catalog_number",
    "lot_number", "device_sequence_no", "implant_flag",
    "device_report_product_code")))

NARRATIVE_ARRAY = T.ArrayType(T.StructType(_strings(
    "text_type_code", "foi_text", "mdr_text_key")))

OUTCOME_ARRAY = T.ArrayType(T.StringType())

BRONZE_COLUMNS = RAW_SCALARS + (
    "manufacturer_name", "manufacturer_country",
    "brand_name", "generic_name", "model_number", "catalog_number", "lot_number",
    "device_sequence_no", "device_event_key", "implant_flag",
    "product_code", "device_class", "regulation_number", "medical_specialty",
    "patient_outcome", "date_of_birth",
    "mdr_text_raw", "device_raw", "patient_raw",
) + STAMP_COLUMNS

BRONZE_SCHEMA = T.StructType(
    _strings(*BRONZE_COLUMNS, SOURCE_FILE)
    + [T.StructField(RECORD_HASH, T.LongType())]
    + _strings(RUN_ID))

CORRUPT_SCHEMA = T.StructType(_strings(SOURCE_FILE, CORRUPT, RUN_ID))

EVENTS_SCHEMA = T.StructType(
    _strings("report_number", "mdr_report_key", "report_source_code")
    + [T.StructField(n, T.DateType()) for n in ("date_received", "date_of_event", "date_report")]
    + _strings(
        "event_type", "adverse_event_flag", "product_problem_flag", "single_use_flag",
        "manufacturer_g_name", "manufacturer_name", "manufacturer_country",
        "brand_name", "generic_name", "model_number", "catalog_number", "lot_number",
        "implant_flag", "medical_specialty", "device_class", "regulation_number",
        "patient_outcome", "_ingested_at")
    + [T.StructField(n, T.IntegerType()) for n in ("year", "month")]
    + [T.StructField(n, T.BooleanType())
       for n in ("is_adverse_event", "is_product_problem", "is_implant")])

DEVICES_SCHEMA = T.StructType(_strings(
    "report_number", "brand_name", "generic_name", "manufacturer_name", "model_number",
    "catalog_number", "lot_number", "device_sequence_no", "implant_flag", "product_code",
    "_ingested_at"))

NARRATIVES_SCHEMA = T.StructType(
    _strings("report_number")
    + [T.StructField("date_received", T.DateType())]
    + _strings("text_type_code", "narrative_text", "mdr_text_key", "_ingested_at"))
