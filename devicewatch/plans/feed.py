"""Raw adverse-event reports derived from the star-schema and text tables.

Every line item is one submitted version of its order's report, and every document or
conversation turn one submission with narrative blocks. A report's versions stay separate
rows, as the source lands them, so no group is ever collected. Values that real reports get
wrong (dates in another layout, blank flags, missing arrays) follow from column values.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicewatch import schemas as S
from devicewatch.operators.dedup import latest_reports
from devicewatch.operators.flatten import flatten, with_record_hash
from devicewatch.operators.search import stamp
from devicewatch.params import JobParams
from devicewatch.sources.landing import record_json
from devicewatch.sources.shared import slice_count, staged, writing

# The search the derived reports are stamped with and, in the search queries, filtered by.
PARAMS = JobParams(
    manufacturer="Supplier#00000000", date_from="1996-01-01", date_to="1998-12-31",
    run_id="run_reports")
TEXT_PARAMS = dataclasses.replace(PARAMS, run_id="run_texts")
# Records that a row of pages holds at most.
PAGE_RECORDS = 2_000
# Pages that a task makes, about: Spark collects up to 128 groups without a sort of their rows.
_TASK_PAGES = 64
# Rows of a table that is sent to the lines, not joined by a shuffle: some 80 MB of suppliers.
SENT_ROWS = 1_000_000
# Numbers of a page.
_PAGE_NUMBERS = 200
# Terms that occur in the document and conversation texts.
TEXT_KEYWORDS = ("license", "free", "Apache", "death", "mit ", "copyright")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(column: str, pattern: str = "yyyyMMdd") -> Column:
    return F.date_format(F.col(column).cast("date"), pattern)


def _received() -> Column:
    """Receipt date as text; some partial orders carry another layout or none."""
    partial = F.col("o_orderstatus") == "P"
    return (F.when(partial & (F.col("o_orderpriority") == "5-LOW"), "")
            .when(partial & (F.col("o_orderpriority") == "4-NOT SPECIFIED"),
                  _day("o_orderdate", "yyyy-MM-dd"))
            .otherwise(_day("o_orderdate")))


@dataclasses.dataclass(frozen=True)
class Slice:
    """Order numbers from ``start`` on and below ``end``, whatever their sign; None is no bound.

    Without ``start``, NULL is among them. Bounds are those of pages.
    """

    start: int | None = None
    end: int | None = None

    def holds(self, key: str) -> Column:
        # Written out for both signs: so it can be held against the statistics of files.
        number, start, end = F.col(key), self.start, self.end
        if start is None:
            return ((number > -end) & (number < end)) | number.isNull()
        if end is None:
            return (number >= start) | (number <= -start)
        return (((number >= start) & (number < end)) | ((number <= -start) & (number > -end)))


#: All order numbers.
WHOLE = Slice()


def slices(spark: SparkSession, sf_dir: str) -> list[Slice]:
    """Slices of a like number of line items that together hold every order and line once.

    An order is in one slice, and so is a page. One order with many lines is not cut.
    """
    keys = table(spark, sf_dir, "lineitem").select(F.abs("l_orderkey").alias("key"))
    wanted = slice_count(keys.count())
    if wanted < 2:
        return [WHOLE]
    found = keys.agg(F.percentile_approx("key", [i / wanted for i in range(1, wanted)])
                     .alias("cuts")).first()["cuts"] or []
    cuts = sorted({-(-cut // _PAGE_NUMBERS) * _PAGE_NUMBERS for cut in found} - {0})
    if not cuts:
        return [WHOLE]
    return [Slice(*ends) for ends in zip([None, *cuts], [*cuts, None], strict=True)]


def _sliced(df: DataFrame, key: str, within: Slice) -> DataFrame:
    return df if within == WHOLE else df.where(within.holds(key))


def _lines(spark: SparkSession, sf_dir: str, within: Slice = WHOLE) -> DataFrame:
    return _sliced(table(spark, sf_dir, "lineitem").drop("l_discount", "l_tax"), "l_orderkey",
                   within)


def _orders(spark: SparkSession, sf_dir: str, within: Slice = WHOLE) -> DataFrame:
    return _sliced(table(spark, sf_dir, "orders").drop("o_totalprice"), "o_orderkey", within)


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few enough, they are sent to the lines, which then stay where they are.

    Not in a session that has broadcasts turned off.
    """
    suppliers = table(spark, sf_dir, "supplier").drop("s_acctbal")
    sent = not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return F.broadcast(suppliers) if sent and suppliers.count() <= SENT_ROWS else suppliers


def _orders_with_lines(spark: SparkSession, sf_dir: str, parts_last: bool = False,
                       within: Slice = WHOLE) -> DataFrame:
    """Each line with its order.

    Orders without lines come from an anti join, not from one outer join for all: Spark can split
    a skewed key of the line side only in an inner join. The lines of an order end in one task, so
    that most versions of a report are dropped there. With ``parts_last`` those of a part do: what
    is joined is moved by all later joins, and names of parts are long.
    """
    def described(lines: DataFrame) -> DataFrame:
        return (
            lines.join(_suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .join(table(spark, sf_dir, "nation"),
                  F.col("s_nationkey") == F.col("n_nationkey"), "left"))

    def with_parts(lines: DataFrame) -> DataFrame:
        return lines.join(table(spark, sf_dir, "part").drop("p_retailprice"),
                          F.col("l_partkey") == F.col("p_partkey"), "left")

    lines, orders = _lines(spark, sf_dir, within), _orders(spark, sf_dir, within)
    of_order = F.col("o_orderkey") == F.col("l_orderkey")
    if parts_last:
        return with_parts(described(orders.join(lines, of_order)))
    return orders.join(described(with_parts(lines)), of_order)


def _orders_without_lines(spark: SparkSession, sf_dir: str, within: Slice = WHOLE) -> DataFrame:
    known = _lines(spark, sf_dir, within).select("l_orderkey").distinct()
    return _orders(spark, sf_dir, within).join(
        known, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


def device_reports(spark: SparkSession, sf_dir: str, tasks: int = 0, parts_last: bool = False,
                   within: Slice = WHOLE) -> DataFrame:
    """Raw reports with devices and patients: one per line item or order without lines.

    With ``tasks``, they lie by ``page``: what they are made of is dealt out, not the reports. With
    ``parts_last``, reports on a part lie together: for queries that keep all versions. ``within``
    is a slice of their numbers.
    """
    number = F.col("o_orderkey").cast("string")
    lines, orders = (_by_page(df, number, tasks) for df in (
        _orders_with_lines(spark, sf_dir, parts_last, within),
        _orders_without_lines(spark, sf_dir, within)))
    return _line_reports(lines).unionByName(_order_reports(orders))


def _by_page(df: DataFrame, number: Column, tasks: int) -> DataFrame:
    return df.withColumn("page", page_number(number)).repartition(tasks, "page") if tasks else df


def _problem_flag() -> Column:
    return F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Y").otherwise("N")


def _stamped(df: DataFrame, given: dict[str, Column], fetched: str, source: str) -> DataFrame:
    raw = df.select(
        *[given.get(n, F.lit(None).cast("string")).alias(n)
          for n in S.RAW_SCALARS + S.RAW_NESTED],
        F.date_format(F.expr(fetched).cast("date"), "yyyy-MM-dd'T00:00:00Z'").alias("_fetched"),
        F.lit(source).alias(S.SOURCE_FILE), *[c for c in df.columns if c == "page"])
    return stamp(raw, PARAMS, F.col("_fetched")).drop("_fetched")


def _line_reports(submissions: DataFrame) -> DataFrame:
    # One Java method makes all of a report: the JVM compiles it only up to 8000 bytes, and beyond
    # that interprets it for every row. So nothing here is written out twice.
    returned = F.col("l_returnflag") == "R"
    in_device = F.col("l_linestatus") == "F"
    key = F.concat_ws(
        "-", "l_linenumber", "l_partkey", "l_suppkey",
        F.floor("l_quantity").cast("string"),
        F.floor(F.col("l_extendedprice") * 100).cast("string"), "l_returnflag", "l_linestatus")
    device_class = (F.when(F.col("p_size") <= 9, "1").when(F.col("p_size") <= 25, "2")
                    .otherwise("3"))
    openfda = F.struct(
        F.array(device_class).alias("device_class"),
        F.array(F.concat(F.lit("880."), "p_size")).alias("regulation_number"),
        F.col("p_type").alias("medical_specialty_description"))
    main = F.struct(
        F.col("s_name").alias("manufacturer_d_name"),
        F.col("n_name").alias("manufacturer_d_country"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("generic_name"),
        F.col("p_name").alias("model_number"),
        F.col("l_partkey").cast("string").alias("catalog_number"),
        F.concat(F.lit("LOT-"), "l_suppkey").alias("lot_number"),
        F.col("l_linenumber").cast("string").alias("device_sequence_no"),
        F.col("_key").alias("device_event_key"),
        F.when(F.col("l_returnflag") == "A", "Y").otherwise("N").alias("implant_flag"),
        F.substring("p_type", 1, 3).alias("device_report_product_code"),
        F.when(in_device, openfda).alias("openfda"))
    # Returned items list an accessory, for some under the sequence number of the device.
    accessory = (
        main.withField("generic_name", F.lit("ACCESSORY"))
        .withField("device_sequence_no", F.when(in_device, F.col("l_linenumber"))
                   .otherwise(F.col("l_linenumber") + 7).cast("string")))
    devices = F.when(returned, F.array(main, accessory)).otherwise(F.array(main))
    first_code = F.col("l_linenumber").cast("string")
    second_code = F.floor(F.col("l_quantity") / 5).cast("string")
    patient = F.array(F.struct(
        F.when(in_device, F.array(first_code, second_code))
        .otherwise(F.array(first_code)).alias("sequence_number_outcome"),
        _day("o_orderdate", "yyyy").alias("date_of_birth")))
    given = {
        "report_number": F.col("o_orderkey").cast("string"),
        "mdr_report_key": F.when(
            in_device, (F.col("l_partkey") * 10 + F.col("l_linenumber")).cast("string"))
        .otherwise(F.col("_key")),
        "report_source_code": F.when(in_device, "User Facility report")
        .otherwise("Manufacturer report"),
        "date_received": _received(),
        "date_of_event": F.when(F.col("l_returnflag") == "N", _day("l_shipdate", "yyyyMM"))
        .otherwise(_day("l_shipdate")),
        "date_report": _day("l_shipdate"),
        "event_type": F.when(returned, "Injury").when(F.col("l_returnflag") == "A", "Malfunction")
        .when(F.col("l_returnflag") == "N", "Death").otherwise("No answer provided"),
        "adverse_event_flag": F.when(F.col("l_quantity") <= F.col("p_size"), "Y")
        .when(in_device & (F.col("l_returnflag") == "N"), "").otherwise("N"),
        "product_problem_flag": _problem_flag(),
        "single_use_flag": F.when(in_device, "Y").otherwise("N"),
        "manufacturer_g_name": F.col("s_name"),
        "device": F.to_json(devices),
        "patient": F.when(F.col("l_returnflag") != "N", F.to_json(patient)),
        "openfda": F.when(~in_device, F.to_json(openfda))}
    return _stamped(submissions.withColumn("_key", key), given,
                    "coalesce(l_shipdate, o_orderdate)", "tables/lineitem")


def _order_reports(orders: DataFrame) -> DataFrame:
    given = {
        "report_number": F.col("o_orderkey").cast("string"),
        "mdr_report_key": F.lit("initial"),
        "date_received": _received(),
        "event_type": F.lit("No answer provided"),
        "product_problem_flag": _problem_flag()}
    return _stamped(orders, given, "o_orderdate", "tables/orders")


def _text_report(df: DataFrame, number: Column, key: Column, received: Column, blocks: Column,
                 fetched: Column, source: str) -> DataFrame:
    given = {"report_number": number, "mdr_report_key": key, "date_received": received,
             "mdr_text": F.to_json(blocks)}
    raw = df.select(
        *[given.get(n, F.lit(None).cast("string")).alias(n)
          for n in S.RAW_SCALARS + S.RAW_NESTED],
        F.lit(source).alias(S.SOURCE_FILE), fetched.alias("_fetched"))
    return stamp(raw, TEXT_PARAMS, F.col("_fetched")).drop("_fetched")


def text_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reports with narratives: documents line by line, conversations turn by turn.

    A document belongs to the order of its number. Each turn is a version of its conversation's
    report, fetched with the others: its number, the report key, decides which is the latest. Blank lines are blocks without text.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").join(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"),
        F.col("doc_id") == F.col("o_orderkey"), "left")
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        F.when(i == 0, "Description of Event or Problem")
        .otherwise("Additional Manufacturer Narrative").alias("text_type_code"),
        F.nullif(line, F.lit("")).alias("foi_text"),
        F.concat_ws("-", "doc_id", i.cast("string")).alias("mdr_text_key")))
    from_documents = _text_report(
        documents, F.col("doc_id").cast("string"), F.col("lang"), _received(), lines,
        F.lit("2002-01-01T00:00:00Z"), "tables/documents")
    turns = table(spark, sf_dir, "conversations")
    one_block = F.array(F.struct(
        F.col("role").alias("text_type_code"), F.col("text").alias("foi_text"),
        F.concat_ws("-", "conv_id", "turn").alias("mdr_text_key")))
    from_turns = _text_report(
        turns, F.concat(F.lit("C"), "conv_id"), F.col("turn").cast("string"),
        F.lit(None).cast("string"), one_block,
        F.lit("2002-02-01T00:00:00Z"), "tables/conversations")
    return from_documents.unionByName(from_turns)


def reports(spark: SparkSession, sf_dir: str, tasks: int = 0,
            within: Slice = WHOLE) -> DataFrame:
    """All raw reports, without the columns that only landed pages have.

    With ``tasks``, they have their ``page``, and all of a page lie in one of so many partitions.
    ``within`` is a slice of the device reports; the narrative reports are in the first.
    """
    columns = [*S.RAW_SCHEMA.names, S.RUN_ID, *(["page"] if tasks else [])]
    devices = device_reports(spark, sf_dir, tasks, parts_last=True, within=within).select(*columns)
    if within.start is not None:
        return devices
    texts = _by_page(text_reports(spark, sf_dir), F.col("report_number"), tasks)
    return devices.unionByName(texts.select(*columns))


def page_number(number: Column | None = None) -> Column:
    """The page of a report: two hundred consecutive numbers.

    Their versions are about as many records as the source sends in a page at most.
    """
    number = F.col("report_number") if number is None else number
    return F.floor(F.regexp_extract(number, r"(\d+)", 1).cast("long") / _PAGE_NUMBERS)


def pages(spark: SparkSession, sf_dir: str, most: int = PAGE_RECORDS,
          within: Slice = WHOLE) -> DataFrame:
    """All raw reports by page: ``_run_id``, ``page``, ``records`` (a JSON array) and ``count``.

    A page holds the reports of two hundred consecutive numbers, in the order of their text. One
    of more than ``most`` records is dealt out and cut into rows of ``most`` at most. The records
    of all others are made where their page is: they are many times what they are made of.
    ``within`` is as in :func:`reports`.
    """
    rows = reports(spark, sf_dir, 0, within).select(
        S.RUN_ID, page_number().alias("page"), record_json().alias("record"))
    keys = [S.RUN_ID, "page"]
    # Written: a table of known size, mostly small, is sent to the records and does not move them.
    large, _ = staged(
        rows.groupBy(*keys).agg(F.count("*").alias("count")).where(F.col("count") > most)
        .select(F.col(S.RUN_ID).alias("_run"), F.col("page").alias("_page"),
                F.ceil(F.col("count") / (most / 2)).alias("_parts")), "large")
    numbers = _orders(spark, sf_dir, within).select(
        page_number(F.col("o_orderkey").cast("string")))
    with writing(spark):
        found = numbers.distinct().count()
    placed = reports(spark, sf_dir, max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(found / _TASK_PAGES)),
        within)
    if "page" not in placed.columns:
        placed = placed.withColumn("page", page_number())
    of_large = (F.col(S.RUN_ID).eqNullSafe(F.col("_run"))
                & F.col("page").eqNullSafe(F.col("_page")))
    hot = not large.isEmpty()
    if hot:
        placed = placed.join(large, of_large, "left_anti")
    small = _arrays(placed.select(*keys, record_json().alias("record")), keys)
    if not hot:
        return small
    # Equal records are dealt out by the task they come from.
    dealt = F.xxhash64("record", F.spark_partition_id())
    rows = rows.withColumn("_dealt", dealt).join(large, of_large).select(
        *keys, "record", F.pmod("_dealt", "_parts").alias("_part"))
    place = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("record"))
    rows = rows.withColumn("_cut", F.floor((place - 1) / most))
    return small.unionByName(_arrays(rows, [*keys, "_part", "_cut"]).drop("_part", "_cut"))


def _arrays(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The records of each key as one JSON array."""
    return rows.groupBy(*keys).agg(
        F.concat(F.lit("[\n"), F.array_join(F.sort_array(F.collect_list("record")), ",\n"),
                 F.lit("\n]")).alias("records"), F.count("*").alias("count"))


#: The columns that name a version of a report.
KEY_SCHEMA = T.StructType([T.StructField(n, T.StringType())
                           for n in ("report_number", "mdr_report_key")])


def fetched_before(year: int) -> Column:
    """Whether a report was fetched before this year."""
    return F.substring("_ingested_at", 1, 4) < str(year)


def device_bronze(spark: SparkSession, sf_dir: str, parts_last: bool = False,
                  within: Slice = WHOLE) -> DataFrame:
    """The device reports, flattened."""
    return flatten(device_reports(spark, sf_dir, parts_last=parts_last, within=within))


def latest_device_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device reports of which no later version is there, flattened.

    For queries on the latest versions: these are told by columns of the raw report, so the others
    need not be flattened.
    """
    return flatten(latest_reports(with_record_hash(device_reports(spark, sf_dir))))


def text_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrative reports, flattened."""
    return flatten(text_reports(spark, sf_dir))
