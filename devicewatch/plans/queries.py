"""The registered queries: each operator on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicewatch import schemas as S
from devicewatch.functions.columns import report_date
from devicewatch.functions.keywords import flagged_by_table, has_keyword, matched_keywords
from devicewatch.operators import gold, silver
from devicewatch.operators.audit import layer_counts, run_files, run_summary
from devicewatch.operators.dedup import latest_reports
from devicewatch.operators.flatten import flatten, null_to_empty
from devicewatch.operators.search import (
    count_matching,
    fetch_ranges,
    missing_pages,
    page_plan,
    search,
)
from devicewatch.plans import feed, incremental
from devicewatch.plans.layers import (
    GOLD_TABLES,
    PARTITIONS,
    SILVER_SCHEMAS,
    Locations,
    check_total,
    gold_tables,
    load_pages,
    refresh_gold,
    refresh_silver,
    write_clean,
)
from devicewatch.sources import landing, tables, versions
from devicewatch.sources.shared import shared_folder, writing
from devicewatch.streaming.ingest import ingest_new_pages
from devicewatch.streaming.latest import follow_latest, read_latest

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a lazy plan."""
    return silver.events_silver(feed.latest_device_bronze(spark, sf_dir))


# --- raw layer ---------------------------------------------------------------------------

def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports that match a manufacturer phrase and a date range."""
    hits = search(feed.device_reports(spark, sf_dir), feed.PARAMS)
    return hits.select("report_number", "mdr_report_key", "date_received",
                       "_manufacturer_filter", "_date_from", "_date_to")


def matching_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many reports match the search."""
    return count_matching(search(feed.device_reports(spark, sf_dir), feed.PARAMS))


def page_plan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages a fetch of all reports consists of."""
    return page_plan(feed.device_reports(spark, sf_dir), feed.PARAMS.page_limit)


def bronze_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device reports as flat text rows."""
    return feed.device_bronze(spark, sf_dir).drop(S.RECORD_HASH)


def bronze_flatten_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrative reports as flat text rows."""
    return feed.text_bronze(spark, sf_dir).drop(S.RECORD_HASH, S.SOURCE_FILE)


def null_to_empty_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows with empty text instead of NULL."""
    return null_to_empty(feed.device_bronze(spark, sf_dir)).drop(S.RECORD_HASH)


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three report dates, NULL where the text is no date."""
    return feed.device_reports(spark, sf_dir).select(
        "report_number", "mdr_report_key",
        *[report_date(c).alias(c) for c in ("date_received", "date_of_event", "date_report")])


def _flat(pages: DataFrame) -> DataFrame:
    return flatten(landing.refuse_corrupt(pages)).drop(S.RECORD_HASH, S.SOURCE_FILE)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = shared_folder(spark, "landing")
    for within in feed.slices(spark, sf_dir):
        landing.write_pages(feed.device_reports(spark, sf_dir, parts_last=True, within=within),
                            path, feed.PARAMS, codec=landing.PACKED)
    landing.write_pages(feed.text_reports(spark, sf_dir), path, feed.TEXT_PARAMS,
                        codec=landing.PACKED)
    return path


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports landed as page files, read back and flattened."""
    return _flat(landing.read_pages(spark, _landed(spark, sf_dir)))


def landing_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of the file stream."""
    bronze = shared_folder(spark, "bronze")
    ingest_new_pages(spark, _landed(spark, sf_dir), bronze,
                     shared_folder(spark, "offsets")).awaitTermination()
    return tables.read_bronze(spark, bronze).drop(S.RECORD_HASH, S.SOURCE_FILE)


def _array_pages(spark: SparkSession, sf_dir: str) -> str:
    """All reports as a page-by-page client saves them: one JSON array a file, a folder a page."""
    path = shared_folder(spark, "pages")
    for within in feed.slices(spark, sf_dir):
        pages = feed.pages(spark, sf_dir, within=within).select(S.RUN_ID, "page", "records")
        with writing(spark):
            (pages.write.partitionBy(S.RUN_ID, "page").option("maxRecordsPerFile", 1)
             .option("compression", landing.PACKED).mode("append").text(path))
    return path


def array_pages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports from saved array pages."""
    path = _array_pages(spark, sf_dir)
    return _flat(landing.read_pages(spark, path, whole_file_pages=True))


def responses_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports from saved responses, as many as the responses announce."""
    path, parts = shared_folder(spark, "responses"), feed.slices(spark, sf_dir)
    with writing(spark):
        total = sum(feed.reports(spark, sf_dir, within=within).count() for within in parts)

    def save(bodies: DataFrame) -> None:
        with writing(spark):
            (bodies.write.option("maxRecordsPerFile", 1).option("compression", landing.PACKED)
             .mode("append").text(path))

    for within in parts:
        save(feed.pages(spark, sf_dir, within=within).select(F.concat(
            F.lit(f'{{"meta":{{"results":{{"total":{total}}}}},"results":'), "records",
            F.lit("}")).alias("value")))
    save(spark.range(1).select(
        F.lit(f'{{"error":{{"code":"NOT_FOUND","message":"{landing.NO_MATCH}"}}}}').alias("value")))
    records = landing.read_responses(spark, path)
    check_total(records, landing.reported_total(spark, path))
    return flatten(records).drop(S.RECORD_HASH, S.SOURCE_FILE)


def corrupt_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrative reports of which some were cut off: what was read, what was kept aside, counts.

    Half of the pages cut off are fetched again, whole, and the run is loaded anew.
    """
    base = shared_folder(spark, "corrupt")
    at = Locations(f"{base}/landing", f"{base}/bronze", f"{base}/silver/", f"{base}/gold/")
    line, number = landing.record_json(), F.regexp_extract("report_number", r"(\d+)", 1)
    cut = F.substring(line, F.lit(1), F.floor(F.length(line) * 0.6).cast("int"))
    params = feed.TEXT_PARAMS
    for every in (7, 14):
        (feed.text_reports(spark, sf_dir)
         .select(F.when(number.cast("long") % every == every - 7, cut).otherwise(line)
                 .alias("value"))
         .write.mode("overwrite").option("compression", landing.PACKED)
         .text(landing.run_folder(at.landing, params.run_id)))
        load_pages(landing.read_pages(spark, at.landing), at)
    kept = tables.read_bronze(spark, at.bronze)
    aside = tables.read_run(spark, at.corrupt, params.run_id, S.CORRUPT_SCHEMA)
    summary = run_summary(kept, "bronze", corrupt=aside)
    zero = F.lit(0).cast("long")
    return (
        kept.select(F.lit("read").alias("kind"), "report_number", "mdr_report_key",
                    zero.alias("records"), zero.alias("corrupt_records"))
        .unionByName(aside.select(
            F.lit("kept aside").alias("kind"),
            *[F.regexp_extract(S.CORRUPT, f'"{c}":"([^"]*)"', 1).alias(c)
              for c in ("report_number", "mdr_report_key")],
            zero.alias("records"), zero.alias("corrupt_records")))
        .unionByName(summary.select(
            F.lit("summary").alias("kind"), F.col("run_id").alias("report_number"),
            F.col("bronze_table").alias("mdr_report_key"),
            F.col("total_records").alias("records"), "corrupt_records")))


def _appended(spark: SparkSession, sf_dir: str, parts_last: bool = False) -> str:
    path = shared_folder(spark, "bronze")
    for within in feed.slices(spark, sf_dir):
        tables.append_bronze(feed.device_bronze(spark, sf_dir, parts_last, within), path,
                             run_id=feed.PARAMS.run_id)
    texts = feed.text_bronze(spark, sf_dir)
    blocks = F.expr("json_array_length(mdr_text_raw)")
    tables.append_bronze(texts.withColumn("narrative_blocks", blocks), path,
                         run_id=feed.TEXT_PARAMS.run_id)
    return path


def bronze_append_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended, the second with a column more, read with merged schema."""
    merged = tables.read_bronze(spark, _appended(spark, sf_dir, parts_last=True),
                                merge_schema=True)
    return merged.drop(S.RECORD_HASH, S.SOURCE_FILE)


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer of two runs, loaded from their pages."""
    base = shared_folder(spark, "job")
    at = Locations(f"{base}/landing", f"{base}/bronze", f"{base}/silver/", f"{base}/gold/")
    pages = _array_pages(spark, sf_dir)
    load_pages(landing.read_pages(spark, pages, whole_file_pages=True), at,
               landing.landed_files(spark, pages))
    return tables.read_bronze(spark, at.bronze)


def _by_page(bronze: DataFrame) -> DataFrame:
    """Rows with the page's folder in place of the file: a page may be cut into several files."""
    return bronze.withColumn(S.SOURCE_FILE, landing.page_folder())


def run_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and records of each run, from its landed pages."""
    folder = F.substring_index("landing_path", "/", -1)
    summary = run_summary(_by_page(_loaded(spark, sf_dir)), "bronze")
    return summary.withColumn("landing_path", F.substring_index(folder, "=", -1))


def run_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each landed page; pages are named by their folder."""
    folder = F.element_at(F.split(S.SOURCE_FILE, "/"), -2)
    return run_files(_by_page(_loaded(spark, sf_dir))).withColumn(
        S.SOURCE_FILE, F.substring_index(folder, "=", -1))


def _half_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is missing where some planned pages failed, some were cut off and some came twice."""
    limit = 50
    plan = page_plan(feed.device_reports(spark, sf_dir), limit)
    kept = F.col("records") - F.when(F.col("page_num") % 11 == 5, 20).otherwise(0)
    landed = plan.where(~(F.col("page_num") % 7).isin(3, 4)).select("skip", kept.alias("records"))
    # A second client fetched pages of another size, for one in five of its own.
    again = plan.where(F.col("page_num") % 5 == 0).select(
        (F.col("skip") + 10).alias("skip"), F.lit(45).alias("records"))
    return missing_pages(plan, landed.unionByName(again).unionByName(again), limit)


def missing_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, and parts of pages, that did not arrive."""
    return _half_landed(spark, sf_dir)


def fetch_ranges_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ranges to fetch."""
    return fetch_ranges(_half_landed(spark, sf_dir))


# --- clean tables ------------------------------------------------------------------------

def reports_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest version of each report."""
    latest = latest_reports(feed.device_bronze(spark, sf_dir))
    return latest.select("report_number", "mdr_report_key", "event_type", "_ingested_at")


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of a stream of landed pages, 100 files at a time."""
    pages, kept = shared_folder(spark, "landing"), shared_folder(spark, "latest")
    landing.write_pages(feed.device_reports(spark, sf_dir), pages, feed.PARAMS,
                        codec=landing.PACKED)
    follow_latest(spark, pages, kept, shared_folder(spark, "offsets"),
                  ["mdr_report_key", "event_type", "_ingested_at"],
                  max_files_per_batch=100).awaitTermination()
    return read_latest(spark, kept)


def events_partition_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some years of the written events table: only their partitions are read."""
    path = shared_folder(spark, "events")
    tables.overwrite(_events(spark, sf_dir), path, PARTITIONS["events"])
    written = tables.read(spark, path, S.EVENTS_SCHEMA)
    return written.where("year between 1996 and 1998").select(
        "report_number", "event_type", "date_received", "year", "month")


def events_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as written by year and month and read back."""
    path = shared_folder(spark, "events")
    tables.overwrite(_events(spark, sf_dir), path, PARTITIONS["events"])
    return tables.read(spark, path, S.EVENTS_SCHEMA)


def devices_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices of the latest report versions."""
    return silver.devices_silver(feed.device_bronze(spark, sf_dir))


def devices_silver_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices of all report versions, the latest of each."""
    return silver.devices_silver(feed.device_bronze(spark, sf_dir), latest_only=False)


def narratives_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrative blocks of the latest report versions."""
    return silver.narratives_silver(feed.text_bronze(spark, sf_dir))


def narratives_silver_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrative blocks of all report versions."""
    return silver.narratives_silver(feed.text_bronze(spark, sf_dir), latest_only=False)


# --- analysis tables ---------------------------------------------------------------------

def event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report volume by year, month and event type, in order."""
    return gold.ordered(gold.event_summary(_events(spark, sf_dir)), "event_summary")


def _product_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.product_risk(_events(spark, sf_dir), one_row_per_report=True)


def product_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk by product, most reports first."""
    return gold.ordered(_product_risk(spark, sf_dir), "product_risk")


def product_risk_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk by product over all versions, reports counted once in unique_reports."""
    flagged = feed.device_bronze(spark, sf_dir).select(
        "report_number", "brand_name", "generic_name", "device_class",
        report_date("date_received").alias("date_received"),
        (F.col("adverse_event_flag") == "Y").alias("is_adverse_event"),
        (F.col("product_problem_flag") == "Y").alias("is_product_problem"))
    return gold.ordered(gold.product_risk(flagged), "product_risk")


def product_risk_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 products with most reports."""
    return gold.top(_product_risk(spark, sf_dir), "product_risk", 20)


def outcome_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per report and outcome code, labelled."""
    return gold.outcome_codes(_events(spark, sf_dir))


def outcome_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes by year, most frequent first."""
    return gold.ordered(gold.outcome_breakdown(_events(spark, sf_dir)), "outcome_breakdown")


def matched_keywords_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a term, with the terms of two lists found."""
    documents = feed.table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.where(has_keyword("text", feed.TEXT_KEYWORDS)).select(
        "doc_id",
        matched_keywords("text", feed.TEXT_KEYWORDS).alias("matched_keywords"),
        matched_keywords("text").alias("matched_high_risk"))


def flagged_by_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a word of the benchmark items, or two words in a row of them."""
    words = F.split("text", " ")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
                        lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    terms = feed.table(spark, sf_dir, "benchmark").select(
        F.explode(F.concat(words, pairs)).alias("term")).where(F.length("term") >= 9)
    documents = feed.table(spark, sf_dir, "documents").select("doc_id", "text")
    return flagged_by_table(documents, terms, "text").select(
        "doc_id", F.size("matched_terms").alias("n_terms"),
        F.md5(F.array_join("matched_terms", "|")).alias("terms_md5"))


def _flagged(spark: SparkSession, sf_dir: str, latest_only: bool, **options) -> DataFrame:
    narratives = silver.narratives_silver(feed.text_bronze(spark, sf_dir), latest_only)
    path = shared_folder(spark, "events")
    tables.overwrite(_events(spark, sf_dir).select(*gold.REPORT_COLUMNS), path)
    return gold.flagged_narratives(narratives, tables.read(spark, path), **options)


def flagged_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narratives of the latest versions with a default keyword, newest first."""
    return gold.ordered(_flagged(spark, sf_dir, latest_only=True), "flagged_narratives")


def flagged_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narratives of all versions with a term of a custom list."""
    return _flagged(spark, sf_dir, latest_only=False, keywords=feed.TEXT_KEYWORDS)


def flagged_latest20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 newest of them."""
    hits = _flagged(spark, sf_dir, latest_only=False, keywords=feed.TEXT_KEYWORDS)
    return gold.top(hits, "flagged_narratives", 20)


def layer_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of every layer of a job over both kinds of reports."""
    bronze = tables.read_bronze(spark, _appended(spark, sf_dir))
    clean = {}
    for name in SILVER_SCHEMAS:
        path = shared_folder(spark, name)
        write_clean(bronze, feed.PARAMS, name, path)
        clean[name] = tables.read(spark, path)
    return layer_counts({"bronze": bronze, **clean, **gold_tables(clean, feed.PARAMS)})


def gold_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four analysis tables of a job over both kinds of reports, written and read again."""
    base = shared_folder(spark, "job")
    at = Locations(f"{base}/landing", _appended(spark, sf_dir), f"{base}/silver/", f"{base}/gold/")
    refresh_silver(spark, feed.PARAMS, at)
    refresh_gold(spark, feed.PARAMS, at)
    written = [tables.read(spark, at.analysis(name)).withColumn("layer", F.lit(name))
               for name in GOLD_TABLES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), written)


def _upserted(spark: SparkSession, sf_dir: str, later_first: bool = False) -> str:
    """A base that three runs brought up to date: device reports of some lines, those of the others
    with some of the first again, and texts. ``later_first`` swaps the first two."""
    base = shared_folder(spark, "incremental")
    devices = [feed.device_bronze(spark, sf_dir, within=within)
               for within in feed.slices(spark, sf_dir)]
    early, again = feed.fetched_before(1996), F.pmod(F.xxhash64("report_number"), F.lit(5)) == 0
    runs = [[rows.where(of_run) for rows in devices] for of_run in (early, ~early | again)]
    for rows in [*(reversed(runs) if later_first else runs), [feed.text_bronze(spark, sf_dir)]]:
        incremental.upsert(rows, base, buckets=16)
    return base


def _layers(tables_: dict[str, DataFrame]) -> DataFrame:
    named = [df.withColumn("layer", F.lit(name)) for name, df in tables_.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean tables after runs that each changed some buckets: events and devices as of the
    version before the texts, narratives of the latest."""
    base = _upserted(spark, sf_dir)
    devices_only = versions.version(spark, base, 2)
    return _layers({
        "events": incremental.clean_table(spark, base, "events", devices_only),
        "devices": incremental.clean_table(spark, base, "devices", devices_only),
        "narratives": incremental.clean_table(spark, base, "narratives")})


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis tables that are kept as sums, after runs that changed reports back and forth."""
    base = _upserted(spark, sf_dir, later_first=True)
    return _layers({name: incremental.analysis_table(spark, base, name)
                    for name in ("event_summary", "product_risk", "outcome_breakdown")})


def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of a table while its next version is written, and once it is published."""
    base, schema = shared_folder(spark, "versions"), feed.KEY_SCHEMA
    rows = feed.device_reports(spark, sf_dir).select(
        *schema.names, "_ingested_at", F.lit(0).alias(versions.BUCKET))

    def commit(shown: DataFrame) -> versions.Commit:
        begun = versions.Commit(spark, base)
        begun.write("reports", shown.drop("_ingested_at"), [0])
        return begun

    def seen() -> DataFrame:
        return versions.read(spark, base, versions.version(spark, base), "reports", schema).drop(
            versions.BUCKET)

    commit(rows.where(feed.fetched_before(1996))).publish()
    begun = commit(rows)
    during = seen()
    begun.publish()
    return _layers({"during": during, "after": seen()})


QUERIES: dict[str, Query] = {
    "event_summary": event_summary,
    "product_risk": product_risk,
    "product_risk_all_versions": product_risk_all_versions,
    "product_risk_top20": product_risk_top20,
    "outcome_codes": outcome_codes,
    "outcome_breakdown": outcome_breakdown,
    "reports_latest": reports_latest,
    "stream_latest": stream_latest,
    "events_silver": _events,
    "events_partitioned": events_partitioned,
    "events_partition_slice": events_partition_slice,
    "devices_silver": devices_silver,
    "devices_silver_all_versions": devices_silver_all_versions,
    "narratives_silver": narratives_silver,
    "narratives_silver_all_versions": narratives_silver_all_versions,
    "matched_keywords": matched_keywords_query,
    "flagged_narratives": flagged_narratives,
    "flagged_custom": flagged_custom,
    "flagged_latest20": flagged_latest20,
    "flagged_by_table": flagged_by_table_query,
    "search_filter": search_filter,
    "matching_count": matching_count,
    "page_plan": page_plan_query,
    "missing_pages": missing_pages_query,
    "fetch_ranges": fetch_ranges_query,
    "bronze_flatten": bronze_flatten,
    "bronze_flatten_texts": bronze_flatten_texts,
    "null_to_empty": null_to_empty_query,
    "date_parse": date_parse,
    "landing_roundtrip": landing_roundtrip,
    "landing_stream_ingest": landing_stream_ingest,
    "array_pages_roundtrip": array_pages_roundtrip,
    "responses_roundtrip": responses_roundtrip,
    "corrupt_pages": corrupt_pages,
    "gold_written": gold_written,
    "bronze_append_merge": bronze_append_merge,
    "run_summary": run_summary_query,
    "run_files": run_files_query,
    "layer_counts": layer_counts_query,
    "silver_incremental": silver_incremental,
    "gold_incremental": gold_incremental,
    "snapshot_read": snapshot_read,
}
