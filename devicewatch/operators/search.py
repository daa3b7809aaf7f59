"""Which raw reports a run is about: search predicate, lineage stamps, hit count, page plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicewatch import schemas as S
from devicewatch.functions.columns import report_date
from devicewatch.params import JobParams

_MAKERS = T.ArrayType(T.StructType([T.StructField("manufacturer_d_name", T.StringType())]))
_PAGES_PER_BLOCK = 10_000


def search_predicate(params: JobParams) -> Column:
    """Any device made by the manufacturer, received within the inclusive date range.

    The name matches as a case-insensitive phrase. An unreadable date matches no range. A
    readable one is in the range exactly when its text is, which file statistics can tell.
    """
    phrase = params.manufacturer.lower()
    made_by = F.exists(F.from_json("device", _MAKERS),
                       lambda d: F.lower(d["manufacturer_d_name"]).contains(phrase))
    in_range = report_date("date_received").between(
        F.to_date(F.lit(params.date_from), "yyyyMMdd"),
        F.to_date(F.lit(params.date_to), "yyyyMMdd"))
    as_text = F.col("date_received").between(params.date_from, params.date_to)
    return as_text & in_range & made_by


def search(raw: DataFrame, params: JobParams) -> DataFrame:
    """The raw reports that match the run's search."""
    return raw.where(search_predicate(params))


def stamp(raw: DataFrame, params: JobParams, ingested_at: Column | str) -> DataFrame:
    """Lineage on every record: when it was fetched, by which run and with which search."""
    fetched = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    return raw.withColumns({
        "_ingested_at": fetched,
        "_manufacturer_filter": F.lit(params.manufacturer),
        "_date_from": F.lit(params.date_from),
        "_date_to": F.lit(params.date_to),
        S.RUN_ID: F.lit(params.run_id),
    })


def count_matching(matching: DataFrame) -> DataFrame:
    """One row with the number of matching reports; 0 where nothing matches."""
    return matching.agg(F.count("*").alias("total"))


def page_plan(matching: DataFrame, page_limit: int) -> DataFrame:
    """The pages that cover the matching reports: ``page_num, skip, page_limit, records``.

    The plan grows with the data, so it is laid out as blocks of pages that are spread over
    tasks before the pages themselves are generated. No match gives no page.
    """
    block = page_limit * _PAGES_PER_BLOCK
    blocks = (
        count_matching(matching).where("total > 0")
        .select("total", F.explode(F.sequence(F.lit(0), F.col("total") - 1, F.lit(block)))
                .alias("first"))
        .repartition("first"))
    end = F.least(F.col("first") + block, F.col("total")) - 1
    return (
        blocks
        .select("total", F.explode(F.sequence("first", end, F.lit(page_limit))).alias("skip"))
        .select(
            F.expr(f"skip div {page_limit} + 1").alias("page_num"),
            "skip",
            F.lit(page_limit).alias("page_limit"),
            F.least(F.lit(page_limit), F.col("total") - F.col("skip")).alias("records")))


def landed_intervals(manifest: DataFrame, page_limit: int) -> DataFrame:
    """Where landed pages lie in the search's hits: ``skip``, ``records``.

    ``manifest`` has the pages of one search, in ``page=<n>`` folders, and their records.
    """
    number = F.regexp_extract(S.SOURCE_FILE, r"/page=(\d+)/[^/]+$", 1)
    return manifest.where(number != "").groupBy(number.cast("long").alias("_page")).agg(
        F.sum("records").alias("records")).select(
        ((F.col("_page") - 1) * page_limit).alias("skip"), "records")


def missing_pages(plan: DataFrame, landed: DataFrame, page_limit: int) -> DataFrame:
    """What of the planned pages has not landed: ``page_num``, ``skip``, ``records`` of each gap.

    ``plan`` is a :func:`page_plan` with the same ``page_limit``. ``landed`` has intervals of hits,
    ``skip`` and ``records``: they may overlap, repeat, or come from pages of another size, and a
    page is there when they cover it together. Null and empty intervals, and what lies beyond the
    plan, count for nothing. A page that landed in part gives a row for each part that did not.
    """
    stop = F.col("skip") + F.col("records")
    spans = landed.where("records > 0 AND skip >= 0").select("skip", stop.alias("stop"))
    first, last = (F.floor(c / page_limit) for c in (F.col("skip"), F.col("stop") - 1))
    pages = spans.select("skip", "stop", F.explode(F.sequence(first, last)).alias("_page"))
    start = F.col("_page") * page_limit
    held = pages.select(
        (F.col("_page") + 1).alias("page_num"),
        F.struct(F.greatest("skip", start).alias("start"),
                 F.least("stop", start + page_limit).alias("stop")).alias("span"))
    held = held.groupBy("page_num").agg(F.sort_array(F.collect_set("span")).alias("_held"))

    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    planned = plan.join(held, "page_num", "left").withColumn("_end", stop)

    def gap(start: Column, stop: Column) -> Column:
        return F.struct(start.cast("long").alias("start"), stop.cast("long").alias("stop"))

    # The gaps before each span, then what is left behind the last.
    walked = F.aggregate(
        F.coalesce("_held", none),
        F.struct(F.col("skip").cast("long").alias("at"), none.alias("gaps")),
        lambda done, span: F.struct(
            F.greatest(done["at"], span["stop"]).alias("at"),
            F.when(span["start"] > done["at"], F.concat(
                done["gaps"], F.array(gap(done["at"], F.least(span["start"], F.col("_end"))))))
            .otherwise(done["gaps"]).alias("gaps")),
        lambda done: F.when(done["at"] < F.col("_end"), F.concat(
            done["gaps"], F.array(gap(done["at"], F.col("_end"))))).otherwise(done["gaps"]))
    gaps = planned.select("page_num", F.inline(walked)).where("start < stop")
    return gaps.select("page_num", F.col("start").alias("skip"),
                       (F.col("stop") - F.col("start")).alias("records"))


def fetch_ranges(missing: DataFrame, pages_per_block: int = _PAGES_PER_BLOCK) -> DataFrame:
    """Gaps that touch as one: ``skip``, ``records`` and ``pages`` of each range to fetch.

    Ranges end with a block of pages, so that no task sees all gaps.
    """
    block = Window.partitionBy("_block").orderBy("skip")
    rows = missing.withColumn("_block", F.floor((F.col("page_num") - 1) / pages_per_block))
    begins = F.col("skip") != F.coalesce(F.lag(F.col("skip") + F.col("records")).over(block),
                                         F.lit(-1))
    numbered = rows.withColumn("_begins", begins.cast("int")).withColumn(
        "_range", F.sum("_begins").over(block))
    return numbered.groupBy("_block", "_range").agg(
        F.min("skip").alias("skip"), F.sum("records").alias("records"),
        F.countDistinct("page_num").alias("pages")).drop("_block", "_range")
