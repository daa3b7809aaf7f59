"""What the optimizer makes of the operators, and how they take skewed data."""

import json
import re
from collections import Counter

import pytest
from pyspark.sql.readwriter import DataFrameWriter
from records import raw, rows

from devicewatch import schemas as S
from devicewatch.operators import gold
from devicewatch.operators.dedup import latest_reports, latest_unmoved
from devicewatch.operators.flatten import flatten
from devicewatch.operators.silver import devices_silver, events_silver, narratives_silver
from devicewatch.plans import feed, queries
from devicewatch.plans.queries import QUERIES
from devicewatch.sources import tables
from devicewatch.sources.landing import record_json
from devicewatch.sources.shared import staged

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    """A written raw layer in which one report holds a third of all rows."""
    path = str(tmp_path_factory.mktemp("bronze") / "t")
    hot = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS report_number",
        "cast(id AS string) AS mdr_report_key",
        "date_format(date_add(date'2023-01-01', cast(id % 700 AS int)), 'yyyyMMdd')"
        " AS date_received",
        "'[{\"foi_text\":\"death ' || id || '\",\"text_type_code\":\"D\"}]' AS mdr_text",
        "'[{\"brand_name\":\"b\",\"device_sequence_no\":\"' || id % 50 || '\"}]' AS device",
        "'2024-01-01T00:00:00Z' AS _ingested_at", "'r1' AS _run_id", "'f' AS _source_file")
    missing = [c for c in S.RAW_SCHEMA.names if c not in hot.columns]
    raw_reports = hot.selectExpr("*", *[f"cast(NULL AS string) AS {c}" for c in missing])
    tables.append_bronze(flatten(raw_reports.repartition(8)), path)
    return tables.read_bronze(spark, path)


def test_no_query_runs_python_or_crosses_tables(spark):
    for name, query in QUERIES.items():
        text = plan(query(spark, SF_DIR))
        for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, (name, bad)


def test_latest_is_limited_before_the_shuffle(bronze):
    text = plan(latest_reports(bronze))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1
    # Read from the bottom: rank limit per input partition, exchange, final rank limit.
    order = re.findall(r"WindowGroupLimit|Exchange hashpartitioning", text)
    assert order == ["WindowGroupLimit", "Exchange hashpartitioning", "WindowGroupLimit"]


def test_clean_tables_read_only_their_columns(bronze):
    def read(df):
        schema = re.search(r"ReadSchema: struct<([^>]*)>",
                           df._jdf.queryExecution().explainString(
                               df.sparkSession._jvm.org.apache.spark.sql.execution
                               .ExplainMode.fromString("formatted"))).group(1)
        return {c.split(":")[0] for c in schema.split(",")}

    version = {"report_number", "_ingested_at", "mdr_report_key", "_record_hash"}
    assert read(devices_silver(bronze)) == version | {"device_raw"}
    assert read(narratives_silver(bronze)) == version | {"mdr_text_raw", "date_received"}
    assert not read(events_silver(bronze)) & {"device_raw", "mdr_text_raw", "patient_raw"}


def test_devices_of_the_latest_version_need_one_shuffle(bronze):
    assert plan(devices_silver(bronze)).count("Exchange hashpartitioning") == 1


def test_all_narratives_need_no_shuffle(bronze):
    assert "Exchange" not in plan(narratives_silver(bronze, latest_only=False))


def test_product_risk_of_unique_reports_needs_one_shuffle(spark, bronze, tmp_path):
    path = str(tmp_path / "events")
    tables.overwrite(events_silver(bronze), path, ("year", "month"))
    events = tables.read(spark, path, S.EVENTS_SCHEMA)
    assert plan(gold.product_risk(events, one_row_per_report=True)).count("Exchange hash") == 1
    assert plan(gold.product_risk(events)).count("Exchange hash") == 2


def test_written_events_are_pruned_by_partition(spark, bronze, tmp_path):
    path = str(tmp_path / "events")
    tables.overwrite(events_silver(bronze), path, ("year", "month"))
    events = tables.read(spark, path, S.EVENTS_SCHEMA)
    text = plan(events.where("year = 2023 AND month = 1"))
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*= 2023", text)
    files = Counter(p.parent.name for p in (tmp_path / "events").glob("year=*/month=*/*.parquet"))
    assert max(files.values()) <= 24


def test_keywords_are_matched_before_the_join(spark, bronze):
    texts = narratives_silver(bronze, latest_only=False)
    text = plan(gold.flagged_narratives(texts, events_silver(bronze)))
    join = text.index("LeftOuter")
    assert text.index("exists(array(lower(") > join


def test_top_n_does_not_sort_everything(bronze):
    ranked = gold.top(gold.product_risk(events_silver(bronze), True), "product_risk", 20)
    assert "TakeOrderedAndProject" in plan(ranked)


def test_hot_report_results(spark, bronze):
    latest = rows(latest_reports(bronze), "report_number", "mdr_report_key")
    assert len(latest) == 2001
    assert dict(latest)["hot"] == str(max(range(0, 3000, 3)))
    assert devices_silver(bronze, latest_only=False).where("report_number = 'hot'").count() == 50
    flagged = gold.flagged_narratives(
        narratives_silver(bronze, latest_only=False), events_silver(bronze))
    assert flagged.count() == 3000
    assert flagged.where("report_number = 'hot'").count() == 1000


def test_hot_report_is_split_in_the_join(spark, bronze, tmp_path):
    """The hits of one report are spread over tasks; the events side is repeated for them."""
    path = str(tmp_path / "events")
    tables.overwrite(events_silver(bronze), path, ("year", "month"))
    events = tables.read(spark, path, S.EVENTS_SCHEMA)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        flagged = gold.flagged_narratives(
            narratives_silver(bronze, latest_only=False), events)
        assert len(flagged.collect()) == 3000
        assert "skew=true" in plan(flagged)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_raw_helper_defaults(spark):
    assert raw(spark, {"report_number": "r"}).first()[S.RUN_ID] == "r1"


def test_latest_narratives_leave_the_text_in_place(spark, bronze, tmp_path):
    """In the plan that ran, no shuffle or sort has the text: few reports have versions."""
    path = str(tmp_path / "t")
    few = bronze.where("report_number <> 'hot' or mdr_report_key in ('3', '30')")
    few.write.parquet(path)
    got = narratives_silver(spark.read.parquet(path))
    got.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where(
        "report_number = 'hot'").first().narrative_text == "death 30"
    ran = got._jdf.queryExecution()
    ran.executedPlan().execute().count()
    final = ran.executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [line for line in final.splitlines()
             if re.search(r"Exchange (hash|range|single)|Sort \[", line)]
    assert "isFinalPlan=true" in final and "mdr_text_raw" not in "".join(moved)


def test_latest_unmoved_is_latest(bronze):
    copies = bronze.unionByName(bronze.where("cast(mdr_report_key AS int) % 5 = 0"))
    one, two = (rows(f(copies), "report_number", "mdr_report_key", "mdr_text_raw")
                for f in (latest_reports, latest_unmoved))
    assert one == two and len(one) == 2001


def test_no_page_holds_more_than_its_records(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    # Reports in which one number has very many copies.
    hot = feed.text_reports(spark, folder).limit(1).crossJoin(spark.range(0, 700, 1, 3).drop("id"))
    every = feed.reports(spark, folder)
    every = every.unionByName(hot.select(*every.columns)).localCheckpoint()
    monkeypatch.setattr(feed, "reports", lambda *_: every)
    got = feed.pages(spark, folder, 50).collect()
    assert max(r["count"] for r in got) <= 50
    assert sum(r["count"] for r in got) == every.count()
    records = [json.dumps(x, sort_keys=True) for r in got for x in json.loads(r["records"])]
    given = [json.dumps(json.loads(r[0]), sort_keys=True)
             for r in every.select(record_json()).collect()]
    assert sorted(records) == sorted(given)


def test_landed_text_is_compressed_and_records_are_not_staged(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(feed, "staged", lambda df, name: (staged.append(df.columns), (df, ""))[1])
    monkeypatch.setattr(queries, "shared_folder", lambda _, name: str(tmp_path / name))
    QUERIES["array_pages_roundtrip"](spark, SF_DIR)
    QUERIES["stream_latest"](spark, SF_DIR)
    for folder in ("pages", "landing"):
        files = [f.name for f in (tmp_path / folder).rglob("part-*")]
        assert files and all(name.endswith(".gz") for name in files)
    assert staged == [["_run", "_page", "_parts"]]


def test_only_latest_reports_are_flattened_for_events(spark):
    """Read from the bottom: versions are ranked, then what is left is parsed."""
    text = plan(QUERIES["events_silver"](spark, SF_DIR))
    assert text.rindex("from_json") < text.rindex("WindowGroupLimit")


def test_tables_are_written_with_the_stronger_codec(spark, tmp_path):
    rows_ = spark.range(9).selectExpr("id", "'r' AS _run_id")
    tables.append_bronze(rows_, str(tmp_path / "bronze"))
    tables.overwrite(rows_, str(tmp_path / "table"))
    for folder in ("bronze", "table"):
        names = [f.name for f in (tmp_path / folder).rglob("part-*")]
        assert names and all(".zstd." in name for name in names)


@pytest.mark.parametrize("name", [
    "reports_latest", "devices_silver", "devices_silver_all_versions", "event_summary",
    "flagged_narratives", "bronze_flatten"])
def test_reports_are_made_in_methods_that_the_jvm_compiles(spark, name):
    """HotSpot interprets a method of more than 8000 bytes, however often it runs."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        bronze_ = (feed.latest_device_bronze(spark, SF_DIR) if name == "flagged_narratives"
                   else QUERIES[name](spark, SF_DIR))
        text = bronze_._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_the_raw_layer_is_not_sorted_to_be_written(spark, monkeypatch):
    """Spark sorts whole rows by what a write is partitioned by: here the run, which is known."""
    by = []
    monkeypatch.setattr(DataFrameWriter, "partitionBy",
                        lambda writer, *columns: (by.append(columns), writer)[1])
    merged = QUERIES["bronze_append_merge"](spark, SF_DIR)
    assert not by
    assert {r[0] for r in merged.select(S.RUN_ID).distinct().collect()} == {
        feed.PARAMS.run_id, feed.TEXT_PARAMS.run_id}


def test_versions_are_counted_on_their_own_columns(bronze):
    """What they are ordered by, the same texts once more, is not sent along."""
    text = plan(latest_unmoved(bronze))
    counted = re.findall(r"Exchange hashpartitioning\(report_number#\d+, _ingested_at#\d+, "
                         r"mdr_report_key#\d+, _record_hash#\d+L", text)
    assert counted and "_version" not in "".join(
        line for line in text.splitlines() if "Exchange" in line)


def test_a_finished_write_leaves_no_shuffle_files(spark, tmp_path):
    """They would stay on disk beside all that later steps write."""
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for f in str(files.getAllFiles().mkString("\n")).splitlines()
                if (name := f.rpartition("/")[2]).startswith("shuffle_")}

    rows_ = spark.range(999).selectExpr("id", "'r' AS _run_id").repartition(5, "id")
    for write in (lambda: tables.append_bronze(rows_, str(tmp_path / "some")),
                  lambda: tables.append_bronze(rows_, str(tmp_path / "one"), run_id="r"),
                  lambda: tables.overwrite(rows_, str(tmp_path / "table")),
                  lambda: staged(rows_, "rows")):
        before = shuffled()
        write()
        assert not shuffled() - before


def test_rows_of_a_few_runs_are_not_sorted_to_be_written(spark, tmp_path, monkeypatch):
    key, seen, parquet = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda writer, *given: (
        seen.append(int(spark.conf.get(key))), parquet(writer, *given))[1])
    before = spark.conf.get(key)
    many = spark.range(600).selectExpr("id", "'r' || id % 12 AS _run_id")
    tables.append_bronze(many, str(tmp_path / "bronze"))
    assert seen[0] > 1 and spark.conf.get(key) == before
    # More runs than are written side by side.
    assert rows(spark.read.parquet(str(tmp_path / "bronze")), "id", S.RUN_ID) == rows(
        many, "id", S.RUN_ID)


def test_records_of_pages_are_made_where_their_page_is(spark):
    """A record is many times what it is made of; the union and the groups leave it in place."""
    text = plan(feed.pages(spark, SF_DIR))
    assert "Exchange" not in text[:text.index("Union")]
    assert "record#" not in "".join(x for x in text.splitlines() if "Exchange" in x)


def test_parts_are_joined_last_for_pages_and_orders_for_versions(spark):
    """What is joined before is moved again; ranks drop the versions of an order that lie together."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        pages, versions = (re.findall(r"SortMergeJoin \[(\w+)#", plan(
            feed.device_reports(spark, SF_DIR, parts_last=last))) for last in (True, False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert pages[:4] == ["l_partkey", "s_nationkey", "l_suppkey", "o_orderkey"]
    assert versions[:4] == ["o_orderkey", "s_nationkey", "l_suppkey", "l_partkey"]
