"""Large tables are made slice by slice: the same rows, and less on disk at a time."""

import os
import random

import pytest
from pyspark.sql import functions as F
from records import raw, rows
from test_incremental import as_rebuilt, random_report

from devicewatch import schemas as S
from devicewatch.operators.dedup import latest_unmoved
from devicewatch.operators.flatten import flatten
from devicewatch.params import JobParams
from devicewatch.plans import feed, incremental, layers, queries
from devicewatch.plans.layers import Locations
from devicewatch.sources import shared, tables
from devicewatch.sources.landing import landed_files, read_pages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """The smallest tables, with order numbers that are negative or missing."""
    path = tmp_path_factory.mktemp("odd")
    for name in ("nation", "supplier", "part", "documents", "conversations"):
        os.symlink(f"{SF}/{name}.parquet", path / f"{name}.parquet")
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        table = feed.table(spark, SF, name)
        odd = table.where(F.col(key) % 7 == 0).withColumn(key, -F.col(key))
        none = table.where(F.col(key) % 50 == 0).withColumn(key, F.lit(None).cast("long"))
        table.unionByName(odd).unionByName(none).write.parquet(str(path / f"{name}.parquet"))
    return str(path)


def counted(df):
    return rows(df.groupBy(*df.columns).count(), *df.columns, "count")


def test_slices_hold_every_report_once(spark, odd_dir, monkeypatch):
    whole = counted(feed.device_reports(spark, odd_dir))
    assert feed.slices(spark, odd_dir) == [feed.WHOLE]
    monkeypatch.setattr(shared, "SLICE_ROWS", 1500)
    parts = feed.slices(spark, odd_dir)
    assert len(parts) > 3
    found = [feed.device_reports(spark, odd_dir, within=part) for part in parts]
    assert sorted(map(str, sum(map(counted, found), []))) == sorted(map(str, whole))
    # No page is cut.
    pages = [{r.page for r in df.select(feed.page_number().alias("page")).distinct().collect()}
             - {None} for df in found]
    assert sum(map(len, pages)) == len(set.union(*pages))


@pytest.mark.parametrize("name", ["bronze_append_merge", "landing_roundtrip", "gold_written",
                                  "array_pages_roundtrip", "responses_roundtrip"])
def test_queries_give_the_same_by_slices(spark, monkeypatch, name):
    query = queries.QUERIES[name]
    skipped = ("_ingested_at",) if name == "responses_roundtrip" else ()
    whole = counted(query(spark, SF).drop(*skipped))
    writes, write = [], shared.writing
    monkeypatch.setattr(shared, "SLICE_ROWS", 4000)
    for module in (queries, queries.landing, tables):
        monkeypatch.setattr(module, "writing", lambda *a: writes.append(a) or write(*a))
    assert counted(query(spark, SF).drop(*skipped)) == whole
    assert len(writes) >= 2


def test_few_suppliers_are_sent_to_the_lines(spark, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        def shuffled_joins():
            found = feed._orders_with_lines(spark, SF)
            return found._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")

        assert shuffled_joins() == 3  # orders, parts and nations
        monkeypatch.setattr(feed, "SENT_ROWS", 0)
        assert shuffled_joins() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clean_tables_by_slices_are_the_same(spark, tmp_path, monkeypatch):
    rng, params = random.Random(3), JobParams("m", "2020-01-01", "2025-12-31")
    bronze = flatten(raw(spark, *[random_report(rng) for _ in range(60)])).localCheckpoint()
    monkeypatch.setattr(shared, "SLICE_ROWS", 9)
    for name, want in layers.silver_tables(bronze, params).items():
        for _ in range(2):  # the second time in place of the first
            layers.write_clean(bronze, params, name, f"{tmp_path}/{name}")
        assert counted(tables.read(spark, f"{tmp_path}/{name}").select(*want.columns)) == counted(
            want), name


def test_reports_without_narratives_are_not_joined(spark):
    """A later version without a narrative still replaces one that has it."""
    text = [{"text_type_code": "D", "foi_text": "t"}]
    bronze = flatten(raw(
        spark, {"report_number": "1", "mdr_report_key": "1", "mdr_text": text},
        {"report_number": "1", "mdr_report_key": "2"},
        {"report_number": "2", "mdr_report_key": "2", "mdr_text": text},
        {"report_number": "2", "mdr_report_key": "2", "mdr_text": text},
        {"report_number": "3"}))
    wanted = F.col("mdr_text_raw") != "[]"
    assert rows(latest_unmoved(bronze, wanted), "report_number") == [("2",)]


def test_refresh_by_slices_and_shares_is_a_rebuild(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "SLICE_ROWS", 7)
    rng, base, landed = random.Random(5), f"{tmp_path}/base", None
    for _ in range(3):
        parts = [flatten(raw(spark, *[random_report(rng) for _ in range(8)])) for _ in range(2)]
        incremental.upsert(parts, base, buckets=4)
        for part in parts:
            landed = part if landed is None else landed.unionByName(part)
    as_rebuilt(spark, base, landed)


def test_loaded_rows_are_written_once(spark, tmp_path, monkeypatch):
    at = Locations(f"{tmp_path}/raw", f"{tmp_path}/b", f"{tmp_path}/s/", f"{tmp_path}/g/")
    folder = tmp_path / "raw" / "run_1"
    folder.mkdir(parents=True)
    (folder / "page_1.json").write_text('[{"report_number": "1"}, {"report_number": "2"}]')
    (folder / "page_2.json").write_text('[{"report_number": "3"}, {"report_nu')
    written, append = [], tables.append_bronze
    monkeypatch.setattr(tables, "append_bronze", lambda df, path, *a, **k: written.append(
        (path, set(df.columns))) or append(df, path, *a, **k))
    for _ in range(2):
        written.clear()
        layers.load_pages(read_pages(spark, at.landing, whole_file_pages=True), at,
                   landed_files(spark, at.landing))
        assert sum("device_raw" in columns for _, columns in written) == 1
        assert at.bronze not in dict(written)
        assert rows(tables.read_bronze(spark, at.bronze), "report_number", S.RUN_ID) == [
            ("1", "run_1"), ("2", "run_1")]
        assert rows(tables.read(spark, at.manifest), "records", "corrupt_records") == [
            (0, 1), (2, 0)]
    assert not [p for p in os.listdir(tmp_path) if "_load-" in p]
