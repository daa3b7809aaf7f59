import json

import pytest
from records import raw, rows

from devicewatch import JobParams
from devicewatch import schemas as S
from devicewatch.operators.audit import run_files, run_summary
from devicewatch.plans.layers import (
    Locations,
    ingest,
    load_pages,
    read_silver,
    refresh_gold,
    refresh_silver,
)
from devicewatch.sources import shared, tables
from devicewatch.sources.landing import landed_files, page_folder, read_pages, read_run_pages


def report(number, day, text, kind="Injury"):
    return {"report_number": number, "date_received": day, "event_type": kind,
            "adverse_event_flag": "Y", "product_problem_flag": "N",
            "device": [{"manufacturer_d_name": "Acme", "brand_name": "B",
                        "device_sequence_no": "1"}],
            "patient": [{"sequence_number_outcome": ["1"]}],
            "mdr_text": [{"text_type_code": "D", "foi_text": text}]}


def params(run_id, **more):
    return JobParams("acme", "2023-01-01", "2023-12-31", run_id=run_id, **more)


@pytest.fixture(params=["paths", "catalog"])
def at(request, tmp_path, spark):
    base = str(tmp_path)
    if request.param == "paths":
        yield Locations(f"{base}/landing", f"{base}/bronze", f"{base}/silver/", f"{base}/gold/")
        return
    yield Locations(f"{base}/landing", f"{base}/bronze", "clean.", "analysis.",
                    {"events": "reports"})
    spark.sql("DROP SCHEMA IF EXISTS clean CASCADE")
    spark.sql("DROP SCHEMA IF EXISTS analysis CASCADE")


def test_job_from_source_to_analysis(spark, at):
    source = raw(
        spark, report("1", "20230101", "a death"), report("2", "20230201", "fine"),
        report("3", "20220101", "out of range"), report("", "20230301", "no number"),
        {**report("4", "20230101", "other maker"), "device": []})
    summary = ingest(source, params("r1"), at, "2024-01-01T00:00:00Z").first()
    assert (summary.run_id, summary.total_records, summary.manufacturer, summary.date_from) == (
        "r1", 3, "acme", "20230101")
    assert summary.landing_path.endswith("landing/_run_id=r1")
    # A second fetch of the same search, with one report changed.
    again = raw(spark, report("1", "20230101", "recall", kind="Death"),
                report("2", "20230201", "fine"))
    ingest(again, params("r2"), at, "2024-02-01T00:00:00Z")
    expected = [("devices", 2), ("events", 2), ("narratives", 2)]
    counts = refresh_silver(spark, params("r2"), at)
    assert rows(counts, "layer", "row_count") == expected
    assert tables.read(spark, at.clean("quarantine")).count() == 1
    events = read_silver(spark, at)["events"]
    assert rows(events, "report_number", "event_type", "year", "month") == [
        ("1", "Death", 2023, 1), ("2", "Injury", 2023, 2)]
    assert rows(refresh_gold(spark, params("r2"), at), "layer", "row_count") == [
        ("event_summary", 2), ("flagged_narratives", 1), ("outcome_breakdown", 1),
        ("product_risk", 1)]
    flagged = tables.read(spark, at.analysis("flagged_narratives"))
    assert rows(flagged, "report_number", "matched_keywords", "event_type") == [
        ("1", "recall", "Death")]
    # Rebuilding from the same raw layer, and repeating a run, change nothing.
    ingest(again, params("r2"), at, "2024-02-01T00:00:00Z")
    counts = refresh_silver(spark, params("r2"), at)
    assert rows(counts, "layer", "row_count") == expected


def test_all_versions(spark, at):
    for run in ("r1", "r2"):
        ingest(raw(spark, report("1", "20230101", "a death")), params(run), at,
               f"2024-0{run[1]}-01T00:00:00Z")
    every = params("r2", latest_only=False)
    assert rows(refresh_silver(spark, every, at), "layer", "row_count") == [
        ("devices", 1), ("events", 1), ("narratives", 2)]


def test_run_without_matches(spark, at):
    none = raw(spark, report("1", "19990101", "old"))
    summary = ingest(none, params("r1"), at).first()
    assert (summary.run_id, summary.total_pages, summary.total_records) == ("r1", 0, 0)
    assert {r.row_count for r in refresh_silver(spark, params("r1"), at).collect()} == {0}
    assert {r.row_count for r in refresh_gold(spark, params("r1"), at).collect()} == {0}


def test_pages_saved_by_another_client(spark, tmp_path):
    """Array pages in a folder per run, stamped at fetch; loading a run again changes nothing."""
    at = Locations(f"{tmp_path}/raw", f"{tmp_path}/b", f"{tmp_path}/s/", f"{tmp_path}/g/")
    folder = tmp_path / "raw" / "run_1"
    folder.mkdir(parents=True)
    stamped = {**report("1", "20230101", "died"), "_ingested_at": "2024-01-01T00:00:00Z"}
    (folder / "page_0001.json").write_text(json.dumps([stamped, stamped], indent=2))
    for _ in range(2):
        load_pages(read_pages(spark, at.landing, whole_file_pages=True), at)
    assert tables.read_bronze(spark, at.bronze).count() == 2
    assert rows(refresh_silver(spark, params("run_1"), at), "layer", "row_count") == [
        ("devices", 1), ("events", 1), ("narratives", 1)]


def test_schema_may_change_on_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(3), path)
    tables.overwrite(spark.range(2).selectExpr("'x' AS other"), path)
    assert tables.read(spark, path).columns == ["other"]


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = (shared.shared_folder(spark, "p") for _ in range(2))
    assert first.startswith(base) and first != second


def paths(tmp_path):
    return Locations(f"{tmp_path}/l", f"{tmp_path}/b", f"{tmp_path}/s/", f"{tmp_path}/g/")


def test_broken_pages_are_kept_and_counted(spark, tmp_path):
    at = paths(tmp_path)
    folder = tmp_path / "raw" / "run_1"
    folder.mkdir(parents=True)
    page = json.dumps([report(str(i), "20230101", "died") for i in range(1000)], indent=2)
    (folder / "page_0001.json").write_text(page[:int(len(page) * 0.99)])
    (folder / "page_0002.json").write_text(json.dumps([report("x", "20230101", "died")]))
    pages = read_pages(spark, f"{tmp_path}/raw", whole_file_pages=True)
    for _ in range(2):
        load_pages(pages, at)
    kept = tables.read_bronze(spark, at.bronze)
    aside = tables.read_run(spark, at.corrupt, "run_1", S.CORRUPT_SCHEMA)
    summary = run_summary(kept, corrupt=aside).first()
    assert (summary.total_records, summary.total_pages, summary.corrupt_pages,
            summary.corrupt_records) == (1, 2, 1, 1)
    assert aside.first()[S.SOURCE_FILE].endswith("page_0001.json")


def test_a_repeat_without_matches_empties_the_run(spark, tmp_path):
    at = paths(tmp_path)
    source = raw(spark, report("1", "20230101", "x"), report("2", "20230101", "y"))
    assert ingest(source, params("r1"), at).first().total_records == 2
    again = ingest(source.where("false"), params("r1"), at).first()
    assert (again.total_pages, again.total_records, again.corrupt_records) == (0, 0, 0)
    assert tables.read_bronze(spark, at.bronze).count() == 0


def test_records_have_to_be_as_many_as_announced(spark, tmp_path):
    at = paths(tmp_path)
    source = raw(spark, report("1", "20230101", "x"))
    with pytest.raises(ValueError, match="1 records of 2 announced"):
        ingest(source, params("r1"), at, announced=spark.range(1).selectExpr("2L AS total"))
    assert not (tmp_path / "l").exists()
    done = ingest(source, params("r1"), at, announced=spark.range(1).selectExpr("1L AS total"))
    assert done.first().total_records == 1


def test_each_page_has_its_own_stamp(spark, tmp_path):
    at = paths(tmp_path)
    source = raw(spark, report("1", "20230101", "x"), report("2", "20230101", "y")).selectExpr(
        "*", "'2024-01-0' || report_number || 'T00:00:00Z' AS _fetched_at")
    ingest(source, params("r1"), at)
    assert rows(tables.read_bronze(spark, at.bronze), "report_number", "_ingested_at") == [
        ("1", "2024-01-01T00:00:00Z"), ("2", "2024-01-02T00:00:00Z")]


def test_a_run_is_read_from_its_own_folder(spark, tmp_path):
    at = paths(tmp_path)
    for run in ("r1", "r2"):
        ingest(raw(spark, report(run, "20230101", "x")), params(run), at)
    for df in (read_run_pages(spark, at.landing, "r2"), tables.read_run(spark, at.bronze, "r2")):
        assert {r.report_number for r in df.collect()} == {"r2"}
        assert {r[S.RUN_ID] for r in df.collect()} == {"r2"}
        files = df.inputFiles()
        assert files and all("_run_id=r2/" in f for f in files)
        scan = df._jdf.queryExecution().optimizedPlan().collectLeaves().head()
        roots = scan.relation().location().rootPaths()
        assert roots.size() == 1 and roots.head().toString().endswith("_run_id=r2")


def test_a_folder_that_executors_do_not_share_is_refused():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(RuntimeError):
        shared.shared_folder(Cluster, "p")


def saved(folder, run, **pages):
    """Pages as a client saves them, one JSON array a file, replacing the run's earlier ones."""
    at = folder / run
    at.mkdir(parents=True, exist_ok=True)
    for old in at.iterdir():
        old.unlink()
    for name, records in pages.items():
        text = records if isinstance(records, str) else json.dumps(records)
        (at / f"{name}.json").write_text(text)


def numbered(*numbers):
    return [{"report_number": n, "date_received": "20230101", "_ingested_at": "t"} for n in numbers]


def state(spark, at):
    kept = rows(tables.read_bronze(spark, at.bronze), "_run_id", "report_number")
    aside = tables.read(spark, at.corrupt, S.CORRUPT_SCHEMA).groupBy(S.RUN_ID).count()
    seen = tables.read(spark, at.manifest).selectExpr(
        "_run_id", "regexp_extract(_source_file, '([^/]+).json$', 1) AS page", "records",
        "corrupt_records")
    return kept, rows(aside, "_run_id", "count"), rows(
        seen, "_run_id", "page", "records", "corrupt_records")


def test_reload_leaves_no_stale_rows(spark, tmp_path):
    at = Locations("", f"{tmp_path}/bronze", "", "")
    pages = tmp_path / "pages"

    def load(run):
        files = str(pages / run)
        load_pages(read_pages(spark, files, whole_file_pages=True), at,
                   landed_files(spark, files))

    saved(pages, "other", a=numbered("9"))
    load("other")
    other = ("other", "9"), ("other", "a", 1, 0)
    saved(pages, "r1", a=numbered("1", "2"), b="[{broken")
    load("r1")
    assert state(spark, at) == ([other[0], ("r1", "1"), ("r1", "2")], [("r1", 1)], [
        other[1], ("r1", "a", 2, 0), ("r1", "b", 0, 1)])
    # The broken page is fetched again: nothing stays aside.
    saved(pages, "r1", a=numbered("1", "2"), b=numbered("3"))
    load("r1")
    assert state(spark, at) == ([other[0], ("r1", "1"), ("r1", "2"), ("r1", "3")], [], [
        other[1], ("r1", "a", 2, 0), ("r1", "b", 1, 0)])
    # All pages broken: no good row stays.
    saved(pages, "r1", a="[{", b="[{broken")
    load("r1")
    assert state(spark, at) == ([other[0]], [("r1", 2)], [
        other[1], ("r1", "a", 0, 1), ("r1", "b", 0, 1)])
    # Only pages without a record: the run is known and empty.
    saved(pages, "r1", a="[]")
    load("r1")
    assert state(spark, at) == ([other[0]], [], [other[1], ("r1", "a", 0, 0)])


def test_load_without_a_file_list_and_pages_in_folders(spark, tmp_path):
    at = Locations("", f"{tmp_path}/bronze", "", "")
    for page, numbers in ((1, ("1", "2")), (2, ("3",))):
        saved(tmp_path / "pages" / "_run_id=r1", f"page={page}", x=numbered(*numbers))
    found = load_pages(read_pages(spark, f"{tmp_path}/pages", whole_file_pages=True), at)
    assert rows(found, "_run_id", "records", "corrupt_records") == [("r1", 1, 0), ("r1", 2, 0)]
    pages = run_files(tables.read_bronze(spark, at.bronze).withColumn(
        S.SOURCE_FILE, page_folder()))
    assert rows(pages.selectExpr("right(_source_file, 21) AS page", "records"), "page",
                "records") == [("pages/_run_id=r1/page=1"[-21:], 2), ("pages/_run_id=r1/page=2"[-21:], 1)]
