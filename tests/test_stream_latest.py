import random

import pytest
from records import raw, rows

from devicewatch import JobParams
from devicewatch.operators.dedup import latest_reports
from devicewatch.operators.flatten import flatten
from devicewatch.sources import landing
from devicewatch.streaming.latest import follow_latest, keep_latest, read_latest

COLUMNS = ["mdr_report_key", "event_type", "_ingested_at"]


def pages(spark, folder, run, reports, file_records=3):
    params = JobParams("acme", "2023-01-01", "2025-12-31", run_id=run, file_records=file_records)
    landing.write_pages(raw(spark, *reports), folder, params)


def versions(seed, n):
    """Reports with many versions, copies, keys that tie or are no numbers, and no number."""
    draw = random.Random(seed)
    return [{"report_number": draw.choice(["a", "b", "c", "d", "", None]),
             "_ingested_at": draw.choice(["2024-01-02T10:00:00Z", "2024-01-02T10:00:00.5Z",
                                          "2024-03-01T00:00:00Z", "no time", None]),
             "mdr_report_key": draw.choice(["9", "10", "x", None]),
             "event_type": draw.choice(["Death", "Injury", None])} for _ in range(n)]


def test_late_and_repeated_versions(spark, tmp_path):
    land, kept, offsets = (str(tmp_path / d) for d in ("land", "kept", "offsets"))

    def follow():
        follow_latest(spark, land, kept, offsets, COLUMNS, max_files_per_batch=2
                      ).awaitTermination()
        return rows(read_latest(spark, kept), "report_number", *COLUMNS)

    everything = []
    for number in range(3):
        new = versions(number, 15)
        everything += new
        pages(spark, land, f"r{number}", new)
        whole = latest_reports(flatten(raw(spark, *everything)))
        assert follow() == rows(whole, "report_number", *COLUMNS)
    assert len(list((tmp_path / "kept").glob("_batch=*"))) > 3
    assert follow() == rows(whole, "report_number", *COLUMNS)  # no new page


def test_latest_of_a_table(spark):
    bronze = flatten(raw(spark, *versions(9, 40)))
    assert rows(keep_latest(bronze, COLUMNS), "report_number", *COLUMNS) == rows(
        latest_reports(bronze), "report_number", *COLUMNS)
    assert keep_latest(bronze.where("false"), COLUMNS).count() == 0


def test_a_broken_page_stops_the_stream_and_no_batch_is_an_error(spark, tmp_path):
    land, kept, offsets = (str(tmp_path / d) for d in ("land", "kept", "offsets"))
    pages(spark, land, "r1", versions(1, 4))
    broken = tmp_path / "land" / "_run_id=r1" / "part-x.txt"
    broken.write_text('{"report_number": "cut')
    with pytest.raises(Exception, match="cannot be parsed"):
        follow_latest(spark, land, kept, offsets, COLUMNS).awaitTermination()
    with pytest.raises(ValueError, match="no batch"):
        read_latest(spark, str(tmp_path / "none"))
