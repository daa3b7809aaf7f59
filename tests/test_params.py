import re
from datetime import date

import pytest

from devicewatch import JobParams, new_run_id
from devicewatch.functions.keywords import checked
from devicewatch.params import compact_date


def test_dates_are_normalised():
    params = JobParams("acme", "2023-01-01", "20251231")
    assert (params.date_from, params.date_to) == ("20230101", "20251231")
    assert compact_date(date(2023, 2, 3)) == "20230203"


@pytest.mark.parametrize("text", ["2023-1-1", "2023-13-01", "yesterday", "202301011"])
def test_bad_dates_are_refused(text):
    with pytest.raises(ValueError):
        compact_date(text)


def test_values_out_of_range_are_refused():
    assert JobParams("a", "20230101", "20230102", page_limit=2).page_limit == 2
    assert JobParams("a", "20230101", "20230102").page_limit == 1000
    for bad in ({"page_limit": 0}, {"page_limit": 1001}, {"file_records": 0},
                {"manufacturer": ""}, {"manufacturer": "  "}, {"run_id": "a/b"}):
        with pytest.raises(ValueError):
            JobParams(**{"manufacturer": "a", "date_from": "20230101", "date_to": "20230102",
                         **bad})


def test_overrides_win_and_unknown_keys_are_refused():
    config = {"manufacturer": "a", "date_from": "2023-01-01", "date_to": "2023-12-31"}
    params = JobParams.from_mapping(config, manufacturer="b", date_to=None)
    assert (params.manufacturer, params.date_to) == ("b", "20231231")
    with pytest.raises(ValueError):
        JobParams.from_mapping(config, retries=3)


def test_run_ids():
    assert re.fullmatch(r"run_\d{8}_\d{6}_[0-9a-f]{6}", new_run_id())
    assert new_run_id("x") != new_run_id("x")


@pytest.mark.parametrize("keywords", [(), ("", "a"), "death"])
def test_keywords_must_be_given(keywords):
    with pytest.raises(ValueError):
        checked(keywords)
