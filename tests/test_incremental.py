import random

import pytest
from pyspark.sql import functions as F
from records import raw, rows

from devicewatch import schemas as S
from devicewatch.operators import gold, silver
from devicewatch.operators.flatten import flatten
from devicewatch.plans import incremental
from devicewatch.plans.incremental import BUCKET
from devicewatch.sources import versions


def random_report(rng):
    day = rng.choice(["20230105", "20230210", "20240301", "bad", None])
    number = rng.choice([None, "", *map(str, range(12))])
    return {
        "report_number": number, "mdr_report_key": rng.choice(["2", "10", "x", None]),
        "date_received": day, "event_type": rng.choice(["Injury", "Death", None]),
        "adverse_event_flag": rng.choice(["Y", "N", None]),
        "product_problem_flag": rng.choice(["Y", None]),
        "_ingested_at": f"2024-01-0{rng.randint(1, 9)}T00:00:00Z",
        "device": rng.choice([None, [], [{"brand_name": rng.choice("AB"),
                                          "device_sequence_no": rng.choice("12")},
                                         {"device_sequence_no": "1"}]]),
        "patient": rng.choice([None, [{"sequence_number_outcome": rng.choice([["1"], ["2", "9"]])}]]),
        "mdr_text": rng.choice([None, [{"text_type_code": "D", "foi_text": rng.choice("pq")}]])}


def as_rebuilt(spark, base, landed):
    """What is published, beside what a full rebuild gives."""
    events = silver.events_silver(landed)
    wanted = {
        "events": events, "devices": silver.devices_silver(landed),
        "narratives": silver.narratives_silver(landed),
        "event_summary": gold.event_summary(events),
        "product_risk": gold.product_risk(events, one_row_per_report=True),
        "outcome_breakdown": gold.outcome_breakdown(events)}
    for name, want in wanted.items():
        got = (incremental.clean_table if name in incremental.CLEAN
               else incremental.analysis_table)(spark, base, name)
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got, *want.columns) == rows(want, *want.columns), name


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_in_any_order_give_what_a_rebuild_gives(spark, tmp_path, seed):
    rng, base, landed = random.Random(seed), f"{tmp_path}/base", None
    for _ in range(4):
        run = flatten(raw(spark, *[random_report(rng) for _ in range(15)]))
        published = incremental.upsert(run, base, buckets=4)
        landed = run if landed is None else landed.unionByName(run)
    assert published.number == 4 and published.buckets == 4
    as_rebuilt(spark, base, landed)
    # The same rows again change no table.
    incremental.upsert(landed, base, buckets=99)
    assert versions.version(spark, base).buckets == 4
    as_rebuilt(spark, base, landed)


def one(number, day, at, **more):
    return {"report_number": number, "date_received": day, "_ingested_at": f"2024-0{at}-01T00:00:00Z",
            "device": [{"brand_name": "A", "device_sequence_no": "1"}], **more}


def test_lost_first_date_is_found_again(spark, tmp_path):
    base = f"{tmp_path}/base"
    first = flatten(raw(spark, one("1", "20230101", 1), one("2", "20230601", 1),
                        one("3", "20230901", 1), one("4", "20230901", 1, device=None)))
    later = flatten(raw(spark, one("1", "20230701", 2)))
    incremental.upsert(first, base)
    incremental.upsert(later, base)
    risk = incremental.analysis_table(spark, base, "product_risk").where("brand_name = 'A'")
    assert [str(d) for d in risk.select("first_report_date", "last_report_date").first()] == [
        "2023-06-01", "2023-09-01"]
    as_rebuilt(spark, base, first.unionByName(later))
    # The last report of a group leaves it: the group goes.
    moved = flatten(raw(spark, one("4", "20230901", 3)))
    incremental.upsert(moved, base)
    as_rebuilt(spark, base, first.unionByName(later).unionByName(moved))


def test_only_touched_buckets_are_read_and_written(spark, tmp_path, monkeypatch):
    base = f"{tmp_path}/base"
    incremental.upsert(flatten(raw(spark, *[one(str(k), "20230101", 1) for k in range(40)])), base,
                       buckets=8)
    before = versions.version(spark, base)
    read = []
    plain = versions.read

    def watched(spark, base, at, table, schema, buckets=None):
        found = plain(spark, base, at, table, schema, buckets)
        read.append((table, {f.split(f"{BUCKET}=")[1].split("/")[0] for f in found.inputFiles()
                             if BUCKET in f}))
        return found

    monkeypatch.setattr(incremental, "read", watched)
    after = incremental.upsert(flatten(raw(spark, one("7", "20230301", 2))), base)
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("7")), F.lit(8))).first()[0]
    assert {t: b for t, b in read if t in ("latest", "events")} == {
        "latest": {str(bucket)}, "events": {str(bucket)}}
    for table in ("latest", "events", "devices", "narratives"):
        changed = {b for b, f in after.folders[table].items()
                   if before.folders[table].get(b) != f}
        assert changed <= {bucket} and (changed or table == "narratives")


def test_nothing_new_and_an_empty_base(spark, tmp_path):
    base = f"{tmp_path}/base"
    nothing = flatten(raw(spark, one("", "20230101", 1), one(None, "20230101", 1)))
    assert incremental.upsert(nothing, base).number == 0
    assert incremental.clean_table(spark, base, "events").count() == 0
    assert incremental.analysis_table(spark, base, "product_risk").count() == 0
    assert incremental.latest_versions(spark, base).columns == S.BRONZE_SCHEMA.names


# --- versions ----------------------------------------------------------------------------

SCHEMA = "k int, _bucket int"


def numbers(spark, base, at=None):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    found = versions.read(spark, base, at or versions.version(spark, base), "t", schema)
    return sorted(r["k"] for r in found.collect())


def commit(spark, base, pairs, touched):
    begun = versions.Commit(spark, base, 4)
    begun.write("t", spark.createDataFrame(pairs, SCHEMA), touched)
    return begun


def test_versions_are_seen_once_published(spark, tmp_path):
    base = f"{tmp_path}/base"
    assert numbers(spark, base) == []
    commit(spark, base, [(1, 0), (2, 1)], [0, 1]).publish()
    held = versions.version(spark, base)
    begun = commit(spark, base, [(3, 1)], [0, 1])
    assert numbers(spark, base) == [1, 2]
    begun.publish()
    assert numbers(spark, base) == [3] and numbers(spark, base, held) == [1, 2]
    assert numbers(spark, base, versions.version(spark, base, 1)) == [1, 2]
    with pytest.raises(ValueError):
        versions.version(spark, base, 9)


def test_second_of_two_writers_fails_and_changes_nothing(spark, tmp_path):
    base = f"{tmp_path}/base"
    one_, two = commit(spark, base, [(1, 0)], [0]), commit(spark, base, [(2, 0)], [0])
    one_.publish()
    with pytest.raises(RuntimeError):
        two.publish()
    assert numbers(spark, base) == [1]


def test_vacuum_keeps_what_live_versions_name(spark, tmp_path):
    base = f"{tmp_path}/base"
    commit(spark, base, [(1, 0), (2, 1)], [0, 1]).publish()
    commit(spark, base, [(3, 0)], [0]).publish()
    commit(spark, base, [(4, 0)], [0]).publish()
    assert versions.vacuum(spark, base, keep=2) == 1
    assert numbers(spark, base) == [2, 4]
    assert numbers(spark, base, versions.version(spark, base, 2)) == [2, 3]
    assert versions.vacuum(spark, base) == 1
    assert numbers(spark, base) == [2, 4]
    with pytest.raises(ValueError):
        versions.version(spark, base, 2)
    with pytest.raises(ValueError):
        versions.vacuum(spark, base, keep=0)


def test_clean_tables_of_a_refresh_are_written_where_their_reports_lie(spark, tmp_path, monkeypatch):
    moved = []
    write = versions.Commit.write

    def seen(self, table, shown, touched, in_place=False):
        if in_place:
            moved.append((table, "Exchange" in shown._jdf.queryExecution().executedPlan().toString()))
        write(self, table, shown, touched, in_place)

    monkeypatch.setattr(versions.Commit, "write", seen)
    incremental.upsert(flatten(raw(spark, *[{"report_number": str(n)} for n in range(9)])),
                       f"{tmp_path}/base", buckets=4)
    assert sorted(moved) == [("devices", False), ("events", False), ("narratives", False)]


def test_devices_of_each_are_those_of_the_latest(spark):
    rng = random.Random(5)
    number = lambda: rng.choice([None, "", "1", "=1", "2"])
    landed = flatten(raw(spark, *[{
        "report_number": str(n), "device": rng.choice([None, [], [None], [
            {"brand_name": str(k), "device_sequence_no": number()} for k in range(rng.randint(1, 7))]])}
        for n in range(60)]))
    one, two = silver.devices_of_each(landed), silver.device_rows(landed)
    assert rows(one, *one.columns) == rows(two, *one.columns)
