"""Pages that did not arrive, and keywords in a table."""

import random

import pytest
from records import rows

from devicewatch.functions import keywords
from devicewatch.operators.search import fetch_ranges, landed_intervals, missing_pages


def plan(spark, total, limit):
    pages = [(k + 1, k * limit, limit, min(limit, total - k * limit))
             for k in range(-(-total // limit))]
    return spark.createDataFrame(pages, "page_num long, skip long, page_limit int, records long")


def intervals(spark, pairs):
    return spark.createDataFrame(pairs, "skip long, records long")


def brute(total, limit, pairs):
    there = {k for s, n in pairs if s is not None and n and s >= 0 for k in range(s, s + n)}
    gaps, ranges = [], []
    for k in range(total):
        if k in there:
            continue
        page = k // limit + 1
        if gaps and gaps[-1][0] == page and sum(gaps[-1][1:]) == k:
            gaps[-1][2] += 1
        else:
            gaps.append([page, k, 1])
        if ranges and sum(ranges[-1]) == k:
            ranges[-1][1] += 1
        else:
            ranges.append([k, 1])
    return gaps, ranges


@pytest.mark.parametrize("seed", range(3))
def test_gaps_by_brute_force(spark, seed):
    rng = random.Random(seed)
    total, limit = rng.randint(1, 300), rng.choice([1, 7, 50])
    pairs = [(rng.randint(0, 320), rng.randint(0, 60)) for _ in range(rng.randint(0, 12))]
    pairs += [(None, 5), (3, None), (2, 0)] + pairs[:2]
    gaps, ranges = brute(total, limit, pairs)
    got = missing_pages(plan(spark, total, limit), intervals(spark, pairs), limit)
    found = sorted(map(list, got.select("page_num", "skip", "records").collect()))
    assert found == gaps
    assert sorted(map(list, fetch_ranges(got).select("skip", "records").collect())) == ranges
    # Blocks cut ranges and lose nothing.
    cut = fetch_ranges(got, pages_per_block=2).select("skip", "records").collect()
    assert sorted(k for s, n in cut for k in range(s, s + n)) == sorted(
        k for s, n in ranges for k in range(s, s + n))


def test_nothing_planned_and_nothing_landed(spark):
    none = intervals(spark, [])
    assert missing_pages(plan(spark, 0, 10), none, 10).collect() == []
    assert rows(missing_pages(plan(spark, 25, 10), none, 10), "page_num", "skip", "records") == [
        (1, 0, 10), (2, 10, 10), (3, 20, 5)]


def test_intervals_of_landed_pages(spark):
    manifest = spark.createDataFrame(
        [("x/_run_id=r/page=1/a.json", 10), ("x/_run_id=r/page=3/a.json", 4),
         ("x/_run_id=r/page=3/b.json", 3), ("x/_run_id=r/other.json", 9)],
        "_source_file string, records long")
    landed = landed_intervals(manifest, 10)
    assert rows(landed, "skip", "records") == [(0, 10), (20, 7)]
    assert rows(missing_pages(plan(spark, 28, 10), landed, 10), "page_num", "skip", "records") == [
        (2, 10, 10), (3, 27, 1)]


# --- keywords in a table -----------------------------------------------------------------

TEXTS = [(1, "A Device FAILED badly"), (1, "A Device FAILED badly"), (2, None), (3, ""),
         (4, "fail\nfailed again"), (5, "nothing"), (6, "É failÉ"), (7, "x" * 5000 + "end of it")]
TERMS = ["failed", "FAILED", "fail", None, "", "é", "vice f", "\nfa", "d", "end of it", "absent",
         "faile", "gain"]


@pytest.mark.parametrize("sent", [100_000, 0])
def test_terms_of_any_length(spark, monkeypatch, sent):
    monkeypatch.setattr(keywords, "SENT_TERMS", sent)
    texts = spark.createDataFrame(TEXTS, "id int, narrative_text string").selectExpr(
        "*", "'own' AS _row", "'own' AS _term", "'own' AS _gram").repartition(3)
    terms = spark.createDataFrame([(t,) for t in TERMS], "term string")
    got = keywords.flagged_by_table(texts, terms)
    want = []
    wanted = {t.lower() for t in TERMS if t}
    for id_, text in TEXTS:
        hit = sorted(t for t in wanted if text and t in text.lower())
        if hit:
            want.append((id_, text, hit))
    assert got.columns == [*texts.columns, "matched_terms"]
    assert sorted((r["id"], r["narrative_text"], r["matched_terms"]) for r in got.collect()) == want


def test_no_terms_and_no_texts(spark):
    texts = spark.createDataFrame(TEXTS, "id int, narrative_text string")
    terms = spark.createDataFrame([(None,), ("",)], "term string")
    assert keywords.flagged_by_table(texts, terms).collect() == []
    some = spark.createDataFrame([("fail",)], "term string")
    assert keywords.flagged_by_table(texts.limit(0), some).collect() == []


def test_text_is_not_shuffled_for_few_terms(spark):
    texts = spark.createDataFrame(TEXTS, "id int, narrative_text string")
    terms = spark.createDataFrame([("fail",)], "term string")
    plan = keywords.flagged_by_table(texts, terms)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_terms_are_looked_up_by_as_many_letters_as_tell_texts_apart(spark):
    terms = [("Contamination",), ("contains water",), ("contains",), ("cont",), ("con",), ("c",)]
    got = keywords.looked_up(spark.createDataFrame(terms, "term string"), "term")
    assert dict(rows(got, "_term", "_gram")) == {
        "contamination": "contamin", "contains water": "contains", "contains": "contains",
        "cont": "cont", "con": "co", "c": "c"}
