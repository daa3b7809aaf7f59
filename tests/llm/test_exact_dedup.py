import hashlib
from collections import defaultdict

import pytest
from llm import edge

from devicewatch.llm import exact_dedup


def check(rows, got, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    pick = max if largest else min
    for r in got:
        same = [i for t, ids in groups.items() for i in ids
                if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"]]
        known = [i for i in same if i is not None]
        assert r["group_size"] == len(same)
        assert r["keep_id"] == (pick(known) if known else None)
    kept = [r for r in got if r["kept"]]
    assert sorted(r["text_sha256"] for r in kept) == sorted(
        hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r["id"] == r["keep_id"] for r in kept)
    assert len(got) == len(rows)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("clash", [False, True])
def test_edge_rows(spark, keep, clash):
    docs = edge.documents(spark, clash=clash)
    check(edge.texts(), exact_dedup.exact_groups(docs, keep=keep).collect(), keep == "largest")


def test_hot_text_is_spread_and_whole(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"text {k % 500}") for k in range(3000)]
    docs = edge.documents(spark, rows)
    got = exact_dedup.exact_groups(docs, keep="largest")
    check(rows, got.collect(), True)
    sizes = got.rdd.glom().map(lambda p: sum(r["text_sha256"] == hashlib.sha256(
        b"hot").hexdigest() for r in p)).collect()
    assert max(sizes) < 700  # of 1000


def test_empty_table_and_options(spark):
    empty = edge.documents(spark, [])
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_exact_copies(empty).columns == empty.columns
    with pytest.raises(ValueError):
        exact_dedup.exact_groups(empty, keep="any")


def test_normalise(spark):
    from pyspark.sql import functions as F
    got = exact_dedup.exact_groups(edge.documents(spark), normalise=F.lower).collect()
    assert {r["id"] for r in got if r["keep_id"] == 1} == {1, 2, None, 6}


def test_rows_keep_their_columns(spark):
    docs = edge.documents(spark, clash=True)
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert got.count() == len({t or "" for _, t in edge.texts()})
    assert {r["row"] for r in got.collect()} == {"own row"}


def test_plan_is_native(spark):
    plan = exact_dedup.exact_groups(edge.documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning" in plan
