from collections import defaultdict

import numpy as np
from llm import edge
from llm.test_packing import PATH, library
from llm.test_simhash import brute_groups, brute_print
from llm.test_suffix_dedup import brute

import corpus_pipeline
from devicewatch.llm import suffix_dedup

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "language", "exact", "near", "passages", "sequences"]


def test_whole_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    accepted = corpus_pipeline.language(spark, docs, SF)
    rows = sorted((r["doc_id"], r["text"]) for r in accepted.collect())
    assert len(rows) >= 0.99 * docs.count()  # clean documents stay
    first = {}
    for i, t in rows:
        first.setdefault(t, i)
    rows = sorted((i, t) for t, i in first.items())
    distinct = sorted({brute_print(t) for _, t in rows})
    group = dict(zip(distinct, brute_groups(distinct, 4), strict=True))
    first = {}
    for i, t in rows:
        first.setdefault(group[brute_print(t)], (i, t))
    rows = sorted(first.values())
    spans = brute(rows, 50)
    assert any(spans.values())
    whole, want = library(PATH), {}
    for i, t in rows:
        left = suffix_dedup.cut(t, [{"start": a, "stop": b} for a, b in spans[i, t]])
        if left.split() or not spans[i, t]:
            want[i] = whole(left) + [1]
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces[r["doc_id"]].append((r["start"], r["ids"]))
    got = {i: np.frombuffer(b"".join(x for _, x in sorted(p)), "<u4").tolist()
           for i, p in pieces.items()}
    assert got == want


def test_each_stage_keeps_the_columns(spark):
    for clash in (False, True):
        docs = edge.documents(spark, clash=clash)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count(), name
        assert corpus_pipeline.sequences(spark, docs, SF).count()


def test_each_stage_takes_an_empty_table(spark):
    docs = edge.documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_rejected_and_emptied_documents_go(spark):
    passage = edge.words(1, 60)
    docs = edge.documents(spark, [
        (1, passage + " tail"), (2, passage), (3, "12 ! 34"), (4, None), (5, "")])
    kept = corpus_pipeline.language(spark, docs, SF)
    assert {3, 4, 5}.isdisjoint(r["doc_id"] for r in kept.collect())
    left = {r["doc_id"]: r for r in corpus_pipeline.passages(
        spark, docs.where("doc_id < 3"), SF).collect()}
    assert set(left) == {1} and left[1]["n_chars"] == len(left[1]["text"])
