import random

import pytest
from llm import edge
from pyspark.sql import functions as F

from devicewatch.llm import anchors, factor_dedup


def split(text):
    return (text or "").encode().split()


def brute(rows, n):
    """Covered word positions by (id, text)."""
    seen = {}
    for id_, text in rows:
        words = split(text)
        for k in range(len(words) - n + 1):
            window = tuple(words[k:k + n])
            seen[window] = min(seen.get(window, (True, 1 << 62)), edge.order(id_))
    found = {}
    for id_, text in rows:
        words = split(text)
        found[id_, text] = {k + i for k in range(len(words) - n + 1)
                            if seen[tuple(words[k:k + n])] < edge.order(id_) for i in range(n)}
    return found


def check(spark, rows, n=50, gram=factor_dedup.GRAM, passages=20_000, clash=False):
    docs = edge.documents(spark, rows, clash=clash)
    got = factor_dedup.drop_repeats(docs, min_words=n, gram=gram, passages=passages,
                                    spans_col="repeats", kept_col="left_over", words_col="total")
    out = got.collect()
    assert set(got.columns) == {*docs.columns, "repeats", "left_over", "total"}
    assert sorted((edge.order(r["doc_id"]), r["text"] or "") for r in out) == sorted(
        (edge.order(i), t or "") for i, t in rows)
    want = brute(rows, n)
    for r in out:
        words, gone = split(r["text"]), want[r["doc_id"], r["text"]]
        spans = [(s["start"], s["stop"]) for s in r["repeats"] or []]
        assert {k for a, b in spans for k in range(a, b)} == gone
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert r["total"] == len(words)
        assert r["left_over"].encode() == b" ".join(
            w for k, w in enumerate(words) if k not in gone)
    return docs


@pytest.mark.parametrize("clash", [False, True])
def test_edge_rows(spark, clash):
    check(spark, edge.texts(), clash=clash)


def mixed(seed, n_rows=80):
    rng = random.Random(seed)
    source = [edge.words(k, 60).split() for k in range(12)]
    rows = []
    for _ in range(n_rows):
        text = []
        for _ in range(rng.randint(0, 6)):
            part = rng.choice(source)
            a = rng.randint(0, 50)
            text += part[a:a + rng.randint(1, 60)]
            text += edge.words(rng.getrandbits(30), rng.randint(0, 4)).split()
        rows.append((rng.choice([None, *range(60)]), rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [(200, " ".join("ab"[k % 2] for k in range(90))), (201, "a " * 70), (202, "a " * 70 + "b")]
    return rows + rows[:3]


@pytest.mark.parametrize("seed, passages", [(1, 20_000), (2, 20_000), (3, 5), (4, 1)])
def test_random_repeats(spark, seed, passages):
    check(spark, mixed(seed), 8, 3, passages)


@pytest.mark.parametrize("passages", [20_000, 10])
def test_passage_of_a_third_of_documents(spark, passages):
    passage, line = edge.words(1, 60), edge.words(2, 30)
    rows = [(k, f"{edge.words(100 + k, 5)} {passage if k % 3 else line} {edge.words(900 + k, 40)}")
            for k in range(300)]
    check(spark, rows, passages=passages)


def test_factors_stand_in_their_source(spark):
    rows = [(i, t) for i, t in mixed(5) if i is not None]
    rows = list({i: (i, t) for i, t in rows}.values())
    texts = {i: split(t) for i, t in rows}
    for passages in (20_000, 4):
        found = factor_dedup.factors(edge.documents(spark, rows), min_words=8, gram=3,
                                     passages=passages).collect()
        assert found
        for f in found:
            size = f["stop"] - f["start"]
            assert size >= 8 and f["source_id"] < f["id"]
            assert texts[f["id"]][f["start"]:f["stop"]] == texts[f["source_id"]][
                f["source_start"]:f["source_start"] + size]


def test_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(anchors, "MOST_BITS", 64)
    check(spark, mixed(6), 8, 3)


def test_hash_clashes_of_windows_change_nothing(monkeypatch):
    block = anchors.WindowIndex(2)
    monkeypatch.setattr(anchors, "hash", lambda x: 1, raising=False)
    assert block.parse(1, 0, 0, [b"a", b"b", b"c", b"d"]) == []
    assert block.parse(2, 0, 10, [b"x", b"c", b"d", b"e"]) == [(11, 13, 1, 2)]
    assert sorted((r[0], r[6], r[7]) for r in block.new_windows()) == [
        (1, b"a b", [0]), (1, b"b c", [1]), (1, b"c d", [2]), (2, b"d e", [12]), (2, b"x c", [10])]


def test_greedy_factors_and_windows_across_them():
    block = anchors.WindowIndex(3)
    block.parse(1, 0, 100, [b"%c" % c for c in b"abcdef"])
    block.parse(2, 0, 200, [b"%c" % c for c in b"defghi"])
    # The longest match from the first word ends at f; the next factor starts across its end.
    assert block.parse(3, 0, 0, [b"%c" % c for c in b"abcdefghi"]) == [
        (0, 6, 1, 100), (4, 9, 2, 201)]


def test_windows_of_one_document_are_sent_once():
    block = anchors.WindowIndex(2)
    assert block.parse(1, 5, 0, [b"a"] * 6) == []
    assert list(block.new_windows()) == [(1, 5, None, None, None, None, b"a a", [0, 1, 2, 3, 4])]


def test_empty_table(spark):
    docs = edge.documents(spark, [])
    assert factor_dedup.drop_repeats(docs).count() == 0
    assert factor_dedup.drop_repeats(edge.documents(spark, [(1, None), (2, "")])).where(
        F.col("n_words") == 0).count() == 2
    with pytest.raises(ValueError):
        factor_dedup.factors(docs, min_words=5, gram=6)
