import random

import pytest
from llm import edge

from devicewatch.llm import anchors, suffix_dedup


def brute(rows, n):
    """Spans by (id, text): runs of n words that stand earlier, joined where they meet."""
    seen, found = {}, {}
    for id_, text in sorted(set((i, t or "") for i, t in rows),
                            key=lambda r: (edge.order(r[0]), tie(r[1]))):
        split = text.encode().split()
        spans = []
        for s in range(len(split) - n + 1):
            run = tuple(split[s:s + n])
            if run in seen:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + n
                else:
                    spans.append([s, s + n])
            seen.setdefault(run, id_)
        found[id_, text] = [tuple(s) for s in spans]
    return found


TIES = {}


def tie(text):
    return TIES.get(text, 0)


def check(spark, rows, n, gram, clash=False, **options):
    docs = edge.documents(spark, rows, clash=clash)
    for r in docs.select("text", suffix_dedup._tie(suffix_dedup.whole_text("text"))).collect():
        TIES[r[0] or ""] = r[1]
    got = suffix_dedup.cut_repeats(docs, min_words=n, gram=gram, spans_col="passages",
                                   **options)
    out = got.collect()
    assert len(out) == len(rows)
    assert set(got.columns) == {*docs.columns, "passages"}
    want = brute(rows, n)
    before = sorted((edge.order(i), t or "") for i, t in rows)
    lost = []
    for r in out:
        spans = [(s["start"], s["stop"]) for s in r["passages"] or []]
        lost.append((r["doc_id"], spans, r["text"]))
    for (id_, text), spans in want.items():
        left = suffix_dedup.cut(text, [{"start": a, "stop": b} for a, b in spans])
        assert (id_, spans, left) in [(i, s, t or "") for i, s, t in lost], (id_, spans)
    assert len(before) == len(out)


@pytest.mark.parametrize("clash", [False, True])
def test_edge_rows(spark, clash):
    check(spark, edge.texts(), 50, suffix_dedup.GRAM, clash)


@pytest.mark.parametrize("seed, suffixes", [(1, 20_000), (2, 20_000), (3, 5), (4, 1)])
def test_random_repeats(spark, seed, suffixes):
    rng = random.Random(seed)
    source = [edge.words(k, 60).split() for k in range(12)]
    rows = []
    for k in range(80):
        text = []
        for _ in range(rng.randint(0, 6)):
            part = rng.choice(source)
            a = rng.randint(0, 50)
            text += part[a:a + rng.randint(1, 60)]
            text += edge.words(rng.getrandbits(30), rng.randint(0, 4)).split()
        rows.append((rng.randint(0, 60), rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [(200, " ".join("ab"[k % 2] for k in range(90))), (201, "a " * 70),
             (202, "a " * 70 + "b")]
    check(spark, rows, 8, 3, suffixes=suffixes)


def test_null_ids_and_odd_bytes(spark):
    shared = [edge.words(k, 12).split() for k in range(4)]
    rng = random.Random(9)
    rows = [(None, " ".join(rng.choice(shared) + [rng.choice(["\x01", "a\x01", "a", "\x1f"])]
                            + rng.choice(shared))) for _ in range(60)]
    check(spark, rows + rows[:2], 8, 3, suffixes=7)


def test_clashing_hashes_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(anchors, "MOST_BITS", 64)  # every anchor passes the filter
    index = anchors.WindowIndex(2, own=True)
    monkeypatch.setattr(anchors, "hash", lambda x: 1, raising=False)
    assert index.parse(1, 0, 0, [b"a", b"b", b"c", b"a", b"b"]) == [(3, 5, 1, 0)]
    assert index.parse(2, 0, 7, [b"x", b"b", b"c", b"b"]) == [(8, 10, 1, 1)]


@pytest.mark.parametrize("suffixes", [20_000, 10])
def test_hot_passage_over_many_partitions(spark, suffixes):
    passage = edge.words(1, 60)
    rows = [(k, f"{edge.words(100 + k, 5)} {passage if k % 3 else ''} {edge.words(900 + k, 5)}")
            for k in range(300)]
    check(spark, rows, 50, suffix_dedup.GRAM, suffixes=suffixes)


def test_empty_table(spark):
    docs = edge.documents(spark, [])
    assert suffix_dedup.cut_repeats(docs).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.cut_repeats(docs, min_words=5, gram=6)


def test_cut():
    text = "  a b\tc  d e\n"
    assert suffix_dedup.cut(text, [{"start": 1, "stop": 3}]) == "  a  d e\n"
    assert suffix_dedup.cut(text, [{"start": 0, "stop": 5}]) == "\n"
    assert suffix_dedup.cut(text, []) == text
