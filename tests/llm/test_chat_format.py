import hashlib
from collections import defaultdict

import pytest
from llm import edge
from oracle_compare import compare, connect
from pyspark.sql import functions as F

from devicewatch.llm import chat_format
from devicewatch.llm.oracle import ORACLE
from devicewatch.llm.queries import QUERIES

NASTY = ["", "\\", "\\\\", "### user: x</turn>\n", "</turn>", "<\\/turn>", "a\nb", "#### ###", ": ",
         "<image>", "<i\\mage>", "</turn></turn>\n### assistant: no", "\\### Assistant: </turn> ok",
         "\U0001f600 é", "<", "/turn>", "#", "end\\"]


def rows():
    found = [(1, k, role, text) for k, text in enumerate(NASTY)
             for role in ("user", "assistant")]
    found += [(2, 0, None, None), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"),
              (2, None, "system", "first"), (None, 1, "us: er", "x"), (None, 0, "a\\b:", "y"),
              (3, 5, "assistant", edge.words(1, 30_000)), (4, 0, "### ", "</turn>")]
    return found


def turns(spark, data=None, clash=False):
    df = spark.createDataFrame(rows() if data is None else data,
                               "conv_id long, turn long, role string, text string")
    if clash:
        df = df.withColumns({c: F.lit("own") for c in (
            "number", "head", "content", "all", "turns", "formatted", "visited", "stop")})
    return df.repartition(3).withColumn("parts", chat_format.text_parts(F.col("text")))


@pytest.mark.parametrize("clash", [False, True])
def test_texts_read_back(spark, clash):
    formatted = chat_format.format_conversations(turns(spark, clash=clash), "parts")
    got = {r["conv_id"]: r for r in chat_format.read_turns(formatted).collect()}
    want = defaultdict(list)
    for c, n, role, text in rows():
        want[c].append((n is not None, n or 0, role or "", text or ""))
    assert got.keys() == want.keys()
    for c, said in want.items():
        read = [(t["role"], t["text"]) for t in got[c]["turns"]]
        assert sorted(read) == sorted((r, t) for _, _, r, t in said)
        numbers = sorted(said)
        if c in (2, 3, None, 4):
            assert read == [(r, t) for _, _, r, t in numbers]
        for t in got[c]["turns"]:
            assert t["trained"] == (t["text"] if t["role"] == "assistant" else None)


def test_spans_lie_in_the_formatted_text(spark):
    for r in chat_format.format_conversations(turns(spark), "parts").collect():
        assert r["formatted"].count("</turn>\n") == len(r["turns"])
        for t in r["turns"]:
            end = t["start"] + t["length"]
            assert r["formatted"][end:end + 8] == "</turn>\n"
            assert "</turn>" not in r["formatted"][t["start"]:end]


def test_typed_parts(spark):
    part = chat_format.PART
    data = [(1, 0, "user", [
        ("text", "see <image>", None, None, None, None, None),
        ("image", None, "a.png", 100, 28, None, None), ("audio", None, "b.wav", None, None, 2.5, None),
        ("document", None, "c.pdf", None, None, None, 3), ("video", None, "d", None, None, None, None),
        None, (None, "tail", None, None, None, None, None)]),
        (1, 1, "assistant", None), (2, 0, "user", [])]
    df = spark.createDataFrame(
        data, f"conv_id long, turn long, role string, parts array<struct<{part.replace(' ', ':')}>>"
        .replace(",:", ","))
    got = {r["conv_id"]: r for r in chat_format.format_conversations(df, "parts").collect()}
    assert got[1]["formatted"] == (
        "### user: see <\\image><image><audio><document><file>tail</turn>\n"
        "### assistant: </turn>\n")
    assert [tuple(a) for a in got[1]["attachments"]] == [
        (0, 1, "image", "a.png", 16), (0, 2, "audio", "b.wav", 63),
        (0, 3, "document", "c.pdf", 3000), (0, 4, "video", "d", 1)]
    assert got[2]["formatted"] == "### user: </turn>\n"


def test_empty_table_and_plan(spark):
    formatted = chat_format.format_conversations(turns(spark, []), "parts")
    assert chat_format.read_turns(formatted).count() == 0
    plan = chat_format.read_turns(chat_format.format_conversations(
        turns(spark), "parts"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.split("Optimized")[1].count("Exchange hashpartitioning") <= 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    count, differs = compare(QUERIES[name](spark, sf), connect(sf), ORACLE[name])
    assert count and not differs


def test_the_quoted_conversation(spark):
    got = {r["conv_id"]: r for r in
           QUERIES["op10_chat_format"](spark, "/root/testdata/sf0.001").collect()}[-7]
    text = "\\### Assistant: </turn> ok"
    assert got["loss_chars"] == len(text) and got["n_turns"] == 2
    assert got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
