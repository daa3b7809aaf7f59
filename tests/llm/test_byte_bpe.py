import codecs
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import edge
from pyspark.sql import functions as F

from devicewatch.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
MACHINE = byte_bpe.transducer(PATH)
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=MACHINE.ranks,
                             special_tokens={})


def ids(text):
    return np.frombuffer(byte_bpe.text_encoder(PATH, PATTERN)(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(text):
    assert ids(text) == TIKTOKEN.encode_ordinary(text)


def test_bytes_follow_the_merges():
    rng, tokens = random.Random(3), list(MACHINE.tokens)
    for _ in range(3000):
        data = b"".join(rng.choices(tokens, k=rng.randint(0, 4))) + bytes(
            rng.choices(range(256), k=rng.randint(0, 3)))
        want = [MACHINE.ranks[p] for p in byte_bpe.merge(data, MACHINE.ranks)]
        assert MACHINE.encode(data) == want


def test_few_states_give_the_same(monkeypatch):
    monkeypatch.setattr(byte_bpe, "_STATES", 50)
    monkeypatch.setattr(byte_bpe, "_PAIRS", 20)
    small = byte_bpe.Transducer(MACHINE.ranks)
    data = edge.words(9, 500).encode()
    assert small.encode(data) == MACHINE.encode(data)
    assert len(small._known) <= 50


def test_pairs():
    rng, tokens = random.Random(8), sorted(MACHINE.tokens, key=MACHINE.ranks.get)
    for _ in range(4000):
        a, b = rng.choices(tokens[:3000], k=2)
        assert MACHINE.may_follow(MACHINE.ranks[a], MACHINE.ranks[b]) == (
            byte_bpe.merge(a + b, MACHINE.ranks) == [a, b])


@pytest.mark.parametrize("size", [1, 2, 5])
def test_stream_of_any_bytes(size):
    rng = random.Random(size)
    table = {k: bytes([k]) for k in range(256)}
    for _ in range(400):
        data = bytes(rng.choices([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xE2, 0x82, 0xAC, 0xED, 0xF0,
                                  0x9F, 0x98, 0xF4, 0x90, 0xFF], k=rng.randint(0, 12)))
        stream = byte_bpe.StreamDecoder(table)
        found = "".join([*[stream.feed(data[k:k + size]) for k in range(0, len(data), size)],
                         stream.end()])
        assert found == data.decode("utf-8", "replace")
        own = codecs.getincrementaldecoder("utf-8")("replace")
        assert found == own.decode(data, True)


@pytest.mark.parametrize("clash", [False, True])
def test_edge_rows(spark, clash):
    docs = edge.documents(spark, clash=clash)
    coded = docs.withColumn("ids", byte_bpe.encode("text", PATH, PATTERN))
    coded = coded.withColumn("back", byte_bpe.decode(F.col("ids"), PATH))
    got = coded.withColumn("both", byte_bpe.encode_and_decode("text", PATH, PATTERN)).collect()
    assert len(got) == len(edge.texts())
    assert all((r["both"]["ids"], r["both"]["text"]) == (r["ids"], r["back"]) for r in got)
    for r in got:
        text = r["text"] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == TIKTOKEN.encode_ordinary(text)
        assert hashlib.sha256(r["back"].encode()).digest() == hashlib.sha256(text.encode()).digest()


def test_empty_table(spark):
    docs = edge.documents(spark, [])
    assert docs.select(byte_bpe.decode(byte_bpe.encode("text", PATH, PATTERN), PATH)).count() == 0
