import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm import edge
from tokenizers import Tokenizer

from devicewatch.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_ids_of_whole_texts(name):
    import random
    path = public_tokenizers.path(name)
    whole, encoder, rng = library(path), tokens.library_encoder(path), random.Random(4)
    letters = "'',,..!:;?aaé \t\n\x1c\x85  ​ 　\r'stvemdlrABCéßΣσ́日本１²<|>0123\U0001F600İ"
    cases = [t for _, t in edge.texts() if t] + [
        "".join(rng.choices(letters, k=rng.randint(0, 15))) for _ in range(3000)]
    for text in cases:
        assert np.frombuffer(encoder(text), "<u4").tolist() == whole(text), repr(text)


def test_special_strings_as_in_the_library_or_as_text():
    text = "x <|endoftext|> y"
    assert np.frombuffer(tokens.library_encoder(PATH)(text), "<u4").tolist() == [343, 49407, 344]
    plain = np.frombuffer(tokens.library_encoder(PATH, specials=False)(text), "<u4").tolist()
    assert 49407 not in plain and len(plain) == 8


def test_memo_is_bounded_by_bytes():
    encoder = tokens.Encoder(str.encode, memo=100)
    held = []
    for k in range(3000):
        assert encoder(f"{k} {'z' * (k % 70)}{k}") == f"{k} {'z' * (k % 70)}{k}".encode()
        held.append(encoder._memo.held + sum(map(len, encoder._memo._old)))
    assert max(held) < 3 * 100 * tokens._PIECE_BYTES
    encoder("z" * 100_000)
    assert max(map(len, encoder._memo)) <= tokens._LONGEST


@pytest.mark.parametrize("clash", [False, True])
def test_every_id_in_one_piece(spark, clash):
    docs = edge.documents(spark, clash=clash)
    got = packing.pack(docs, PATH, end=1).collect()
    whole = library(PATH)
    expected = sorted(zlib.crc32(np.array(whole(t) + [1], "<u4").tobytes())
                      for _, t in edge.texts())
    by_doc = defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] > 0
        by_doc[r["id"], r["doc_tokens"]].append(r)
    total = 0
    for (_, size), rows in by_doc.items():
        total += sum(r["length"] for r in rows)
        assert sum(r["length"] for r in rows) % size == 0
    assert total == sum(len(whole(t)) + 1 for _, t in edge.texts())
    single = [zlib.crc32(b"".join(r["ids"] for r in sorted(rows, key=lambda r: r["start"])))
              for (i, _), rows in by_doc.items() if i not in (2, None)]
    assert set(single) <= set(expected)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_little_padding(spark):
    docs = edge.documents(spark, [(k, edge.words(k, 20 + 13 * (k % 90))) for k in range(600)])
    got = packing.pack(docs.coalesce(1), PATH, end=1)
    used = got.groupBy("sequence_id").sum("length").collect()
    total = sum(r[1] for r in used)
    assert (2048 * len(used) - total) / total < 0.03


def test_bins_hold_a_fixed_count():
    packer = packing.Packer(2048, 64, 0)
    bins = [b for k in range(500) for b in packer.add(k, bytes(4 * (1 + (37 * k) % 5000)))]
    assert bins
    for b in bins:
        kind = 2048 // b[0].length
        assert len(b) == kind and {2048 // p.length for p in b} == {kind}
        assert sum(p.length for p in b) <= 2048
        if kind < 32:
            assert sum(p.length for p in b) == 2048
    for b in list(packer.rest())[:-1]:
        assert sum(p.length for p in b) == 2048


def test_empty_table_and_texts(spark):
    assert packing.pack(edge.documents(spark, []), PATH).count() == 0
    docs = edge.documents(spark, [(1, None), (2, ""), (3, "a")])
    assert [r["id"] for r in packing.pack(docs, PATH).collect()] == [3]
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, capacity=8, smallest=16)
