import hashlib
import random

import pytest
from pyspark.sql import functions as F

from devicewatch.llm import prefix_trie, queries

COLUMNS = [f.split()[0] for f in prefix_trie.NODE.split(", ")]


def brute(sequences):
    """All nodes of conversations given as lists of (identity, size)."""
    members, sizes = {}, {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            key = tuple(t for t, _ in turns[:d])
            members.setdefault(key, set()).add(conv)
            sizes[key] = turns[d - 1][1] if d else 0
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[c] for c in below) or 1
        saved[key] = (len(members[key]) - 1) * sizes[key] + sum(saved[c] for c in below)
    rows = []
    for key, convs in members.items():
        ends = sorted(c for c in convs if len(sequences[c]) == len(key))
        rows.append((
            min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs),
            len(children.get(key, [])), leaves[key], saved[key],
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


def turn_rows(sequences):
    rows = []
    for conv, turns in sequences.items():
        rows += [(conv, d, t, s) for d, (t, s) in enumerate(turns)] or [(conv, None, None, None)]
    return rows


def check(spark, sequences, **options):
    turns = spark.createDataFrame(turn_rows(sequences), "conv long, place long, said string, size int")
    turns = turns.withColumn("slab", F.lit("own")).repartition(3)
    got = prefix_trie.prefix_trie(turns, key_cols=["said"], **options)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(sequences)


def dialogue(rng, most):
    return [(rng.choice("ab"), rng.randint(0, 9)) for _ in range(rng.randint(0, most))]


def sized(sequences):
    """Equal turns at one depth have one size."""
    return {c: [(t, (ord(t[0]) + d) % 7) for d, (t, _) in enumerate(turns)]
            for c, turns in sequences.items()}


@pytest.mark.parametrize("seed, rows", [(1, 50_000), (2, 7), (3, 1)])
def test_random_conversations(spark, seed, rows):
    rng = random.Random(seed)
    sequences = {rng.randint(-99, 999): dialogue(rng, 6) for _ in range(200)}
    check(spark, sized(sequences), rows=rows)


@pytest.mark.parametrize("rows", [50_000, 3])
def test_long_conversations_span_slabs(spark, rows):
    rng = random.Random(4)
    trunk = [(c, 0) for c in rng.choices("ab", k=3 * prefix_trie.SLAB)]
    sequences = {k: trunk[:rng.choice([0, 5, 31, 32, 33, 64, 65, 96])] + dialogue(rng, 40)
                 for k in range(60)}
    sequences |= {100 + k: trunk[:64] for k in range(5)} | {200: trunk[:32], 201: []}
    check(spark, sized(sequences), rows=rows)


def test_many_copies_over_many_shards(spark):
    sequences = {k: [("a", 3), ("b", 4)] if k % 3 else [("a", 3), (str(k), 5)] for k in range(300)}
    check(spark, sequences, rows=10)


def test_only_conversations_without_turns(spark):
    check(spark, {3: [], 1: [], 2: []}, rows=1)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(prefix_trie.number_turns(empty)).collect() == []
    assert prefix_trie.prefix_trie(queries.rebuilt_turns(empty)).collect() == []


def test_turns_are_numbered_in_order(spark):
    rows = [(1, 5, "user", "e"), (1, None, "user", "first"), (1, 2, None, "b"), (1, 2, "a", "z"),
            (1, 2, "a", "y"), (1, 2, "a", "y"), (2, 0, "user", None), (None, 0, "user", "lost"),
            (1, 2, "b", "x")] + [(7, k // 2, "user", str(k)) for k in range(500)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumns({"conv": F.lit("own"), "place": F.lit(0), "at": F.lit("own")})
    got = prefix_trie.number_turns(turns.repartition(5)).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).digest()
    want = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            want.setdefault(conv, []).append(
                ((turn is not None, turn or 0), role or "", sha(text), len(text or "")))
    found = {}
    for r in got:
        found.setdefault(r["conv"], []).append(
            (r["place"], r["role"], bytes(r["digest"]), r["size"]))
    assert found.keys() == want.keys()
    for conv, turns in want.items():
        assert sorted(found[conv]) == [
            (k, *t[1:]) for k, t in enumerate(sorted(turns))]
