import random
import re

import numpy as np
import pytest
import xxhash
from llm import edge

from devicewatch.llm import simhash
from devicewatch.llm.components import components


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(rb"[^\x20\x09-\x0D]+", lowered.encode())
    if not found:
        return 0
    shingles = [b" ".join(found[k:k + 4]) for k in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius):
    at = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, p in enumerate(prints):
            low = min(at[j] for j, q in enumerate(prints) if bin(p ^ q).count("1") <= radius)
            if low < at[i]:
                at[i], changed = low, True
    return at


@pytest.mark.parametrize("clash", [False, True])
def test_edge_rows(spark, clash):
    rows = [r for r in edge.texts() if r[1] is None or len(r[1]) < 20_000]
    got = simhash.simhash_groups(edge.documents(spark, rows, clash=clash)).collect()
    assert len(got) == len(rows)
    prints = {(i, brute_print(t)) for i, t in rows}
    assert {(r["id"], r["fingerprint"] % (1 << 64)) for r in got} == prints
    distinct = sorted({p for _, p in prints})
    label = dict(zip(distinct, brute_groups(distinct, 4), strict=True))
    least = {}
    for i, p in prints:
        least.setdefault(label[p], []).append(i)
    for r in got:
        ids = [i for i in least[label[r["fingerprint"] % (1 << 64)]] if i is not None]
        assert r["group_id"] == (min(ids) if ids else None)
    firsts = {(r["id"], r["text_hash"], label[r["fingerprint"] % (1 << 64)])
              for r in got if r["first"]}
    assert len(firsts) == len({f[2] for f in firsts}) == len(set(label.values()))


def test_very_long_text():
    text = edge.words(5, 70_000)
    assert simhash.fingerprint(text) == brute_print(text)


def test_blocks_lose_no_link():
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6)))
              for b in base for _ in range(30)}
    ordered = np.array(sorted(values, key=lambda v: (bin(v).count("1"), v)), dtype="<u8")
    half = [ordered[::2], ordered[1::2]]
    edges = [e for pair in ((half[0], None), (half[1], None), tuple(half))
             for e in simhash.link_blocks(*pair, 4)]
    at = {v: v for v in values}

    def top(v):
        while at[v] != v:
            v = at[v]
        return v

    for a, b in edges:
        assert bin(a ^ b).count("1") <= 4
        at[max(top(a), top(b))] = min(top(a), top(b))
    listed = sorted(values)
    brute = brute_groups(listed, 4)
    assert len(edges) < 2 * len(values)
    assert [top(v) for v in listed] == [listed[k] for k in brute]


def test_small_blocks_agree(spark):
    rows = [(k, edge.words(k // 3, 60) + " x" * (k % 3)) for k in range(150)]
    docs = edge.documents(spark, rows)
    one = {tuple(r) for r in simhash.simhash_groups(docs, radius=12).collect()}
    assert one == {tuple(r) for r in simhash.simhash_groups(docs, radius=12, block=16).collect()}


def test_empty_table(spark):
    empty = edge.documents(spark, [])
    assert simhash.simhash_groups(empty).count() == 0
    assert simhash.drop_near_copies(empty).columns == empty.columns


def test_dropping_keeps_one_of_a_group(spark):
    docs = edge.documents(spark, [r for r in edge.texts() if r[1]], clash=True)
    got = simhash.drop_near_copies(docs)
    assert got.columns == docs.columns
    ids = {r["doc_id"] for r in got.collect()}
    assert 10 in ids and 11 not in ids and 1 in ids and 2 not in ids


def test_components_of_chains_stars_and_loops(spark):
    chain = [(k, k + 1) for k in range(200)]
    star = [(1000, 1000 + k) for k in range(1, 100)]
    df = spark.createDataFrame(chain + star + [(5000, 5000), (-3, -9)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert len({got[k] for k in range(201)}) == 1
    assert len({got[1000 + k] for k in range(100)}) == 1
    assert got[-3] == got[-9] and len(set(got.values())) == 3 and 5000 not in got
    assert components(df.where("a > 1e9")).count() == 0
