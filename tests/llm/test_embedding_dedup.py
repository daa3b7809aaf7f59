import numpy as np
import pytest
from pyspark.sql import functions as F

from devicewatch.llm import embedding_dedup
from devicewatch.llm.embedding_dedup import Settings
from devicewatch.llm.queries import QUERIES


def brute(rows, threshold=0.9):
    """Links and smallest reachable id of each row, by all pairs."""
    good = []
    for k, (_, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            good.append(k)
    links, at = [0] * len(rows), list(range(len(rows)))
    near = {}
    for size in {len(rows[k][1]) for k in good}:
        alike = [k for k in good if len(rows[k][1]) == size]
        x = np.array([rows[k][1] for k in alike], dtype=float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        hit = x @ x.T >= threshold
        for a, k in enumerate(alike):
            near[k] = [alike[b] for b in np.nonzero(hit[a])[0]]
            links[k] = len(near[k]) - 1
    big = 1 << 62
    low = [big if i is None else i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for k, others in near.items():
            least = min(low[j] for j in others)
            if least < low[k]:
                low[k], changed = least, True
    return sorted((i if i is not None else big, n, c) for (i, _), n, c in
                  zip(rows, links, low, strict=True))


def listed(df):
    big = 1 << 62
    return sorted((r["id"] if r["id"] is not None else big, r["n_links"],
                   r["component_id"] if r["component_id"] is not None else big)
                  for r in df.collect())


def table(spark, rows, kind="float", clash=False):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    if clash:
        df = df.withColumns({c: F.lit("own") for c in
                             ("id", "vector", "node", "copies", "leaf", "label", "links")})
    return df.repartition(3)


def cloud(n, seed=0, size=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 5, size))
    x = np.repeat(base, 5, axis=0) + 0.15 * rng.normal(size=(n // 5 * 5, size))
    return [(k, v.astype(np.float32).tolist()) for k, v in enumerate(x)]


EDGE = [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0] * 15 + [None]),
        (904, [float("nan")] * 16), (905, [float("inf")] * 16), (906, [1.0, 0.0]),
        (907, [1.0, 0.0]), (908, [2.0, 0.1]), (None, [1.0] * 16), (909, [1.0] * 16),
        (909, [1.0] * 16), (910, [-0.0] * 15 + [1.0]), (911, [0.0] * 15 + [1.0])]


@pytest.mark.parametrize("kind, clash", [("float", False), ("double", True)])
def test_edge_rows(spark, kind, clash):
    rows = cloud(300) + EDGE
    got = embedding_dedup.embedding_groups(table(spark, rows, kind, clash))
    assert listed(got) == brute(rows)
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in got.collect())


def test_trees_and_pieces_count_each_link_once(spark):
    tight = np.random.default_rng(5).normal(size=16)
    rng = np.random.default_rng(6)
    rows = cloud(1500, 1) + [(5000 + k, (tight + 0.02 * rng.normal(size=16)).astype(
        np.float32).tolist()) for k in range(500)]
    few = Settings(leaf=64, task=100, margin=0.08, trees=8)
    assert listed(embedding_dedup.embedding_groups(table(spark, rows), settings=few)) == brute(rows)


def test_copies_stay_one_point(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(3000)] + [(k + 9000, [3.0, -1.0, 0.0])
                                                          for k in range(5)]
    assert listed(embedding_dedup.embedding_groups(table(spark, rows))) == brute(rows)


def test_empty_tables(spark):
    assert embedding_dedup.embedding_groups(table(spark, [])).count() == 0
    only = embedding_dedup.embedding_groups(table(spark, [(1, None), (2, [0.0])]))
    assert listed(only) == [(1, 0, 1), (2, 0, 2)]


def test_recall_on_the_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op3_embedding_dedup"](spark, sf).withColumnRenamed("vec_id", "id")
    want = brute(rows)
    found, all_ = (sum(r[1] for r in x) for x in (listed(got), want))
    assert found <= all_ and found >= 0.99 * all_
    assert all(a[1] <= b[1] for a, b in zip(listed(got), want, strict=True))


@pytest.mark.parametrize("mean", [0.9, 0.92, 0.95])
@pytest.mark.parametrize("leaf", [16, 102])
def test_pairs_of_a_hot_cluster_meet(mean, leaf):
    """Production trees of 100,000 vectors (leaf 102) or more, a third of them in one cluster."""
    rng, size = np.random.default_rng(1), 64

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    heart = unit(rng.normal(size=(1, size)))
    hot = unit(mean ** 0.5 * heart + (1 - mean) ** 0.5 * unit(rng.normal(size=(33_000, size))))
    far = unit(rng.normal(size=(67_000, size)))
    sample = np.concatenate([hot, far])[rng.choice(100_000, 20_000, replace=False)]
    i, j = rng.integers(0, len(hot), (2, 8000))
    near = (np.einsum("ij,ij->i", hot[i], hot[j]) >= 0.9) & (i != j)
    i, j = i[near][:2000], j[near][:2000]
    aside = rng.normal(size=(2000, size))
    aside -= np.einsum("ij,ij->i", far[:2000], aside)[:, None] * far[:2000]
    twin = 0.91 * far[:2000] + (1 - 0.91 ** 2) ** 0.5 * unit(aside)
    ends = np.concatenate([hot[i], far[:2000], hot[j], twin])
    half, met = len(ends) // 2, np.zeros(len(ends) // 2, dtype=bool)
    for k in range(Settings().trees):
        for _, rows in embedding_dedup.Tree(sample, leaf, Settings(), k).route(ends):
            there = np.zeros(len(ends), dtype=bool)
            there[rows] = True
            met |= there[:half] & there[half:]
    assert met[:len(i)].mean() > 0.995 and met[len(i):].mean() > 0.995, (
        met[:len(i)].mean(), met[len(i):].mean())


def test_tasks_of_a_large_leaf_are_dealt_apart(spark):
    points = spark.createDataFrame(
        [(k, np.array(v).tobytes(), 1) for k, (_, v) in enumerate(cloud(200))],
        "node long, vector binary, copies long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = embedding_dedup._leaf_links(points, 200, "double", Settings(task=16))
        plan = links._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    above_join = plan[:plan.index("SortMergeJoin")]
    assert "hashpartitioning(leaf" in above_join and "one#" in above_join.split(
        "hashpartitioning(leaf")[1].split(")")[0]
