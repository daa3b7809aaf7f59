"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits the space by random directions at sampled medians, over and over; vectors within
a margin of a split go to both sides. Vectors are compared inside leaves, all pairs found are
verified by their cosine, and the union over the trees gives the links. A pair that meets in
several leaves counts in the first of them only, so links are counted and joined where they are
found, and pairs are never sent on.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicewatch.llm.components import components
from devicewatch.llm.shared import materialise
from devicewatch.llm.unionfind import Forest


@dataclasses.dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the vectors the trees are fitted on; every vector is indexed.

    ``leaf`` is the number of vectors a leaf aims at. Two vectors at the threshold differ along a
    direction by ``sqrt(2 (1 - threshold) / length)`` (standard deviation); vectors within
    ``spill`` times that of a split, or a given ``margin``, go to both sides. A leaf of more than ``task`` vectors is
    compared piece by piece, in several tasks, in full. A node whose split leaves more than
    ``least_cut`` of it on one side stays a leaf: it is hardly wider than the spill, as a cluster
    of linked vectors is, and cuts through it would part its pairs again and again.
    """

    threshold: float = 0.9
    trees: int = 6
    leaf: int = 512
    spill: float = 0.36
    margin: float | None = None
    sample_rows: int = 20_000
    task: int = 4_096
    least_cut: float = 0.65
    seed: int = 11


class Tree:
    """Directions and cuts of one tree; leaves are numbered in order."""

    def __init__(self, sample: np.ndarray, leaf: int, settings: Settings, number: int) -> None:
        apart = 2 * (1 - settings.threshold) / sample.shape[1]
        self.margin = (settings.spill * max(0.0, apart) ** 0.5 if settings.margin is None
                       else settings.margin)
        self.nodes: list[tuple[np.ndarray, float, int, int] | int] = []
        self.leaves = 0
        rng = np.random.default_rng([settings.seed, number])
        self.nodes.append(0)
        waiting = [(0, np.arange(len(sample)))]
        while waiting:
            at, rows = waiting.pop()
            cut = None
            for _ in range(3 if len(rows) > leaf else 0):
                direction = rng.normal(size=sample.shape[1])
                direction /= np.linalg.norm(direction)
                shadow = sample[rows] @ direction
                middle = float(np.median(shadow))
                low, high = rows[shadow <= middle + self.margin], rows[shadow > middle - self.margin]
                if max(len(low), len(high)) <= settings.least_cut * len(rows):
                    cut = (direction, middle)
                    break
            if cut is None:
                self.nodes[at] = self.leaves
                self.leaves += 1
                continue
            left = len(self.nodes)
            self.nodes += [0, 0]
            self.nodes[at] = (*cut, left, left + 1)
            waiting += [(left, low), (left + 1, high)]

    def route(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf that some rows reach, with the rows."""
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            at, rows = waiting.pop()
            node = self.nodes[at]
            if isinstance(node, int):
                yield node, rows
                continue
            direction, middle, left, right = node
            shadow = vectors[rows] @ direction
            for child, side in ((left, rows[shadow <= middle + self.margin]),
                                (right, rows[shadow > middle - self.margin])):
                if len(side):
                    waiting.append((child, side))


def _units(blobs: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision from blobs of ``<f4`` or ``<f8`` numbers."""
    x = np.array([np.frombuffer(b, dtype=kind) for b in blobs]).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(kind: str):
    """``id``, ``embedding`` to ``id``, ``vector``: its numbers, null where it links with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for value in batch.column(1).to_pylist():
                blob = None
                if value and None not in value:
                    x = np.array(value, dtype=kind) + np.zeros(1, kind)  # -0.0 is 0.0
                    if np.isfinite(x).all() and x.any():
                        blob = x.tobytes()
                blobs.append(blob)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(blobs, type=pa.binary())], names=["id", "vector"])

    return run


def _places(forest: list[Tree], kind: str):
    """Points to one row for each leaf they reach, with all their leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                if part.num_rows:
                    yield from placed(part)

    def placed(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        units = _units(part.column(1).to_pylist(), kind)
        reached: list[list[int]] = [[] for _ in range(len(units))]
        for number, tree in enumerate(forest):
            for leaf, rows in sorted(tree.route(units), key=lambda x: x[0]):
                for row in rows.tolist():
                    reached[row].append((number << 32) + leaf)
        repeat = np.repeat(np.arange(len(units)), [len(r) for r in reached])
        rows = part.take(pa.array(repeat))
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array([x for r in reached for x in r], type=pa.int64()),
             pa.array([reached[k] for k in repeat.tolist()], type=pa.list_(pa.int64()))],
            names=[*rows.schema.names, "leaf", "leaves"])

    return run


def _compare(threshold: float, kind: str):
    """One leaf, or two pieces of a large one, to counts of links and a spanning forest."""
    def run(table: pa.Table) -> pa.Table:
        leaf = table.column("leaf")[0].as_py()
        piece = table.column("piece").to_numpy()
        order = np.argsort(piece, kind="stable")
        table = table.take(pa.array(order))
        first = int((piece == piece[order[0]]).sum())
        units = _units(table.column("vector").to_pylist(), kind)
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        lists = table.column("leaves").to_pylist()
        leaves = np.full((len(lists), max(map(len, lists))), -1, dtype=np.int64)
        for k, found in enumerate(lists):
            leaves[k, :len(found)] = found
        count, forest = np.zeros(len(units), dtype=np.int64), Forest(len(units))
        same = first == len(units)
        if not same and table.column("one")[0].as_py() == table.column("two")[0].as_py():
            raise ValueError("a task of one piece has one piece")
        for top in range(0, first, 256):
            rows = np.arange(top, min(top + 256, first))
            start = top if same else first
            for at in range(start, len(units), 2048):
                i, j = np.nonzero(units[rows] @ units[at:at + 2048].T >= threshold)
                i, j = i + top, j + at
                ahead = i < j
                i, j = i[ahead], j[ahead]
                if len(i):
                    own = _first_met(leaves, i, j, leaf)
                    i, j = i[own], j[own]
                    np.add.at(count, i, copies[j])
                    np.add.at(count, j, copies[i])
                    forest.join(i, j)
        hit = np.nonzero(count)[0]
        a = np.concatenate([node[hit], node[[e[0] for e in forest.edges]]]) if len(hit) else []
        b = [None] * len(hit) + node[[e[1] for e in forest.edges]].tolist() if len(hit) else []
        n = count[hit].tolist() + [None] * len(forest.edges)
        return pa.table({"a": pa.array(a, type=pa.int64()), "b": pa.array(b, type=pa.int64()),
                         "links": pa.array(n, type=pa.int64())})

    return run


def _first_met(leaves: np.ndarray, i: np.ndarray, j: np.ndarray, leaf: int) -> np.ndarray:
    """Which pairs share no leaf before this one (leaves ascend, unused places are -1)."""
    first = np.ones(len(i), dtype=bool)
    for k in range(leaves.shape[1]):
        open_ = np.nonzero(first)[0]
        mine = leaves[i[open_], k]
        open_, mine = open_[(mine >= 0) & (mine < leaf)], mine[(mine >= 0) & (mine < leaf)]
        if not len(open_):
            break
        for c in range(0, len(open_), 65536):
            part = open_[c:c + 65536]
            first[part] = ~(leaves[j[part]] == mine[c:c + 65536, None]).any(axis=1)
    return first


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     settings: Settings = Settings()) -> DataFrame:
    """One row per input row: ``id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors are linked when their cosine, in double precision, is at least the threshold.
    Equal vectors are linked and compared once. ``component_id`` is the smallest id that links
    reach, ``kept`` whether it is the row's own. Vectors that are null, empty, all zero or hold a
    null or non-finite component link with nothing, nor do vectors of different lengths with
    each other. Null ids are larger than others. Other columns, labels among them, are ignored.
    Links are found with high probability, not certainty; none is below the threshold.
    """
    single = vectors.schema[vector_col].dataType.elementType == T.FloatType()
    kind = "<f4" if single else "<f8"
    usable = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<float>" if single else "array<double>")
    ).mapInArrow(_usable(kind), "id long, vector binary")
    rows = materialise(usable.withColumn("node", F.xxhash64("vector")), "embedding-rows")
    points = materialise(
        rows.where("vector is not null").groupBy("node", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")), "embedding-points")

    found = []
    sizes = points.groupBy(F.length("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    for size in sizes.orderBy("size").collect():  # one, unless vectors of several models meet
        alike = points.where(F.length("vector") == size["size"])
        found.append(_leaf_links(alike, size["n"], kind, settings))
    if not found:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = materialise(links, "embedding-links")

    counts = links.where("links is not null").groupBy(F.col("a").alias("node")).agg(
        F.sum("links").alias("links"))
    labels = components(links.where("b is not null").select("a", "b"), "embedding-components")
    known = points.select("node", "copies", "least").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    heads = known.groupBy("label").agg(F.min("least").alias("component_id"))
    nodes = known.join(heads, "label").join(counts, "node", "left").select(
        "node", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = rows.where("vector is not null").select("id", "node").join(nodes, "node").select(
        "id", "n_links", "component_id")
    alone = rows.where("vector is null").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id")))


def _leaf_links(points: DataFrame, total: int, kind: str, settings: Settings) -> DataFrame:
    share = min(1.0, settings.sample_rows / max(1, total)) * (1 << 30)
    sample = (points.where(F.pmod("node", F.lit(1 << 30)) < int(share)).orderBy("node")
              .limit(settings.sample_rows).select("vector").collect())
    units = _units([bytes(r["vector"]) for r in sample], kind)
    leaf = max(16, settings.leaf * len(units) // max(1, total))
    forest = [Tree(units, leaf, settings, k) for k in range(settings.trees)]
    places = materialise(points.select("node", "vector", "copies").mapInArrow(
        _places(forest, kind), "node long, vector binary, copies long, leaf long, leaves array<long>"),
        "embedding-places")
    sizes = places.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
    pieces = F.ceil(F.col("size") / settings.task).cast("int")
    piece = F.pmod(F.xxhash64("node", "leaf"), F.col("pieces")).cast("int")
    split = places.join(sizes.select("leaf", pieces.alias("pieces")), "leaf").withColumn(
        "piece", piece)
    # Piece p takes part in the tasks (p, q) and (q, p): every two pieces meet once.
    others = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    tasks = split.withColumn("other", others).withColumns({
        "one": F.least("piece", "other"), "two": F.greatest("piece", "other")})
    # Rows lie by leaf after the join, which would keep all tasks of a large leaf in one place.
    spread = tasks.drop("pieces", "other").repartition("leaf", "one", "two")
    return spread.groupBy("leaf", "one", "two").applyInArrow(
        _compare(settings.threshold, kind), "a long, b long, links long")
