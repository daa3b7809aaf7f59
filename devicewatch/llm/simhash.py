"""Near-duplicates by SimHash: tiled exact comparison of the distinct fingerprints.

Fingerprints are sorted by their number of set bits and cut into blocks. Two fingerprints within
a radius differ by at most the radius in that number, so blocks (and tiles inside them) whose
numbers lie further apart are skipped; all others are compared bit by bit. The work grows with
the square of the number of distinct fingerprints; the links sent on do not: each pair of blocks
returns a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.components import components
from devicewatch.llm.shared import materialise, whole_text
from devicewatch.llm.unionfind import Forest

#: Fingerprints to a block: a task holds two blocks of 8 bytes each.
BLOCK = 16_384
_TILE, _STRIP = 64, 2_048
_HASHES = 65_536


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the text's word shingles, as an unsigned number.

    A-Z are lower-cased; words are runs of other than space and tab to carriage return. Repeated
    shingles count each time; a text of fewer words is one shingle, one without any gives 0.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    shingles = (map(b" ".join, zip(*[found[k:] for k in range(words)], strict=False))
                if len(found) >= words else [b" ".join(found)])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), dtype="<u8",
                         count=max(1, len(found) - words + 1))
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), _HASHES):
        part = hashes[k:k + _HASHES].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text_col: str, words: int = 4, seed: int = 42) -> Column:
    """The fingerprint of a text column as a (signed) long; null text counts as empty."""
    def of(batch: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t.as_py(), words, seed) for t in batch], dtype="<u8")
        return pa.array(found.view("<i8"))

    return F.arrow_udf(of, "long")(whole_text(text_col))


def fingerprint_hex(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def _blocks(size: int):
    """Rows sorted by bit count to rows that hold up to ``size`` fingerprints each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, rest = TaskContext.get().partitionId(), 0, np.empty(0, dtype="<i8")
        for batch in batches:
            rest = np.concatenate([rest, batch.column(0).to_numpy(zero_copy_only=False)])
            while len(rest) >= size:
                yield block(part, made, rest[:size])
                made, rest = made + 1, rest[size:]
        if len(rest):
            yield block(part, made, rest)

    def block(part: int, made: int, values: np.ndarray) -> pa.RecordBatch:
        bits = np.bitwise_count(values.view("<u8"))
        return pa.RecordBatch.from_pydict({
            "block": [(part << 32) + made], "low": [int(bits.min())],
            "high": [int(bits.max())], "members": [values.astype("<i8").tobytes()]},
            schema=pa.schema([("block", pa.int64()), ("low", pa.int32()),
                              ("high", pa.int32()), ("members", pa.binary())]))

    return run


def link_blocks(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within ``radius`` between two blocks (or inside one).

    Blocks are unsigned and sorted by bit count. Returns pairs of fingerprints.
    """
    other = left if right is None else right
    shift = 0 if right is None else len(left)
    bits, other_bits = np.bitwise_count(left), np.bitwise_count(other)
    forest = Forest(len(left) + (0 if right is None else len(right)))
    for top in range(0, len(left), _TILE):
        tile = left[top:top + _TILE, None]
        low, high = int(bits[top]), int(bits[min(top + _TILE, len(left)) - 1])
        start = int(np.searchsorted(other_bits, max(low - radius, 0), "left"))
        stop = int(np.searchsorted(other_bits, min(high + radius, 64), "right"))
        if right is None:
            start = max(start, top)
        for at in range(start, stop, _STRIP):
            near = np.bitwise_count(tile ^ other[None, at:min(at + _STRIP, stop)]) <= radius
            if near.any():
                i, j = np.nonzero(near)
                forest.join(i + top, j + at + shift)
    nodes = left if right is None else np.concatenate([left, right])
    return [(int(nodes[i]), int(nodes[j])) for i, j in forest.edges]


def _compare(radius: int):
    def run(table: pa.Table) -> pa.Table:
        held = [np.frombuffer(m, dtype="<u8") for m in table.column("members").to_pylist()]
        edges = link_blocks(held[0], held[1] if len(held) > 1 else None, radius)
        ends = np.array(edges, dtype="<u8").reshape(-1, 2).view("<i8")
        return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    return run


def links(fingerprints: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """Links ``a``, ``b`` that join every two fingerprints within ``radius`` by some path.

    ``fingerprints`` has one long column of distinct values. Both ends of a returned link are
    within the radius; links implied by others of the same two blocks are left out.
    """
    name = fingerprints.columns[0]
    values = fingerprints.select(F.col(name).alias("value"))
    parts = max(1, -(-values.count() // block))
    spread = (values.repartitionByRange(parts, F.bit_count("value"), "value")
              .sortWithinPartitions(F.bit_count("value"), "value"))
    blocks = materialise(spread.mapInArrow(
        _blocks(block), "block long, low int, high int, members binary"), "simhash-blocks")
    sides = blocks.select("block", "low", "high")
    one = sides.select(F.col("block").alias("one"), "low", F.explode(
        F.sequence("low", "high")).alias("bits"))
    two = sides.select(F.col("block").alias("two"), (F.col("low") - radius).alias("from"),
                       F.explode(F.sequence(F.col("low") - radius, F.col("high") + radius))
                       .alias("bits"))
    # Blocks that overlap meet at several bit counts; the smallest of these counts.
    pairs = one.join(two, "bits").where(
        "one <= two and bits = greatest(low, `from`)").select("one", "two")
    sent = pairs.select("one", "two", F.explode(
        F.array_distinct(F.array("one", "two"))).alias("block"))
    return (sent.join(blocks.select("block", "members"), "block")
            .groupBy("one", "two").applyInArrow(_compare(radius), "a long, b long"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = 4, radius: int = 4, seed: int = 42,
                   block: int = BLOCK) -> DataFrame:
    """One row per input row: ``id``, ``fingerprint`` (long), ``text_hash``, ``group_id``, ``first``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; a group is a connected
    component. ``group_id`` is its smallest id (nulls last) and ``first`` marks the row that
    stands for the group: that id and, where rows share an id, the smallest ``text_hash``. Rows
    that repeat both id and text are all marked. Null and empty texts have fingerprint 0 and are
    linked like any other.
    """
    prints = materialise(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("text_hash"),
        fingerprint_column(text_col, words, seed).alias("fingerprint")), "simhash-prints")
    least = F.min(F.struct(F.col("id").isNull(), "id", "text_hash"))
    distinct = materialise(
        prints.groupBy("fingerprint").agg(least.alias("least")), "simhash-distinct")
    labels = components(links(distinct.select("fingerprint"), radius, block), "simhash-links")
    # Distinct fingerprints to groups: a group's minimum is reduced before its shuffle.
    labelled = distinct.join(
        labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("label", "fingerprint").alias("label"))
    heads = labelled.groupBy("label").agg(F.min("least").alias("head"))
    groups = labelled.join(heads, "label").select("fingerprint", "head")
    return prints.join(groups, "fingerprint").select(
        "id", "fingerprint", "text_hash", F.col("head.id").alias("group_id"),
        (F.col("head.id").eqNullSafe(F.col("id"))
         & (F.col("head.text_hash") == F.col("text_hash"))).alias("first"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     words: int = 4, radius: int = 4) -> DataFrame:
    """The input rows with one document of each near-duplicate group, all columns kept."""
    groups = simhash_groups(docs, id_col, text_col, words, radius)
    kept = groups.where("first").select(
        F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
    same = (docs[id_col].eqNullSafe(kept["__id"])
            & (F.xxhash64(whole_text(text_col)) == kept["__hash"]))
    return docs.join(kept, same, "left_semi")
