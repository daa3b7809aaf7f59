"""A prefix trie of conversations, aggregated by node, from padded matrices of turn ids.

Conversations are cut into slabs of a fixed number of turns, each led by a digest of all turns before
it, so a conversation of any length is many bounded rows. The rows are sorted into range shards. A
shard is a matrix of turn ids, padded where a row ends: sorted by numpy's lexsort, a row starts a node
wherever it, or a column before, differs from the row above, and every depth is aggregated with
reduceat. What a node sums over its subtree is a sum over rows, each of which knows the rows beside
it, also those of the next shards. So a node that a shard boundary cuts is the sum of its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicewatch.llm.shared import materialise, partitions, whole_text

#: Turns of a slab.
SLAB = 32
#: Rows of a shard, about.
_ROWS = 50_000
#: Conversation ids in one piece of a list of ends.
_IDS = 4096
_MAX = np.iinfo(np.int64).max

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")


def number_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv``, ``place``, ``role``, ``digest``, ``size`` of every turn, without its text.

    ``place`` counts from 0 in the order of turn (null first); tied turns are ordered by role,
    then by the SHA-256 of the text, which is ``digest``; ``size`` is the text's code points.
    Null role or text count as empty; turns without a conversation are left out. Rows are
    numbered where a range sort puts them: a conversation of any length spreads over partitions.
    """
    text = whole_text(text_col)
    order = ["conv", "turn", "role", "digest"]
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        whole_text(role_col).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.length(text).cast("long").alias("size"))
    placed = materialise(
        rows.repartitionByRange(partitions(turns.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
        .drop("turn"), "turns")
    pieces = placed.groupBy("conv", "part").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    pieces = pieces.select("conv", "part", (
        F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(pieces, ["conv", "part"]).select(
        "conv", (F.col("at") + F.col("shift")).alias("place"), "role", "digest", "size")


def _slabs(turns: DataFrame, conv_col: str, place_col: str, key_cols: Sequence[str],
           size_col: str) -> DataFrame:
    """Rows of at most ``SLAB`` turns: where they stand, what came before, their ids and sizes."""
    keys = [F.col(c) for c in key_cols]
    place = F.col(place_col)
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.coalesce(F.floor(place / SLAB), F.lit(0)).alias("slab"),
        F.when(place.isNotNull(), F.struct(
            place.alias("place"), F.xxhash64(F.lit(0), place, *keys).alias("x1"),
            F.xxhash64(*reversed(keys), place, F.lit(1)).alias("x2"),
            F.coalesce(F.col(size_col).cast("long"), F.lit(0)).alias("size"))).alias("turn"))
    held = rows.groupBy("conv", "slab").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    by_slab = Window.partitionBy("conv").orderBy("slab")
    above = by_slab.rowsBetween(Window.unboundedPreceding, -1)

    def both(name: str) -> Column:
        own = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(t[name]))
        return own.alias(name)

    held = held.select("*", both("x1"), both("x2"))
    digest = lambda c: F.coalesce(F.bit_xor(c).over(above), F.lit(0).cast("long"))
    return held.select(
        "slab", digest("x1").alias("p1"), digest("x2").alias("p2"),
        F.flatten(F.transform("turns", lambda t: F.array(t["x1"], t["x2"]))).alias("ids"),
        F.lead("slab").over(by_slab).isNotNull().alias("goes_on"), "conv",
        F.transform("turns", lambda t: t["size"]).alias("sizes"))


_PLACE = ["slab", "p1", "p2", "ids", "goes_on", "conv"]


def _matrix(ids: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of the ids that keep their order, a row of them for each length, padded with 0."""
    filled = np.arange(depth) < lengths[:, None]
    found = np.zeros(filled.shape, dtype=np.int64)
    if len(ids):
        order = np.lexsort((ids[:, 1], ids[:, 0]))
        ordered = ids[order]
        number = np.empty(len(ids), dtype=np.int64)
        number[order] = 1 + np.concatenate(
            [[0], np.cumsum((ordered[1:] != ordered[:-1]).any(axis=1))])
        found[filled] = number
    return found


def _padded(values: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    filled = np.arange(depth) < lengths[:, None]
    found = np.zeros(filled.shape, dtype=np.int64)
    found[filled] = values
    return found


class _Shard:
    """The rows of a shard in order, and which of them start which nodes.

    ``changes[r, d]`` tells whether row r is in another node of depth d than the row above it,
    the last row of the shards before included; the row after the last is the next shards' first.
    """

    def __init__(self, rows: pa.Table, before: dict | None, after: dict | None):
        own = rows.select(_PLACE)
        ends = [pa.table({c: [end[c]] for c in _PLACE}, schema=own.schema)
                for end in (before, after) if end is not None]
        every = pa.concat_tables([own, *ends])
        count = rows.num_rows
        lists = every.column("ids").combine_chunks()
        ids = lists.flatten().to_numpy().reshape(-1, 2)
        lengths = (lists.value_lengths().to_numpy() // 2).astype(np.int64)
        column = {c: every.column(c).to_numpy() for c in ("slab", "p1", "p2", "goes_on", "conv")}
        depth = int(lengths.max(initial=0))
        matrix = _matrix(ids, lengths, depth)
        group = _matrix(np.stack([column["p1"], column["p2"]], axis=1),
                        np.ones(len(lengths), dtype=np.int64), 1)[:, 0]
        order = np.lexsort((column["conv"], column["goes_on"],
                            *[matrix[:, d] for d in reversed(range(depth))],
                            group, column["slab"]))
        differs = np.empty((len(order) + 1, depth + 1), dtype=bool)
        sort = np.concatenate([column["slab"][:, None], group[:, None]], axis=1)[order]
        differs[1:-1, 0] = (sort[1:] != sort[:-1]).any(axis=1)
        differs[1:-1, 1:] = matrix[order][1:] != matrix[order][:-1]
        differs[0] = differs[-1] = True
        changes = np.logical_or.accumulate(differs, axis=1)
        at = np.nonzero(order < count)[0]  # rows of the ends are first and last
        order = order[at]
        self.changes = changes[at[0]:at[-1] + 2]
        self.depth, self.length = depth, lengths[order]
        self.slab, self.conv = column["slab"][order], column["conv"][order]
        self.goes_on = column["goes_on"][order].astype(bool)
        lengths = lengths[:count]  # the shard's own rows come before the ends
        #: Digests of the first turns of each row, by depth within the slab.
        self.keys = [np.bitwise_xor.accumulate(np.concatenate(
            [column[p][:count, None], _padded(ids[:lengths.sum(), k], lengths, depth)],
            axis=1), axis=1)[order] for k, p in enumerate(("p1", "p2"))]
        sizes = rows.column("sizes").combine_chunks().flatten().to_numpy()
        sizes = _padded(sizes, lengths, depth)[order]
        self.held = np.arange(depth) < self.length[:, None]
        #: Text a row shares: of turns whose node an earlier row starts.
        self.shared = np.where(self.held & ~self.changes[:-1, 1:], sizes, 0)
        #: Whether no other conversation goes on from where this one ends.
        self.leaf = ~self.goes_on & self.changes[1:][np.arange(count), self.length]
        self.index = order


_CARRY = "conv long, slab long, child long, saved long, leaves long"


def _carry(rows: pa.Table, before: dict | None, after: dict | None) -> pa.Table:
    """What a row below the first slab adds to the nodes above it."""
    s = _Shard(rows, before, after)
    low = s.slab > 0
    child = s.changes[:-1, 1] if s.depth else np.zeros(len(low), dtype=bool)
    return pa.table({
        "conv": s.conv[low], "slab": s.slab[low] - 1, "child": child[low].astype(np.int64),
        "saved": s.shared.sum(axis=1)[low], "leaves": s.leaf[low].astype(np.int64)})


_PART = ("depth long, k1 long, k2 long, parent_k1 long, parent_k2 long, parent_conv_id long, "
         "conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, open boolean, shard int, ends array<string>")
_PART_TYPES = [pa.int64()] * 11 + [pa.string(), pa.bool_(), pa.int32(), pa.list_(pa.string())]


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _nodes(rows: pa.Table, before: dict | None, after: dict | None) -> pa.Table:
    """Every node that rows of this shard pass through; those that others pass too are open."""
    s = _Shard(rows, before, after)
    shard = rows.column("shard")[0].as_py()
    carried = {c: rows.column(c).to_numpy()[s.index] for c in ("child", "saved", "leaves")}
    #: A row's shared text from each depth on, and what deeper slabs add.
    below = np.zeros((len(s.conv), s.depth + 2), dtype=np.int64)
    below[:, 1:-1] = np.cumsum(s.shared[:, ::-1], axis=1)[:, ::-1]
    below[:, 0] = below[:, 1]
    below += carried["saved"][:, None]
    leaves = s.leaf + carried["leaves"]
    found: list[pa.RecordBatch] = []
    up_at = up_conv = up_open = np.empty(0, dtype=np.int64)
    for d in range(s.depth + 1):
        held = s.length >= d if d else s.slab == 0
        begins = held & s.changes[:-1, d]
        begins[0] = held[0]
        at = np.nonzero(begins)[0]
        if not len(at):
            continue

        def total(values, at=at, held=held):
            return np.add.reduceat(np.where(held, values, 0), at)

        conv = np.minimum.reduceat(np.where(held, s.conv, _MAX), at)
        children = total(np.where(s.length == d, carried["child"], 0))
        if d < s.depth:
            children += total(s.held[:, d] & s.changes[:-1, d + 1])
        is_open = np.zeros(len(at), dtype=bool)
        is_open[0] |= at[0] == 0 and not s.changes[0, d]
        is_open[-1] |= bool(held[-1]) and not s.changes[-1, d]

        ending = np.nonzero(held & (s.length == d) & ~s.goes_on)[0]
        node = np.searchsorted(at, ending, "right") - 1
        cuts = np.searchsorted(node, np.arange(len(at) + 1))
        digests, ends = [], []
        for k in range(len(at)):
            ids = s.conv[ending[cuts[k]:cuts[k + 1]]]
            if is_open[k]:
                digests.append(None)
                ends.append([_joined(ids[i:i + _IDS]) for i in range(0, len(ids), _IDS)])
            else:
                digests.append(hashlib.sha256(_joined(ids).encode()).hexdigest())
                ends.append(None)

        # A parent's least member is known here unless others pass through the parent too, or
        # it belongs to the slab above.
        known = np.zeros(len(at), dtype=bool)
        parent = np.zeros(len(at), dtype=np.int64)
        if d and len(up_at):
            up = np.searchsorted(up_at, at, "right") - 1
            parent = up_conv[np.maximum(up, 0)]
            known = (up >= 0) & ~up_open[np.maximum(up, 0)] & ((d > 1) | (s.slab[at] == 0))
        up_at, up_conv, up_open = at, conv, is_open
        above = max(d - 1, 0)
        columns = [
            s.slab[at] * SLAB + d, s.keys[0][at, d], s.keys[1][at, d],
            s.keys[0][at, above], s.keys[1][at, above],
            pa.array(parent, mask=~(known & ~is_open)), conv, total(1), children, total(leaves),
            total(below[:, d]), digests, is_open, np.full(len(at), shard), ends]
        found.append(pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, type=t)
             for c, t in zip(columns, _PART_TYPES, strict=True)],
            names=[f.split()[0] for f in _PART.split(", ")]))
    return pa.Table.from_batches(found)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of lists of ends, sorted by node, to the digest of each whole list."""
    node, running, found = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = row["depth"], row["k1"], row["k2"]
            if key != node:
                if node is not None:
                    found.append((*node, running.hexdigest()))
                node, running = key, hashlib.sha256()
            else:
                running.update(b",")
            running.update(row["piece"].encode())
        if len(found) >= 4096:
            yield _digests(found)
            found = []
    if node is not None:
        found.append((*node, running.hexdigest()))
    if found:
        yield _digests(found)


def _digests(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found, strict=True)
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)],
        names=["depth", "k1", "k2", "ends_sha256"])


def _recombined(parts: DataFrame) -> DataFrame:
    """The nodes that several shards hold a part of."""
    node = ["depth", "k1", "k2"]
    pieces = (
        parts.select(*node, "shard", F.posexplode("ends").alias("at", "piece"))
        .repartition(partitions(parts.sparkSession), *node)
        .sortWithinPartitions(*node, "shard", "at").drop("shard", "at")
        .mapInArrow(_hash_ends, "depth long, k1 long, k2 long, ends_sha256 string"))
    summed = parts.groupBy(*node, "parent_k1", "parent_k2").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return summed.join(pieces, node, "left").withColumns({
        "ends_sha256": F.coalesce("ends_sha256", empty),
        "parent_conv_id": F.lit(None).cast("long")})


def prefix_trie(turns: DataFrame, conv_col: str = "conv", place_col: str = "place",
                key_cols: Sequence[str] = ("role", "digest"), size_col: str = "size",
                rows: int = _ROWS) -> DataFrame:
    """Every node of the trie of conversations, with the columns of ``NODE``.

    ``turns`` has a row for every turn: a conversation (long), the turn's place in it (gapless
    from 0, each once), what turns are equal by, and a size. A row whose place is null names a
    conversation, needed only for one without turns. A node is a distinct sequence of first
    turns: ``depth`` of them, the root none. ``conv_id`` is its least member, ``n_convs`` their
    number, ``parent_conv_id`` the parent's ``conv_id`` (null at the root), ``n_children`` and
    ``n_leaves`` count children and the childless nodes of its subtree, ``saved_tokens`` sums, over
    its subtree, members but one times the size of the last turn. ``ends_sha256`` is of the ids of
    conversations that end here, ascending, joined by commas. Without rows there is no root.

    Turns are equal where 128 bits of hash over place and keys are. A shard holds about ``rows``
    rows of at most ``SLAB`` turns; two rows of each shard pass through the driver. A list of
    ends is one digest, hence read in order, in pieces of 4096 ids.
    """
    spark = turns.sparkSession
    slabs = materialise(_slabs(turns, conv_col, place_col, key_cols, size_col), "slabs")
    shards = max(partitions(spark), slabs.count() // rows + 1)
    placed = materialise(slabs.repartitionByRange(shards, *_PLACE)
                         .withColumn("shard", F.spark_partition_id()), "shards")
    place = F.struct(*_PLACE)
    ends = placed.groupBy("shard").agg(
        F.min(place).alias("first"), F.max(place).alias("last")).orderBy("shard").collect()
    beside = {e["shard"]: (ends[k - 1]["last"].asDict() if k else None,
                           ends[k + 1]["first"].asDict() if k + 1 < len(ends) else None)
              for k, e in enumerate(ends)}

    def with_ends(function):
        return lambda table: function(table, *beside[table.column("shard")[0].as_py()])

    carried = placed.where("slab > 0").groupBy("shard").applyInArrow(with_ends(_carry), _CARRY)
    deeper = Window.partitionBy("conv").orderBy(F.col("slab").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = carried.select("conv", "slab", "child", F.sum("saved").over(deeper).alias("saved"),
                             F.sum("leaves").over(deeper).alias("leaves"))
    whole = placed.join(carried, ["conv", "slab"], "left").fillna(
        0, ["child", "saved", "leaves"])
    parts = materialise(
        whole.groupBy("shard").applyInArrow(with_ends(_nodes), _PART), "trie-parts")

    names = [f.split()[0] for f in NODE.split(", ")]
    keyed = ["k1", "k2", "parent_k1", "parent_k2"]
    closed = parts.where("NOT open").select(*names, *keyed)
    nodes = closed.unionByName(
        materialise(_recombined(parts.where("open")), "trie-cut").select(*names, *keyed))
    settled = (F.col("depth") == 0) | F.col("parent_conv_id").isNotNull()
    # Parents still to be found are those that a shard boundary or the end of a slab cuts.
    wanted = parts.where("open").select("depth", "k1", "k2").distinct()
    at_cut = nodes.join(wanted, ["depth", "k1", "k2"], "left_semi").unionByName(
        closed.where(F.col("depth") % SLAB == 0).select(*nodes.columns)).select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("parent_k1"),
        F.col("k2").alias("parent_k2"), F.col("conv_id").alias("found"))
    rest = nodes.where(~settled).join(at_cut, ["depth", "parent_k1", "parent_k2"]).withColumn(
        "parent_conv_id", F.col("found"))
    return nodes.where(settled).select(*names).unionByName(rest.select(*names))
