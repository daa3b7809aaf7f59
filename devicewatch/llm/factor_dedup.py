"""Repeated substrings by relative Lempel-Ziv parsing.

The reference of a document is every document of smaller id, in indexed blocks. What two documents
share, wherever it stands, holds the same content-selected anchors, so only the words around anchors
that several documents have are dealt, by anchor and id: a block is a range of them, and a passage
meets the block that can hold its match and no other. A block is read in order of id. Each passage is
parsed greedily against what came before: where its next window of words is in the block's index, the
words of the reference are compared from there on and the longest match becomes a factor; a window
across the factor's end is looked up next, so none is passed over. What is new joins the index.

An anchor that a third of all documents have fills many blocks. Each parses its own part; the windows
that are new to a block whose anchor may go on in another are then compared across blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.anchors import (
    ANCHOR, WindowIndex, anchor_filter, anchors, batch_of, distinct_anchors, in_batches, passing,
    raw_bytes, repeated_spans)
from devicewatch.llm.shared import materialise, partitions, releasing, whole_text

#: Words an anchor is selected by.
GRAM = 25
#: Passages of a block, about.
_PASSAGES = 20_000
_ROWS = 1 << 14
_BYTES = 1 << 23


_PASSAGE = "anchor long, id long, tie long, start int, words binary"


def _passages(min_words: int, gram: int, table: np.ndarray):
    """``id``, ``tie``, ``text`` to the words of the windows of each anchor that passes the filter.

    ``words`` are joined by one space, ``start`` is the position of the first.
    """
    schema = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()),
                        ("start", pa.int32()), ("words", pa.binary())])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in batches:
            for id_, tie, text in zip(*rows.columns, strict=True):
                raw = raw_bytes(text.as_py())
                hashes, _, first, last = anchors(raw, min_words, gram)
                hit = passing(hashes, table)
                if not hit.any():
                    continue
                words, id_, tie = raw.split(), id_.as_py(), tie.as_py()
                for anchor, start, end in zip(hashes[hit].view(np.int64).tolist(),
                                              first[hit].tolist(), last[hit].tolist(),
                                              strict=True):
                    passage = b" ".join(words[start:end + min_words])
                    held.append((anchor, id_, tie, start, passage))
                    size += len(passage)
                    if len(held) >= _ROWS or size >= _BYTES:
                        yield batch_of(held, schema)
                        held, size = [], 0
        if held:
            yield batch_of(held, schema)

    return run


_FOUND = ("id long, tie long, start int, stop int, source_id long, source_start int, "
          "new_window binary, places array<int>")
_FOUND_TYPES = pa.schema([
    ("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()),
    ("source_id", pa.int64()), ("source_start", pa.int32()), ("new_window", pa.binary()),
    ("places", pa.list_(pa.int32()))])


def _parse(min_words: int):
    """Passages in order of anchor and id to factors, and new windows where a block is cut."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        anchor, block, seen, blocks = None, WindowIndex(min_words), None, 0

        for rows in batches:
            for row in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if row[0] != anchor:
                    if blocks == 1:  # the partition before may have ended in this anchor
                        yield from in_batches(block.new_windows(), _FOUND_TYPES)
                    anchor, block, seen, blocks = row[0], WindowIndex(min_words), None, blocks + 1
                elif row[1:4] == seen:
                    continue  # a repeated row
                seen = row[1:4]
                _, id_, tie, start, passage = row
                held += [(id_, tie, *factor, None, None)
                         for factor in block.parse(id_, tie, start, passage.split())]
                if len(held) >= _ROWS:
                    yield batch_of(held, _FOUND_TYPES)
                    held = []
        yield from in_batches(held, _FOUND_TYPES)
        yield from in_batches(block.new_windows(), _FOUND_TYPES)  # the next partition may go on with it

    return run


def _across(new: DataFrame, min_words: int) -> DataFrame:
    """Factors of one window each, of blocks that the same anchor fills together.

    Blocks send each window they do not know once for the smallest id they have it in, so the
    rows of a window are as many as the blocks.
    """
    place = F.struct(F.col("id").isNotNull(), "id", F.array_min("places").alias("start"))
    first = new.groupBy("new_window").agg(
        F.min(place).alias("first"), F.max(place).alias("last")).where(
        ~F.col("first.id").eqNullSafe(F.col("last.id"))).select(
        "new_window", F.col("first.id").alias("first_id"), F.col("first.start").alias("at"))
    again = new.select("new_window", "id", "tie", "places").join(first, "new_window").where(
        ~F.col("id").eqNullSafe(F.col("first_id")))
    return again.select("id", "tie", F.explode("places").alias("start"), "first_id", "at").select(
        "id", "tie", "start", (F.col("start") + min_words).alias("stop"),
        F.col("first_id").alias("source_id"), F.col("at").alias("source_start"))


def _tie(text: Column) -> Column:
    """Tells documents of one id apart."""
    return F.xxhash64(text)


def factors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
            gram: int = GRAM, passages: int = _PASSAGES) -> DataFrame:
    """``id``, ``tie``, ``start``, ``stop``, ``source_id``, ``source_start``: repeated substrings.

    A factor is a run of ``min_words`` words or more that stands, word by word, in a document of
    smaller id too (null ids are smallest, and one), at word ``source_start`` of the smallest of
    them for its first window. Together the factors cover exactly the words of all such windows;
    they may overlap. Words are runs of other than space and tab to carriage return. Null texts
    have none. ``tie`` is the 64-bit hash of the text, so rows that share an id stay apart; rows
    that repeat both count as one. Repeats within one document, or between documents of one id,
    are no factors. Other columns are ignored. Blocks hold about ``passages`` passages.
    """
    if not 1 <= gram <= min_words:
        raise ValueError("an anchor has at least 1 and at most min_words words")
    spark = docs.sparkSession
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    found = rows.mapInArrow(distinct_anchors(min_words, gram), ANCHOR)
    place = F.struct(F.col("id").isNotNull(), "id")
    shared = materialise(
        found.groupBy("anchor").agg(
            F.min(place).alias("first"), F.max(place).alias("last"), F.sum("rows").alias("rows"))
        .where(~F.col("first.id").eqNullSafe(F.col("last.id"))).select("anchor", "rows"),
        "anchors")
    size = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    table = anchor_filter(shared, size[0])
    around = materialise(
        docs.select(F.col(id_col).cast("long").alias("id"), _tie(text).alias("tie"),
                    text.alias("text"))
        .mapInArrow(_passages(min_words, gram, table), _PASSAGE), "passages")
    order = ["anchor", "id", "tie", "start"]
    blocks = max(partitions(spark), size[1] // passages + 1)
    found = materialise(
        around.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
        .mapInArrow(_parse(min_words), _FOUND), "factors")
    names = ["id", "tie", "start", "stop", "source_id", "source_start"]
    return found.where("new_window IS NULL").select(*names).unionByName(
        _across(found.where("new_window IS NOT NULL"), min_words))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_words: int = 50, gram: int = GRAM, passages: int = _PASSAGES,
                 spans_col: str = "spans", kept_col: str = "kept",
                 words_col: str = "n_words") -> DataFrame:
    """The input rows with ``spans_col``, ``kept_col`` and ``words_col`` added.

    Spans are the words of the text that ``factors`` cover, in order and disjoint, null where
    there are none; the kept text is all other words, joined by one space; ``words_col`` counts
    all words. Null texts have no words. Every row stays. Input columns of these names go.
    """
    spans = repeated_spans(factors(docs, id_col, text_col, min_words, gram, passages)).select(
        F.col("id").alias("__id"), F.col("tie").alias("__tie"), F.col("spans").alias("__spans"))
    added = {spans_col, kept_col, words_col}
    text = whole_text(text_col)
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (_tie(text) == F.col("__tie"))

    def keep(texts: pa.Array, lists: pa.Array) -> pa.Array:
        kept, count = [], []
        for value, spans in zip(texts, lists, strict=True):
            words = raw_bytes(value.as_py()).split()
            count.append(len(words))
            for s in reversed(spans.as_py() or []):
                del words[s["start"]:s["stop"]]
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pa.StructArray.from_arrays(
            [pa.array(kept, type=pa.string()), pa.array(count, type=pa.int64())],
            names=["kept", "words"])

    split = F.arrow_udf(keep, "struct<kept:string,words:long>")(text, F.col("__spans"))
    joined = docs.join(spans, same, "left").withColumn("__split", split)
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in added],
        F.col("__spans").alias(spans_col), F.col("__split.kept").alias(kept_col),
        F.col("__split.words").alias(words_col))
