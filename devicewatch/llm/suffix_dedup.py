"""Repeated passages by a sparse suffix array.

A suffix of a text, by words, is retained where a content-selected anchor stands: any two equal runs
of enough words have the same anchor in the same place. Retained suffixes are sorted by their words,
as far as a run around the anchor can reach. Neighbours are compared; those that share the anchor's
words form a run of the array, and a suffix unlike both its neighbours is dropped. Around the others
matches are extended word by word, to the left as far as a run of ``min_words`` can begin and to the
right as far as both texts agree. All but the first occurrence of a run of words are repeats.

The sort spreads equal suffixes over as many partitions as they need; where a partition ends within a
run of the array, the windows that are new to each part are compared across the parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.anchors import (
    ANCHOR, WindowIndex, anchor_filter, anchors, batch_of, distinct_anchors, in_batches,
    passing, raw_bytes, repeated_spans, word_bounds)
from devicewatch.llm.shared import materialise, partitions, releasing, whole_text

#: Words of the n-gram a suffix is selected by.
GRAM = 13
#: Suffixes of a partition, about.
_SUFFIXES = 20_000
_ROWS = 1 << 14
_BYTES = 1 << 23

_SUFFIX = "suffix binary, before binary, id long, tie long, place int"


def _suffixes(min_words: int, gram: int, table: np.ndarray):
    """``id``, ``tie``, ``text`` to the retained suffixes, with the words before them.

    Words end in a space, so that equal first words sort together. A suffix ends with the last
    run of ``min_words`` that its anchor stands for, and the words before begin with the first.
    """
    schema = pa.schema([("suffix", pa.binary()), ("before", pa.binary()), ("id", pa.int64()),
                        ("tie", pa.int64()), ("place", pa.int32())])

    def joined(words: list[bytes]) -> bytes:
        return b"".join(w + b" " for w in words)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in batches:
            for id_, tie, text in zip(*rows.columns, strict=True):
                raw = raw_bytes(text.as_py())
                hashes, places, first, last = anchors(raw, min_words, gram)
                hit = passing(hashes, table)
                if not hit.any():
                    continue
                words, id_, tie = raw.split(), id_.as_py(), tie.as_py()
                for at, start, end in zip(places[hit].tolist(), first[hit].tolist(),
                                          last[hit].tolist(), strict=True):
                    suffix = joined(words[at:end + min_words])
                    held.append((suffix, joined(words[start:at]), id_, tie, at))
                    size += len(suffix)
                    if len(held) >= _ROWS or size >= _BYTES:
                        yield batch_of(held, schema)
                        held, size = [], 0
        if held:
            yield batch_of(held, schema)

    return run


_FOUND = "id long, tie long, start int, stop int, new_window binary, places array<int>"
_FOUND_TYPES = pa.schema([
    ("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()),
    ("new_window", pa.binary()), ("places", pa.list_(pa.int32()))])


def _neighbours(min_words: int, gram: int):
    """Sorted suffixes to repeated spans, and new windows of the runs a partition begins and ends in."""
    def extend(run: list[tuple]) -> tuple[list[tuple], WindowIndex]:
        index, found, seen = WindowIndex(min_words, own=True), [], None
        for suffix, before, id_, tie, place in sorted(
                run, key=lambda r: (r[2] is not None, r[2] or 0, r[3], r[4])):
            if seen == (id_, tie, place):
                continue  # a repeated row
            seen = id_, tie, place
            start = place - len(before)
            found += [(id_, tie, a, b, None, None)
                      for a, b, _, _ in index.parse(id_, tie, start, before + suffix)]
        return found, index

    def new_windows(index: WindowIndex) -> Iterator[tuple]:
        return ((id_, tie, None, None, window, places)
                for id_, tie, *_, window, places in index.new_windows())

    @releasing
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        run: list[tuple] = []
        runs = 0
        for rows in batches:
            for suffix, before, *where in zip(*(c.to_pylist() for c in rows.columns),
                                              strict=True):
                words = suffix.split()
                if run and words[:gram] != run[-1][0][:gram]:
                    if not runs or len(run) > 1:
                        found, index = extend(run)
                        held += found
                        if not runs:  # the partition before may have ended in this run
                            yield from in_batches(new_windows(index), _FOUND_TYPES)
                    run, runs = [], runs + 1
                run.append((words, before.split(), *where))
                if len(held) >= _ROWS:
                    yield batch_of(held, _FOUND_TYPES)
                    held = []
        if run:  # the next partition may go on with it
            found, index = extend(run)
            held += found
            yield from in_batches(new_windows(index), _FOUND_TYPES)
        yield from in_batches(held, _FOUND_TYPES)

    return of


def _across(new: DataFrame, min_words: int) -> DataFrame:
    """Spans of the windows whose first occurrence is in another part of the same run."""
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "tie",
                     F.col("places")[0].alias("start"))
    rows = new.select("new_window", place.alias("place"))
    first = rows.groupBy("new_window").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return rows.join(first, "new_window").where(~F.col("place").eqNullSafe(F.col("first"))).select(
        "place.id", "place.tie", "place.start", (F.col("place.start") + min_words).alias("stop"))


def _tie(text: Column) -> Column:
    """Tells documents of one id apart."""
    return F.xxhash64(text)


def cut(text: str, spans: list[dict[str, int]]) -> str:
    """The text without these words; the white space after each passage stays, that before goes."""
    raw = text.encode("utf-8", "surrogatepass")
    starts, stops = word_bounds(np.frombuffer(raw, dtype=np.uint8))
    kept, at = [], 0
    for s in spans:
        kept.append(raw[at:stops[s["start"] - 1] if s["start"] else 0])
        at = int(stops[s["stop"] - 1])
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = 50, gram: int = GRAM, suffixes: int = _SUFFIXES
                      ) -> DataFrame:
    """``id``, ``tie``, ``spans`` of documents with repeated passages.

    A passage is repeated where a run of ``min_words`` words or more stands earlier too: in a
    document of smaller id (nulls first; of one id, by a hash of the text), or before in the same
    text. ``spans`` are in words, disjoint and in order. Words are compared byte by byte. Null
    texts count as empty; texts of fewer words have no passage; rows that repeat id and text count
    as one. Partitions of the suffix array hold about ``suffixes``.
    """
    if not 1 <= gram <= min_words:
        raise ValueError("an n-gram has at least 1 and at most min_words words")
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), _tie(text).alias("tie"),
                       text.alias("text"))
    found = rows.select("id", "text").mapInArrow(distinct_anchors(min_words, gram), ANCHOR)
    shared = materialise(found.groupBy("anchor").agg(F.sum("rows").alias("rows")).where(
        "rows > 1"), "anchors")
    size = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    table = anchor_filter(shared, size[0])
    retained = materialise(rows.mapInArrow(_suffixes(min_words, gram, table), _SUFFIX), "suffixes")
    order = ["suffix", "id", "tie", "place"]
    parts = max(partitions(docs.sparkSession), size[1] // suffixes + 1)
    found = materialise(
        retained.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .mapInArrow(_neighbours(min_words, gram), _FOUND), "suffix-matches")
    spans = found.where("new_window IS NULL").select("id", "tie", "start", "stop").unionByName(
        _across(found.where("new_window IS NOT NULL"), min_words))
    return repeated_spans(spans)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = 50, gram: int = GRAM, spans_col: str = "spans",
                suffixes: int = _SUFFIXES) -> DataFrame:
    """The input rows with repeated passages cut from their text, and ``spans_col`` added.

    Every row stays, also one whose text is all repeats and becomes empty. Null texts stay null.
    The first occurrence of a passage is never cut, except where it lies in another's repeat.
    """
    found = repeated_passages(docs, id_col, text_col, min_words, gram, suffixes).select(
        F.col("id").alias("__id"), F.col("tie").alias("__tie"), F.col("spans").alias("__spans"))

    def of(texts: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array([cut(t.as_py(), s.as_py()) if s.is_valid and t.is_valid else None
                         for t, s in zip(texts, lists, strict=True)], type=pa.string())

    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (
        _tie(whole_text(text_col)) == F.col("__tie"))
    text, cuts = F.col(text_col).cast("string"), F.col("__spans")
    # Only texts that change go to a worker.
    shorter = F.arrow_udf(of, "string")(F.when(cuts.isNotNull(), text), cuts)
    changed = F.when(cuts.isNotNull(), shorter).otherwise(text).alias(text_col)
    return docs.join(found, same, "left").select(
        *[changed if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != spans_col],
        cuts.alias(spans_col))
