"""Harmonic packing of token sequences.

A piece of length L belongs to class j = capacity // L: it is longer than capacity / (j + 1) and
no longer than capacity / j, so j pieces of the class always fit. Each worker fills the bins of
each class with exactly j pieces, without looking at any other worker. Documents are cut at the
largest lengths of the classes 1, 2, 4, ..., whose bins then have no padding at all; only the short
rest of a document falls in a class by its own length.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.shared import releasing, whole_text
from devicewatch.llm.tokens import MEMO, library_encoder

SCHEMA = ("id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long")
_ARROW = pa.schema([
    ("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_OUT_BYTES = 4 << 20


@dataclasses.dataclass
class Piece:
    """Consecutive ids of one document."""

    id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4


def cut(length: int, capacity: int, smallest: int) -> list[int]:
    """Lengths of the pieces of a document: whole bins, then halves down to ``smallest``, the rest."""
    found = [capacity] * (length // capacity)
    length %= capacity
    size = capacity // 2
    while size >= smallest and length:
        if length >= size:
            found.append(size)
            length -= size
        size //= 2
    return found + [length] * (length > 0)


class Packer:
    """The open bins of one worker: at most one of each class."""

    def __init__(self, capacity: int, smallest: int, first: int) -> None:
        self.capacity, self.smallest, self.sequence = capacity, smallest, first
        self.open: dict[int, list[Piece]] = {}

    def add(self, id_: int | None, ids: bytes) -> Iterator[list[Piece]]:
        """Take one document; gives each bin that it completes."""
        total, start = len(ids) // 4, 0
        for length in cut(total, self.capacity, self.smallest):
            piece = Piece(id_, start, ids[4 * start:4 * (start + length)], total)
            start += length
            kind = self.capacity // length
            bin_ = self.open.setdefault(kind, [])
            bin_.append(piece)
            if len(bin_) == kind:
                del self.open[kind]
                yield bin_

    def rest(self) -> Iterator[list[Piece]]:
        """The bins left open, put together and cut where a sequence is full."""
        bin_, room = [], self.capacity
        for kind in sorted(self.open):
            for piece in self.open[kind]:
                while piece.length > room:
                    bin_.append(Piece(piece.id, piece.start, piece.ids[:4 * room],
                                      piece.doc_tokens))
                    piece = Piece(piece.id, piece.start + room, piece.ids[4 * room:],
                                  piece.doc_tokens)
                    yield bin_
                    bin_, room = [], self.capacity
                bin_.append(piece)
                room -= piece.length
                if not room:
                    yield bin_
                    bin_, room = [], self.capacity
        if bin_:
            yield bin_

    def rows(self, bin_: list[Piece]) -> Iterator[tuple]:
        offset = 0
        for p in bin_:
            yield p.id, p.start, p.length, p.ids, p.doc_tokens, self.sequence, offset
            offset += p.length
        self.sequence += 1


def _pack(encoder: Callable[[], Callable[[str], bytes]], end: int | None, capacity: int,
          smallest: int):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder()
        last = b"" if end is None else np.array([end], dtype="<u4").tobytes()
        packer = Packer(capacity, smallest, TaskContext.get().partitionId() << 33)
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), _ARROW.types,
                                                     strict=True)], schema=_ARROW)

        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1), strict=True):
                for bin_ in packer.add(id_.as_py(), encode(text.as_py()) + last):
                    rows += packer.rows(bin_)
                    size += sum(len(p.ids) + 64 for p in bin_)
                    if size > _OUT_BYTES:
                        yield flush()
                        rows, size = [], 0
        for bin_ in packer.rest():
            rows += packer.rows(bin_)
        if rows:
            yield flush()

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         end: int | None = None, capacity: int = 2048, smallest: int = 64,
         memo: int = MEMO) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``tokenizer`` is a file of the tokenizers library; ``end`` is an id put after every document.
    ``ids`` are little-endian unsigned 32-bit. Each id of a document lies in one piece, ``start``
    ids into it; pieces fill a sequence from ``offset`` 0 without gaps, up to ``capacity``.
    ``memo`` is how many pieces of text a worker remembers, twice over: more is faster and takes
    more memory. Null texts count as empty: without ``end`` they have no piece. Rows that repeat an id are
    packed each. Other columns are ignored. Every partition is packed on its own, in one pass and
    without a shuffle, and ends in at most one sequence that is not full but for its short rests.
    """
    if smallest < 1 or capacity < smallest:
        raise ValueError("capacity >= smallest >= 1 is needed")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(
        _pack(lambda: library_encoder(tokenizer, memo), end, capacity, smallest), SCHEMA)
