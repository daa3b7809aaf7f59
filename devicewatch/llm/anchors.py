"""Content-selected anchors: the same places of a text wherever it stands.

Each run of words has an anchor, the n-gram of least hash in it, so what two texts share has the same
anchors in both. Only around anchors that stand in several places can a shared run be.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.shared import releasing

#: Bits of the filter of shared anchors for each of them, and at most. A full filter passes all, which
#: costs time and changes nothing.
BITS_EACH, MOST_BITS = 16, 1 << 28
_ROWS = 1 << 14
_WORD_AT = 1 << 16


def _mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    values = np.full(n, base, dtype=np.uint64)
    values[:1] = 1
    return np.cumprod(values, dtype=np.uint64)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end, in bytes: runs of other than space and tab to carriage return."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    turn = np.diff(inside)
    return np.nonzero(turn == 1)[0], np.nonzero(turn == -1)[0]


def word_hashes(data: np.ndarray) -> np.ndarray:
    starts, stops = word_bounds(data)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = stops - starts
    ends = np.cumsum(lengths)
    firsts = ends - lengths
    within = np.arange(ends[-1]) - np.repeat(firsts, lengths)
    letters = data[np.repeat(starts, lengths) + within].astype(np.uint64) + np.uint64(1)
    scaled = letters * _powers(0x9E3779B97F4A7C15, _WORD_AT)[within % _WORD_AT]
    return _mix(np.add.reduceat(scaled, firsts) + lengths.astype(np.uint64))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` words."""
    count = len(words) - n + 1
    if count < 1:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(n):  # in place: the same for a run wherever it stands
        total *= np.uint64(0xD1342543DE82EF95)
        total += words[k:k + count]
    return _mix(total)


def _slide(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or largest of each window of ``width``."""
    reach = 1
    while 2 * reach <= width:
        x = best(x[:-reach], x[reach:])
        reach *= 2
    rest = width - reach
    return best(x[:-rest], x[rest:]) if rest else x


def suffixes(words: np.ndarray, min_words: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram hash at each word, and the least of each run of ``min_words`` words."""
    grams = run_hashes(words, gram)
    width = min_words - gram + 1
    if len(grams) < width:
        return grams[:0], grams[:0]
    return grams, _slide(grams, width, np.minimum)


def selected(grams: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """The places whose n-gram is the least of some window."""
    if not len(least):
        return np.empty(0, dtype=np.int64)
    edge = np.zeros(width - 1, dtype=np.uint64)
    return np.nonzero(_slide(np.concatenate([edge, least, edge]), width, np.maximum) == grams)[0]


def anchors(text: bytes, min_words: int, gram: int) -> tuple[np.ndarray, ...]:
    """Hash and position of each anchor, and the first and last window it stands for.

    A window's anchor is the first of its n-grams of least hash: the same wherever the window
    stands, and later for later windows.
    """
    grams, least = suffixes(word_hashes(np.frombuffer(text, dtype=np.uint8)), min_words, gram)
    if not len(least):
        none = np.empty(0, dtype=np.int64)
        return grams[:0], none, none, none
    at = selected(grams, least, min_words - gram + 1)
    chosen = np.searchsorted(at, np.arange(len(least)))
    while (other := grams[at[chosen]] != least).any():
        chosen += other
    first = np.nonzero(np.diff(chosen, prepend=-1))[0]
    last = np.append(first[1:], len(least)) - 1
    return least[first], at[chosen[first]], first, last


def raw_bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


ANCHOR = "anchor long, id long, rows long"


def distinct_anchors(min_words: int, gram: int):
    """``id``, ``text`` to the distinct anchors of each document and how often it has them."""
    names = [f.split()[0] for f in ANCHOR.split(", ")]

    def batch(held: list) -> pa.RecordBatch:
        ids = np.repeat(np.arange(len(held)), [len(h) for h, _, _ in held])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([h for h, _, _ in held]).view(np.int64)),
             pa.array([i for _, i, _ in held], type=pa.int64()).take(pa.array(ids)),
             pa.array(np.concatenate([n for _, _, n in held]))], names=names)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in batches:
            for id_, text in zip(*rows.columns, strict=True):
                hashes, *_ = anchors(raw_bytes(text.as_py()), min_words, gram)
                if len(hashes):
                    hashes, times = np.unique(hashes, return_counts=True)
                    held.append((hashes, id_.as_py(), times))
                    size += len(hashes)
                if size >= _ROWS:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    return run


def anchor_filter(shared: DataFrame, count: int) -> np.ndarray:
    """One bit for each shared anchor, in 64-bit words."""
    bits = 1 << max(16, (count * BITS_EACH - 1).bit_length())
    table = np.zeros(min(bits, MOST_BITS) // 64, dtype=np.int64)
    slot = F.col("anchor").bitwiseAND(F.lit(len(table) * 64 - 1))
    words = shared.select(F.shiftright(slot, 6).alias("word"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    for part in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():
        table[part.column(0).to_numpy()] = part.column(1).to_numpy()
    return table.view(np.uint64)


def passing(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets pass."""
    slots = hashes & np.uint64(len(table) * 64 - 1)
    return (table[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def batch_of(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)],
        schema=schema)


def in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while held := list(islice(rows, _ROWS)):
        yield batch_of(held, schema)


class WindowIndex:
    """The passages read so far around one anchor, indexed by window.

    With ``own``, a window that stands in the same document before is a repeat too.
    """

    def __init__(self, min_words: int, own: bool = False):
        self.min_words, self.own = min_words, own
        self.passages: list[tuple[int | None, int, list[bytes]]] = []
        self.index: dict[int, list[tuple[int, int]]] = {}
        #: Where documents have windows that no smaller id of the block has: by place in the
        #: index, id and tie.
        self.new: dict[tuple, list[int]] = {}

    def _find(self, words: list[bytes], at: int, key: int) -> tuple[int, int] | None:
        """The first passage, and the place in it, with the window of ``words`` at ``at``."""
        for passage, place in self.index.get(key, ()):
            held = self.passages[passage][2]
            if held[place:place + self.min_words] == words[at:at + self.min_words]:
                return passage, place
        return None

    def parse(self, id_: int | None, tie: int, start: int, words: list[bytes]) -> list[tuple]:
        """The factors of a passage: start, stop, and the id and position they repeat."""
        n, new, factors = self.min_words, len(self.passages), []
        at, last = 0, len(words) - n
        while at <= last:
            key = hash(tuple(words[at:at + n]))
            hit = self._find(words, at, key)
            source = self.passages[hit[0]] if hit else None
            if source is None or (source[0] == id_ and not self.own):
                if source is None:
                    hit = new, at
                    self.index.setdefault(key, []).append(hit)
                    if new == len(self.passages):
                        self.passages.append((id_, start, words))
                self.new.setdefault((*hit, id_, tie), []).append(start + at)
                at += 1
                continue
            held, place = source[2], hit[1]
            stop, end = at + n, place + n
            while stop < len(words) and end < len(held) and words[stop] == held[end]:
                stop, end = stop + 1, end + 1
            factors.append((start + at, start + stop, source[0], source[1] + place))
            at = stop - n + 1
        return factors

    def new_windows(self) -> Iterator[tuple]:
        """The windows no smaller id of the block has, as rows of ``_FOUND``."""
        for (passage, place, id_, tie), places in self.new.items():
            words = self.passages[passage][2][place:place + self.min_words]
            yield id_, tie, None, None, None, None, b" ".join(words), places


SPANS = "array<struct<start:int,stop:int>>"


def repeated_spans(found: DataFrame) -> DataFrame:
    """``id``, ``tie``, ``spans``: the factors of each document, joined where they touch."""
    def joined(lists: pa.Array) -> pa.Array:
        return pa.array([_union(spans.as_py()) for spans in lists], type=pa.list_(
            pa.struct([("start", pa.int32()), ("stop", pa.int32())])))

    spans = found.groupBy("id", "tie").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"))
    return spans.select("id", "tie", F.arrow_udf(joined, SPANS)("spans").alias("spans"))


def _union(spans: list[dict[str, int]]) -> list[dict[str, int]]:
    found: list[dict[str, int]] = []
    for s in sorted(spans, key=lambda s: s["start"]):
        if found and s["start"] <= found[-1]["stop"]:
            found[-1]["stop"] = max(found[-1]["stop"], s["stop"])
        else:
            found.append(dict(s))
    return found
