"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

The encoding of a text by ranked merges has two properties that make it a transducer. Cut after any
of its tokens it is the encoding of what came before, and tokens may follow each other exactly when
the bytes of the two merge to these two. So after each byte the encoding of what was read ends in
one determined token, and the encodings that longer texts can still use are those of the few places
from which a token could reach past the last byte. A state holds these places, each with the
tokens since the last one that all of them share; shared tokens are put out. The lookahead is bounded
by the longest token. States and steps are made when first needed.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from devicewatch.llm.shared import whole_text
from devicewatch.llm.tokens import MEMO, Encoder, pack_ids

_STATES = 60_000
_PAIRS = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank: lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge(data: bytes, ranks: dict[bytes, int], least: int = 1) -> list[bytes]:
    """The tokens of ``data`` by definition: merge the neighbours of least rank, leftmost first.

    Merging ends early when only ``least`` tokens are left.
    """
    parts = [data[k:k + 1] for k in range(len(data))]
    while len(parts) > least:
        best, at = min(((ranks.get(parts[k] + parts[k + 1], 1 << 62), k)
                        for k in range(len(parts) - 1)))
        if best == 1 << 62:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class _State:
    """The last token put out, and for each place the tokens since then and the bytes after it.

    The last place is where the bytes read so far end.
    """

    __slots__ = ("last", "places", "steps", "kept")

    def __init__(self, last: int | None, places: tuple) -> None:
        self.last, self.places, self.kept = last, places, False
        self.steps: dict[int, tuple[_State, tuple[int, ...]]] = {}


class Transducer:
    """Bytes to tokens, one step a byte.

    Up to a bound, states are kept; a step into a state beyond it is made anew each time.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("each single byte has to be a token")
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        # Tokens that no text encodes to are never put out. Of the others: the last merge.
        self.tokens: dict[bytes, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for token, rank in ranks.items():
            parts = merge(token, ranks, 2)
            if len(parts) < 3:
                self.tokens[token] = rank
            if len(parts) == 2:
                self.halves[rank] = ranks[parts[0]], ranks[parts[1]]
        # What can become or is a token: its rank or -1, and whether more bytes can follow.
        heads = {t[:k] for t in self.tokens for k in range(len(t))}
        self._nodes = {t: (self.tokens.get(t, -1), t in heads)
                       for t in heads | self.tokens.keys()}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._known: dict[tuple, _State] = {}
        self._root = self._state(None, (((), b""),))

    def _state(self, last: int | None, places: tuple) -> _State:
        state = self._known.get((last, places))
        if state is None:
            state = _State(last, places)
            if len(self._known) < _STATES:
                state.kept = True
                self._known[last, places] = state
        return state

    def may_follow(self, one: int | None, two: int) -> bool:
        """Whether the bytes of both, merged together, give these two tokens.

        They do unless some merge across their border comes before one that built them. The
        merges at the border are undone, latest first; what then meets there could have merged
        if that comes before the merge just undone (at equal rank the left one comes first).
        """
        if one is None:
            return True
        known = self._pairs.get((one, two))
        if known is not None:
            return known
        if len(self._pairs) >= _PAIRS:
            self._pairs.clear()
        left, right, before, halves = one, two, 1 << 62, self.halves
        while True:
            known = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], before) >= before
            if not known or left not in halves and right not in halves:
                break
            if right not in halves or left in halves and left > right:
                before, left = left, halves[left][1]
            else:
                before, right = right + 1, halves[right][0]
        self._pairs[one, two] = known
        return known

    def _step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        added, kept, ended, node_of = bytes((byte,)), [], None, self._nodes.get
        for path, rest in state.places:
            rest += added
            node = node_of(rest)
            if node is None:
                continue
            if node[0] >= 0 and ended is None and self.may_follow(
                    path[-1] if path else state.last, node[0]):
                ended = (*path, node[0])
            if node[1]:
                kept.append((path, rest))
        if ended is None:
            raise ValueError("the ranks are not those of a byte-pair encoding")
        kept.append((ended, b""))
        shared, shortest = 0, min([len(path) for path, _ in kept])
        while shared < shortest and all([path[shared] == ended[shared] for path, _ in kept]):
            shared += 1
        last, out = state.last, ()
        if shared:
            out, last = ended[:shared], ended[shared - 1]
            kept = [(path[shared:], rest) for path, rest in kept]
        following = self._state(last, tuple(kept))
        if following.kept:
            state.steps[byte] = following, out
        return following, out

    def encode(self, data: bytes) -> list[int]:
        state, found = self._root, []
        for byte in data:
            step = state.steps.get(byte)
            if step is None:
                step = self._step(state, byte)
            state, out = step
            if out:
                found += out
        found += state.places[-1][0]
        return found


class StreamDecoder:
    """Token ids to text as they come: characters appear once their last byte is there.

    The state is the head of a character that is not complete. Bytes that are not UTF-8 become
    the replacement character, as in decoding all of them at once.
    """

    def __init__(self, table: Sequence[bytes]) -> None:
        self.table, self.head = table, b""

    def feed(self, ids: Iterable[int]) -> str:
        data = self.head + b"".join(map(self.table.__getitem__, ids))
        stop = len(data) - _unfinished(data)
        self.head = data[stop:]
        return data[:stop].decode("utf-8", "replace")

    def end(self) -> str:
        head, self.head = self.head, b""
        return head.decode("utf-8", "replace")


def _unfinished(data: bytes) -> int:
    """How many of the last bytes begin a character that more bytes could complete."""
    for back in range(1, min(3, len(data)) + 1):
        byte = data[-back]
        if byte & 0xC0 == 0x80:
            continue
        need = 2 if 0xC2 <= byte <= 0xDF else 3 if byte & 0xF0 == 0xE0 else (
            4 if 0xF0 <= byte <= 0xF4 else 1)
        if need <= back:
            return 0
        if back > 1:  # some second bytes are never right after these
            second = data[-back + 1]
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            if not low <= second <= high:
                return 0
        return back
    return 0


@functools.lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(read_ranks(path))


@functools.lru_cache(maxsize=2)
def _token_bytes(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


@functools.lru_cache(maxsize=2)
def text_encoder(path: str, pattern: str) -> Encoder:
    """An encoder that sends each match of the pattern through the transducer."""
    machine, split = transducer(path), regex.compile(pattern)
    find, first = split.findall, split.match

    def encode(piece: str) -> bytes:
        whole = first(piece)
        if whole is not None and whole.end() == len(piece):
            return pack_ids(machine.encode(piece.encode("utf-8", "surrogatepass")))
        return pack_ids([i for match in find(piece)
                         for i in machine.encode(match.encode("utf-8", "surrogatepass"))])

    return Encoder(encode, 3 * MEMO)


def encode(text_col: str, path: str, pattern: str) -> Column:
    """The ids of the whole text, little-endian unsigned 32-bit; null counts as empty.

    ``path`` is a file of ranks, ``pattern`` what splits a text before merges. The pattern has to
    cut between letters and punctuation and at white space, as those of byte-level BPE do.
    """
    def of(batch: pa.Array) -> pa.Array:
        encoder = text_encoder(path, pattern)
        return pa.array([encoder(t.as_py()) for t in batch], type=pa.binary())

    # Else the plan would encode again inside of what uses the ids.
    return F.arrow_udf(of, "binary").asNondeterministic()(whole_text(text_col))


def encode_and_decode(text_col: str, path: str, pattern: str) -> Column:
    """A struct of :func:`encode` of the text, ``ids``, and :func:`decode` of these, ``text``.

    One pass: the text goes to one Python worker, where both columns would take two.
    """
    kind = pa.struct([("ids", pa.binary()), ("text", pa.string())])

    def of(batch: pa.Array) -> pa.Array:
        encoder, table = text_encoder(path, pattern), transducer(path).bytes_of
        ids = [encoder(t.as_py()) for t in batch]
        return pa.array([{"ids": i, "text": _text(i, table)} for i in ids], type=kind)

    return F.arrow_udf(of, "ids binary, text string")(whole_text(text_col))


def _text(ids: bytes, table: Sequence[bytes]) -> str:
    stream = StreamDecoder(table)
    return "".join([*map(stream.feed, _pieces(ids)), stream.end()])


def _pieces(ids: bytes, size: int = 8192) -> Iterator[list[int]]:
    for k in range(0, len(ids), 4 * size):
        yield np.frombuffer(ids[k:k + 4 * size], dtype="<u4").tolist()


def decode(ids: Column, path: str) -> Column:
    """The text of a column of ids, decoded as a stream; null where the ids are null."""
    def of(batch: pa.Array) -> pa.Array:
        table = _token_bytes(path)
        return pa.array([_text(v.as_py(), table) if v.is_valid else None for v in batch],
                        type=pa.string())

    return F.arrow_udf(of, "string")(ids)
