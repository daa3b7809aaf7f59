"""Token ids of whole texts by a public tokenizer, piece by piece.

The pre-tokenizers of these files cut a text before any merge, so a text gives the same ids whether
it is encoded whole or cut at some of the same places. Pieces repeat from text to text, so each is
encoded once and kept in a bounded memo.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Callable, Sequence

from tokenizers import Tokenizer

_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"  # Unicode's White_Space
# Latin letters that stay letters in lower case.
_LETTER = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u012f\\u0131-\\u02af"
#: Where a pre-tokenizer cuts in any case: after letters before ASCII punctuation; before a space
#: that ends white space; around the last character of other white space. Earlier white space
#: stands on its own, as it does in the whole text.
_PIECE = re.compile(
    rf" ?[{_LETTER}]++(?=[!-/:-@\[-`{{-~{_SPACE}])| ?[^{_SPACE}]+"
    rf"|[{_SPACE}]+(?=[{_SPACE}][^{_SPACE}])|[{_SPACE}](?=[^{_SPACE}])|[{_SPACE}]+")
_WORD = re.compile(f" ?[{_LETTER}]+")
#: Pieces kept in each of two generations, about: each generation ends at ``_PIECE_BYTES`` times
#: as many bytes, here some 25 MB in a worker, however long the pieces are.
MEMO = 100_000
_PIECE_BYTES = 256
#: Longer pieces hardly come again.
_LONGEST = 64


def pack_ids(ids: Sequence[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Memo(dict):
    """Pieces to their ids; a piece that is missing comes from the generation before or is encoded."""

    def __init__(self, old: dict[str, bytes], encode: Callable[[str], bytes]) -> None:
        super().__init__()
        self._old, self._encode, self.held = old, encode, 0

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > _LONGEST:
            return self._encode(piece)
        ids = self[piece] = self._old.get(piece) or self._encode(piece)
        self.held += 200 + 4 * len(piece) + len(ids)
        return ids


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, through a function that encodes a piece.

    A text that holds one of the ``whole`` strings is encoded in one piece.
    """

    def __init__(self, encode: Callable[[str], bytes], memo: int = MEMO,
                 whole: Sequence[str] = ()) -> None:
        self._encode, self._size, self._whole = encode, memo * _PIECE_BYTES, tuple(whole)
        self._memo = _Memo({}, encode)

    def __call__(self, text: str) -> bytes:
        for whole in self._whole:
            if whole in text:
                return self._encode(text)
        if self._memo.held > self._size:
            self._memo = _Memo(dict(self._memo), self._encode)
        return b"".join(map(self._memo.__getitem__, _PIECE.findall(text)))


def _byte_symbols() -> dict[int, str]:
    """Byte values to the characters that byte-level vocabularies are written in."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(others)}}


_SYMBOLS = _byte_symbols()
#: What a word becomes before it is merged: as it is, or in lower case without its space.
#: Of ASCII letters and spaces, only the space has another symbol.
_SPACE_SYMBOL = _SYMBOLS[32]
_FORMS: tuple[Callable[[str], str], ...] = (
    lambda w: (w.replace(" ", _SPACE_SYMBOL) if w.isascii()
               else w.encode().decode("latin-1").translate(_SYMBOLS)),
    lambda w: w.lstrip(" ").lower().encode().decode("latin-1").translate(_SYMBOLS),
)
_PROBES = (" the", "The", " Zürich", "ÉTÉ", " ŒUVRE", "x", " straße", "Nation", " ñandú")


def _word_form(tokenizer: Tokenizer) -> Callable[[str], str] | None:
    """The form in which the tokenizer's model takes a word, if it is one of those known here."""
    for form in _FORMS:
        if all([t.id for t in tokenizer.model.tokenize(form(w))]
               == tokenizer.encode(w, add_special_tokens=False).ids for w in _PROBES):
            return form
    return None


@functools.lru_cache(maxsize=4)
def library_encoder(path: str, memo: int = MEMO, specials: bool = True) -> Encoder:
    """An encoder by a file of the tokenizers library, kept for the life of the process.

    No special tokens are added. Where a text holds the string of one, that becomes its id, as in
    the library; without ``specials`` it is ordinary text. A piece that is one word goes to the
    library's model at once, any other through its whole chain.
    """
    tokenizer = Tokenizer.from_file(path)
    added = list(tokenizer.get_added_tokens_decoder().values())
    if any(t.normalized for t in added):
        raise ValueError("tokens that stand for normalised text are not supported")
    tokenizer.encode_special_tokens = not specials
    tokenizer.no_truncation()
    tokenizer.no_padding()
    form, is_word, merged = _word_form(tokenizer), _WORD.fullmatch, tokenizer.model.tokenize

    def encode(piece: str) -> bytes:
        if form is not None and is_word(piece):
            return pack_ids([t.id for t in merged(form(piece))])
        return pack_ids(tokenizer.encode(piece, add_special_tokens=False).ids)

    return Encoder(encode, memo, [t.content for t in added if specials or not t.special])
