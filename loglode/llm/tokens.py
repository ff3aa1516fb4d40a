"""Token ids of whole texts with the tokenizers library, each different piece of text encoded once."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from loglode.llm.shingles import FOLD, buffers, slices

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces of text in each of the two generations that a worker keeps the ids of, some 200 bytes each.
KEPT = 500_000
#: Bytes of text that are encoded together.
TOGETHER = 6 << 20
#: White space other than a space and a line feed, and marks that some count as white space. A text
#: with one of them is encoded as a whole.
OTHER_SPACE = (
    r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}"
    r"\x{205f}-\x{2064}\x{3000}\x{feff}]"
)
LETTER, STOP = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
STOP[[ord(c) for c in "!,.:;?"]] = True
LETTERS = re.compile("[ ]?[A-Za-z]+")
SPACE_SIGN = "\u0120"
_kept: dict[str, "Encoder"] = {}


class Encoder:
    """A tokenizer that keeps the ids of the pieces it has met lately.

    Neither vocabulary has a token that reaches from text over the white space after it, nor from
    an ASCII letter to a full stop or the like. So a text may be cut there and encoded in pieces.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that are one token of their own wherever they stand; a text with one is encoded as a whole.
        own = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([OTHER_SPACE, *own])
        #: The vocabulary knows neither case nor white space.
        self.plain = self.whole(["Aa B\n\nc"])[0] == self.whole(["aa  b c"])[0]
        self.forget()

    def forget(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, pieces: list[str]) -> Iterator[list[int]]:
        """The ids of each piece. One of ASCII letters, after a space at most, is one pre-token, so
        the model can have it without the steps before; it shows a space as its own sign."""
        model = self.tokenizer.model
        simple = [LETTERS.fullmatch(piece) is not None for piece in pieces]
        rest = [piece for piece, alone in zip(pieces, simple, strict=True) if not alone]
        others = chain.from_iterable(
            self.whole(rest[at : at + 10_000]) for at in range(0, len(rest), 10_000)
        )
        for piece, alone in zip(pieces, simple, strict=True):
            if alone:
                yield [token.id for token in model.tokenize(piece.replace(" ", SPACE_SIGN))]
            else:
                yield next(others)

    def looked_up(self, pieces: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of all pieces in one array, and the start and length of each piece's own.

        Pieces are kept in two generations: what is met again while it is old becomes young again, and
        when there are KEPT young ones the old ones go.
        """
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        new = []
        for i, ids in enumerate(found):
            if ids is None:
                piece = pieces[i]
                ids = old.get(piece)
                if ids is None:
                    new.append(i)
                else:
                    young[piece] = found[i] = ids
        for i, ids in zip(new, self.pieces([pieces[i] for i in new]), strict=True):
            young[pieces[i]] = found[i] = array("I", ids).tobytes()
        if len(young) > KEPT:
            self.young, self.old = {}, young
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.uint32), np.cumsum(lengths) - lengths, lengths

    def texts(self, offsets: np.ndarray, data: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each text whose only white space are spaces and line feeds."""
        chars = data[int(offsets[0]) : int(offsets[-1])]
        bounds = offsets - offsets[0]
        gap = (chars == 0x20) | (chars == 0x0A)
        cut = np.zeros(len(chars) + 1, bool)
        cut[1:-1] = gap[1:] & ~gap[:-1] | LETTER[chars[:-1]] & STOP[chars[1:]]
        cut[bounds] = True
        if self.plain:
            # Without the gaps; a piece starts where text follows one.
            cut[1:-1] |= gap[:-1]
            place = np.concatenate([[0], np.cumsum(~gap)])
            chars, cut, bounds = FOLD[chars[~gap]], np.append(cut[:-1][~gap], True), place[bounds]
        begins = np.flatnonzero(cut)
        pieces = pa.LargeStringArray.from_buffers(
            len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(np.ascontiguousarray(chars))
        ).dictionary_encode()
        at = pieces.indices.to_numpy(zero_copy_only=False)
        flat, starts, lengths = self.looked_up(pieces.dictionary.to_pylist())
        ids = gathered(flat, starts[at], lengths[at])
        ends = np.concatenate([[0], np.cumsum(lengths[at])])[np.searchsorted(begins, bounds)]
        for start, end in zip(ends[:-1], ends[1:], strict=True):
            yield ids[start:end]


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` with these starts and lengths, one after the other."""
    if not len(starts):
        return flat[:0]
    ends = np.cumsum(lengths)
    return flat[np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)]


def encoder(path: str) -> Encoder:
    """The worker's own encoder for a vocabulary file."""
    if path not in _kept:
        _kept[path] = Encoder(path)
    return _kept[path]


def encoded(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text of a column; a null is an empty text."""
    own = encoder(path)
    odd = pc.match_substring_regex(texts, own.odd, ignore_case=True).fill_null(False)
    offsets, data = buffers(texts.filter(pc.invert(odd)))
    simple = (ids for a, b in slices(offsets, TOGETHER) for ids in own.texts(offsets[a : b + 1], data))
    whole = (own.whole([text])[0] for text in texts.filter(odd).to_pylist())
    for is_odd in odd.to_pylist():
        yield np.array(next(whole), np.uint32) if is_odd else next(simple)
