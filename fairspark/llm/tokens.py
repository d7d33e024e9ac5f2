"""Token ids by the tokenizers library, with caches over the texts' own pieces.

Both vocabularies cut a text into pieces before merging, and no piece crosses a blank, so the ids
of a text are the ids of its blank-separated units on end, and those of a unit the ids of its
pieces.  The library's model merges each distinct piece once; units are kept as bytes and the texts
joined from them.  White space needs care only where it is itself a token (byte-level vocabulary):
a text in which two white-space characters meet takes the vocabulary's own split pattern instead
of the plain split.
"""

from __future__ import annotations

import contextlib
import functools
import json
import struct
import unicodedata
from collections.abc import Callable

import regex

from .textvec import CACHES

#: Entries of the caches of units and of pieces.  Full caches keep what is in use (what was looked up
#: since the last turn), which changes the speed and not the ids; a cache outgrows its size by one text.
CACHE_UNITS, CACHE_PIECES = 300_000, 100_000

#: fixed values: the split patterns of the two vocabularies (their files and README)
BYTE_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
WORD_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


#: Marks that are a piece by themselves behind a word.
MARKS = tuple(".,;:!?")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class UnitTokenizer:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes.

    Understands the two kinds of vocabulary file it is made for, told apart by the file's
    normaliser: byte-level ones keep white space in their tokens (``keeps_space``), word-level ones
    compose, lower-case and drop it.  Control strings of the vocabulary are ordinary text.
    """

    def __init__(self, path: str, units: int | None = None, pieces: int | None = None):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.model = self.lib.model
        with open(path, encoding="utf-8") as f:
            self.keeps_space = json.load(f)["normalizer"] is None
        self.pattern = BYTE_LEVEL if self.keeps_space else WORD_LEVEL
        self.letters = byte_letters()
        self.most = units or CACHE_UNITS, pieces or CACHE_PIECES
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.first = UnitCache(self._unit, "", self.keeps_space, self.most[0])
        self.later = UnitCache(self._unit, " ", self.keeps_space, self.most[0])
        self.newline = self._unit("\n")

    def _merged(self, piece: str) -> bytes:
        """Ids of one piece from the library's model."""
        letters = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                ids = self._merged(piece)
            if len(self.pieces) >= self.most[1] // 2:
                self.older, self.pieces = self.pieces, {}
            self.pieces[piece] = ids
        return ids

    def _unit(self, unit: str, space: str = "") -> bytes:
        """Ids of one unit, after a blank where white space is kept."""
        text = unit
        if not self.keeps_space:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            # one character at a time, without the rule for the last sigma of a word
            text = text.lower() if "\u03a3" not in text else "".join([c.lower() for c in text])
        # most units are letters, or letters and one mark: no need of the pattern.  What a unit's own
        # entry holds is no piece as well, and letters before a mark are looked up as a unit
        if text.isalpha():
            if text == unit:
                return self._merged(space + text)
            return self.first[text] if text.isascii() else self._piece(text)
        if text[-1:] in MARKS and text[:-1].isalpha():
            letters = text[:-1]
            if text == unit or letters.isascii():
                return (self.later if space else self.first)[letters] + self._piece(text[-1])
            return self._piece(letters) + self._piece(text[-1])
        return b"".join([self._piece(p) for p in self.pattern.findall(space + text)])

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.keeps_space:
            return [self._spaced(t) for t in texts]
        get, out = self.first.__getitem__, []
        for t in texts:
            out.append(b"".join(map(get, t.replace("\n", " ").split(" "))))
            self.first.turn()
        return out

    def _spaced(self, text: str) -> bytes:
        """Ids of one text where white space is kept."""
        first, later = self.first, self.later
        first.turn()
        later.turn()
        if not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text):
            get, lines = later.__getitem__, []
            with contextlib.suppress(TypeError):  # a unit with other white space inside has no ids
                for line in text.split("\n"):
                    head, *rest = line.split(" ")
                    lines.append(first[head] + b"".join(map(get, rest)))
                return self.newline.join(lines)
        return b"".join([self._piece(u) for u in BYTE_LEVEL.findall(text)])


class UnitCache(dict):
    """Ids by unit, learnt at the first look-up.

    Two generations of ``most / 2`` entries: ``turn`` begins a new one where this one is full, and
    what is looked up again moves over, so units in use stay.  A unit of byte-level vocabularies
    with white space other than its leading blank has no ids of its own and is kept as None.
    """

    def __init__(self, learn: Callable[[str, str], bytes], prefix: str, whole: bool, most: int):
        super().__init__()
        self.learn, self.prefix, self.whole, self.most = learn, prefix, whole, most
        self.older: dict[str, bytes | None] = {}

    def __missing__(self, unit: str) -> bytes | None:
        ids = self.older.get(unit)
        if ids is None and not (self.whole and unit and unit.split() != [unit]):
            ids = self.learn(unit, self.prefix)
        self[unit] = ids
        return ids

    def turn(self) -> None:
        if len(self) > self.most // 2:
            self.older = dict(self)
            self.clear()


@functools.lru_cache(maxsize=1)
def tokenizer(path: str, units: int | None = None, pieces: int | None = None) -> UnitTokenizer:
    """The worker's tokenizer of this vocabulary, kept until another operator runs in the worker;
    ``units`` and ``pieces`` are the most entries of its caches, where not the usual ones."""
    return UnitTokenizer(path, units, pieces)


CACHES.append(tokenizer.cache_clear)
