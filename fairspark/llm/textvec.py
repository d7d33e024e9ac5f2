"""Vectorised text primitives: words, hashes and shingles of many texts in one numpy pass.

A batch of texts is one byte array with offsets, straight from the Arrow buffers.  Words are
maximal runs of allowed bytes inside one text; each gets a 64-bit multilinear hash (a random odd
number per byte value times a random number per place), so equal words have equal hashes and two
different ones meet with probability about 2^-63.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text that one numpy pass takes at most (a longer text is a pass of its own).
CHUNK = 1 << 19

#: What a reused Python worker still holds for other operators; emptied before a numpy pass begins.
CACHES: list[Callable[[], None]] = []


def give_back() -> None:
    """Return freed memory of this worker to the system, which the executor's other worker may need."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective): spreads every input bit over the whole word."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit words from a counter."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 0x632BE59BD9B4E019 % 2**64))


BYTE = stream(256, 11) | U(1)
_PLACE = [stream(4096, 12)]


def place(n: int) -> np.ndarray:
    if n > len(_PLACE[0]):
        _PLACE[0] = stream(1 << (n - 1).bit_length(), 12)
    return _PLACE[0]


def _table(allowed) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(allowed)] = True
    return t


#: byte tables of the two word classes: everything but ASCII white space; digits, a-z and non-ASCII
NOT_SPACE = _table(set(range(256)) - {0x20, 9, 10, 11, 12, 13})
ALNUM = _table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes on end and their n + 1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    big = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64 if big else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    return buf, off - off[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK, clear: bool = True) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with at most ``limit`` bytes of the text column each (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    for drop in CACHES if clear else ():
        drop()
    _, off = flat(batch.column(batch.schema.get_field_index(column)))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
    give_back()


class Words:
    """The words of many texts: byte ranges, 64-bit hashes and the first word of each text."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, allowed: np.ndarray = NOT_SPACE, lower: bool = False):
        n = len(buf)
        text = LOWER[buf] if lower else buf
        ok = allowed[text]
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = ok[:-1]
        self.start = np.flatnonzero(ok & (~before | edge[:-1]))
        after = np.zeros(n, dtype=bool)
        after[:-1] = ok[1:]
        self.end = np.flatnonzero(ok & (~after | edge[1:])) + 1
        #: index of the first word of each text, and the total at the end
        self.first = np.searchsorted(self.start, off)
        size = self.end - self.start
        at = np.zeros(len(size), dtype=np.int64)
        np.cumsum(size[:-1], out=at[1:]) if len(size) else None
        if len(size):
            nth = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(at, size)
            term = BYTE[text[ok]] * place(int(size.max()))[nth]
            self.hash = mix(np.add.reduceat(term, at))
        else:
            self.hash = np.empty(0, U)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_STEP = stream(64, 13) | U(1)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words (of one text, or masked by the caller at text edges)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, U)
    total = np.zeros(m, dtype=U)
    for k in range(n):
        total += words[k:k + m] * _STEP[k]
    return mix(total + U(n))


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of one text; a shorter text is one shingle."""
    if not len(words):
        return np.empty(0, U)
    return np.unique(grams(words, min(n, len(words))))
