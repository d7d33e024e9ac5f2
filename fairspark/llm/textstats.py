"""Exact statistics of many texts at once, shared by the quality rules and the classifier."""

from __future__ import annotations

import numpy as np

from .textvec import BYTE, NOT_SPACE, U, Words, grams, mix, place

#: fixed values: the symbols that the rules count
SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 5


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of a per-place array over each document."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def count_bytes(buf: np.ndarray, off: np.ndarray, values) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return per_doc(table[buf], off)


def lines(buf: np.ndarray, off: np.ndarray):
    """Start, end and document of every ``\\n``-split line; an empty text has one empty line."""
    breaks = np.flatnonzero(buf == 10)
    start = np.concatenate([off[:-1], breaks + 1])
    doc = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, breaks, side="right") - 1])
    order = np.lexsort((start, doc))
    start, doc = start[order], doc[order]
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.empty(0, bool)
    end = np.where(last, off[doc + 1], np.append(start[1:], 0) - 1)
    return start, end, doc


def line_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each line; the lines cover the bytes in order, each followed by one break or none."""
    size = end - start
    out = np.zeros(len(size), dtype=U)
    full = size > 0
    if full.any():
        s, n = start[full], size[full]
        at = np.concatenate([[0], np.cumsum(n)[:-1]])
        nth = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(at, n)
        out[full] = mix(np.add.reduceat(BYTE[buf[nth + np.repeat(s, n)]] * place(int(n.max()))[nth], at))
    return out


def per_doc_distinct(keys: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Number of distinct keys of each document."""
    tagged, first = np.unique(mix(keys + mix(doc.astype(U) + U(1))), return_index=True)
    return np.bincount(doc[first], minlength=n_docs)


def base_stats(buf: np.ndarray, off: np.ndarray, words: Words | None = None) -> dict[str, np.ndarray]:
    """``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` of each text."""
    n_docs = len(off) - 1
    words = words or Words(buf, off)
    n_words = np.diff(words.first)
    in_word = NOT_SPACE[buf]
    word_chars = per_doc(in_word & ((buf & 0xC0) != 0x80), off)
    start, end, doc = lines(buf, off)
    seen = np.concatenate([[0], np.cumsum(in_word, dtype=np.int64)])
    has = seen[end] > seen[start]
    h = line_hashes(buf, start[has], end[has])
    n_lines = np.bincount(doc[has], minlength=n_docs)
    dup = n_lines - per_doc_distinct(h, doc[has], n_docs)
    g, of = grams(words.hash, WINDOW_WORDS), words.doc()
    repeat = np.zeros(n_docs, np.int64)
    if len(g):
        inside = of[:len(g)] == of[WINDOW_WORDS - 1:]
        at = np.flatnonzero(inside)
        tagged = mix(g[at] + mix(of[at].astype(U) + U(1)))
        order = np.argsort(tagged)
        same = tagged[order][1:] == tagged[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        mark = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(mark, at[twice], 1)
        np.add.at(mark, at[twice] + WINDOW_WORDS, -1)
        repeat = per_doc(np.cumsum(mark)[:-1] > 0, words.first)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": count_bytes(buf, off, SYMBOLS),
            "n_lines": n_lines, "n_dup_lines": dup, "n_repeat_words": repeat}
