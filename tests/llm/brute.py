"""Plain Python versions of the operators' contracts, over whole small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

LOWER = {c: c + 32 for c in range(65, 91)}
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def near_duplicates(docs):
    """docs: list of (doc_id, text) -> {position: (n_shingles, component)}."""
    sets = []
    for _, text in docs:
        w = SPACE_WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in where[x] if j < i)
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)].append(doc)
    return [(doc, len(s), min(least[find(i)], default=None) if s else doc) for i, ((doc, _), s) in enumerate(zip(docs, sets))]


def contamination(docs, items, window=10):
    at = defaultdict(set)
    sizes = set()
    for k, (_, text) in enumerate(items):
        w = ALNUM_WORD.findall((text or "").translate(LOWER))
        m = min(window, len(w))
        if m:
            sizes.add(m)
            for i in range(len(w) - m + 1):
                at[tuple(w[i:i + m])].add(k)
    out = []
    for doc, text in docs:
        w = ALNUM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                ks = at.get(tuple(w[i:i + m]))
                if ks:
                    hit.update(range(i, i + m))
                    found |= ks
        ids = sorted(str(items[k][0]) for k in found if items[k][0] is not None)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def base_stats(text):
    text = text or ""
    w = SPACE_WORD.findall(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    rep = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            rep.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(rep)


def repeats(docs, length, keep_first=False):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) per row; rows equal in id and text are one with keep_first."""
    data = [(t or "").encode() for _, t in docs]
    seen = defaultdict(list)
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    for i in order:
        for p in range(len(data[i]) - length + 1):
            seen[hashlib.blake2b(data[i][p:p + length], digest_size=12).digest()].append((i, p))
    cover = [np.zeros(len(d) + 1, int) for d in data]
    for places in seen.values():
        first = places[0]
        for i, p in places:
            if keep_first:
                same = p == first[1] and docs[i] == docs[first[0]]
                if same:
                    continue
            elif len(places) < 2:
                continue
            cover[i][p] += 1
            cover[i][p + length] -= 1
    out = []
    for (doc, _), d, c in zip(docs, data, cover):
        gone = np.cumsum(c)[:-1] > 0
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        starts = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(d) else 0
        out.append((doc, len(d), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def token_ids(lib, text, end):
    ids = lib.encode(text or "", add_special_tokens=False).ids + [end]
    return np.array(ids, "<u4")


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
