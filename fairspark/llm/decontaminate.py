"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every run of words of the (small) benchmark.  A document's words are streamed
through it while the length of the longest matching run is tracked: a run of ``WINDOW`` words, or a
whole item of fewer words, is a hit, and its words are marked.  Before that, one numpy pass over
word hashes leaves only stretches whose every short gram occurs in the benchmark, so almost all text
never reaches the word-by-word walk.

Words are runs of ASCII digits, letters (A-Z lower-cased) and non-ASCII bytes.

Defined results: null and empty texts have no words and no hits; an item without words matches
nothing; every row of the benchmark is an item of its own, also where ids or whole rows repeat (its id
then stands in ``items`` once for each), and an item without an id is a null in ``items``: counted, and
no part of the digest; repeated rows are separate documents; an empty benchmark leaves every document
clean; extra columns are kept and result names replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import carried, key_sketch, maybe_in, restored, stage, table
from .textvec import ALNUM, U, Words, chunks, flat, grams

WINDOW = 10
#: Characters of benchmark text that one automaton may hold (what is sent to every task, and the most
#: that driver or worker holds at a time, some 300 MB as Python objects); a larger benchmark is dealt to
#: several automata of about that size, each with a pass of its own.  An item is never cut.
MAX_BENCHMARK_CHARS = 2_000_000


class SuffixAutomaton:
    """Generalised suffix automaton; a state also knows which items hold a hit that ends in it."""

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[object] = []
        ends: list[tuple[int, int, int]] = []
        for item, words in items:
            if not len(words):
                continue
            k, last = len(self.items), 0
            self.items.append(item)
            for w in words.tolist():
                last = self._add(last, w)
        # walk every item again: the states of its prefixes and all their suffixes belong to it
        self.hits: list[set[int]] = [set() for _ in self.next]
        self.short: list[list[tuple[int, int]]] = [[] for _ in self.next]
        k = -1
        for item, words in items:
            if not len(words):
                continue
            k, state = k + 1, 0
            for w in words.tolist():
                state = self.next[state][w]
                v = state
                while v > 0 and self.length[v] >= window and k not in self.hits[v]:
                    self.hits[v].add(k)
                    v = self.link[v]
            if len(words) < window:
                v = state
                while self.length[self.link[v]] >= len(words):
                    v = self.link[v]
                self.short[v].append((len(words), k))
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[v] = self.short[v] + self.short[self.link[v]]

    def _add(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        return clone

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, set[int] | tuple]]:
        """``(end, length of the hit, items)`` for every place where a hit ends."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        v = n = 0
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                n = length[v]
            to = nxt[v].get(w)
            if to is None:
                v = n = 0
                continue
            v, n = to, n + 1
            if n >= window:
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                yield i + 1, window, self.hits[u]
            if self.short[v]:
                found = [(m, k) for m, k in self.short[v] if m <= n]
                for m in {m for m, _ in found}:
                    yield i + 1, m, {k for x, k in found if x == m}


class Matcher:
    """An automaton with the vocabulary and grams that let texts pass by it."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        texts = pa.array([t for _, t in items], pa.string())
        words = Words(*flat(texts), ALNUM, lower=True)
        runs = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        runs = [r for r in runs if len(r)]
        self.vocabulary = np.unique(np.concatenate(runs)) if runs else np.empty(0, U)
        self.least = min([window, *[len(r) for r in runs]])
        self.gram = min(3, self.least)
        self.grams = np.unique(np.concatenate([grams(r, self.gram) for r in runs])) if runs else np.empty(0, U)
        ids = [np.searchsorted(self.vocabulary, words.hash[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
        self.automaton = SuffixAutomaton([(i, r) for (i, _), r in zip(items, ids)], window)

    def hits(self, words: Words) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Which words are hit, and the items that occur in each text that has any."""
        hit = np.zeros(len(words.hash), dtype=bool)
        found: dict[int, set[int]] = {}
        if not len(self.grams) or not len(words.hash):
            return hit, found
        g = grams(words.hash, self.gram)
        doc = words.doc()
        known = np.zeros(len(words.hash) + 1, dtype=bool)
        at = np.searchsorted(self.grams, g)
        known[:len(g)] = (self.grams[np.minimum(at, len(self.grams) - 1)] == g) & (doc[:len(g)] == doc[self.gram - 1:])
        # runs of known grams inside one text
        start = np.flatnonzero(known[:-1] & ~np.concatenate([[False], known[:-2] & (doc[1:] == doc[:-1])]))
        stop = np.flatnonzero(known[:-1] & ~np.concatenate([known[1:-1] & (doc[1:] == doc[:-1]), [False]])) + self.gram
        for a, b in zip(start.tolist(), stop.tolist()):
            if b - a < self.least:
                continue
            ids = np.searchsorted(self.vocabulary, words.hash[a:b]).tolist()
            for end, n, items in self.automaton.stream(ids):
                hit[a + end - n:a + end] = True
                found.setdefault(int(doc[a]), set()).update(items)
        return hit, found


def matchers(benchmark: DataFrame, window: int = WINDOW, max_chars: int = MAX_BENCHMARK_CHARS) -> Iterator[Matcher]:
    """One matcher if the benchmark is within the bound, else one for each part of about that size,
    built when it is asked for."""
    chars = benchmark.agg(F.sum(F.length("text") + 16)).head()[0] or 0
    parts = max(1, -(-chars // max_chars))
    items = benchmark.select("item_id", "text")
    if parts > 1:
        # dealt by row, so equal rows spread too; written, so every pass sees the same parts
        items = stage(items.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts))), "benchmark")
    for k in range(parts):
        some = items.filter(F.col("part") == k) if parts > 1 else items
        yield Matcher([(r["item_id"], r["text"]) for r in some.collect()], window)


RESULT = [("n_words", T.LongType()), ("hits", T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))),
    ("items", T.ArrayType(T.StringType()))]


NAMES = [n for n, _ in RESULT]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       max_chars: int = MAX_BENCHMARK_CHARS) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (maximal runs of hit words: word range and byte range) and ``items``.

    A benchmark over ``max_chars`` takes one pass over the texts for each of its parts; what a pass
    finds is written, and the passes are merged by text.
    """
    docs = docs.drop(*NAMES)
    ms = matchers(benchmark, window, max_chars)
    first = next(ms)
    second = next(ms, None)
    if second is None:
        return matched(docs, first)
    key = F.sha2(F.col("text").cast("binary"), 256).alias("key")
    found = None
    for m in chain([first, second], ms):
        hit = matched(docs.select("text"), m).filter(F.size("hits") > 0)
        # copies of a text have the same hits: one row each, before any shuffle
        one = stage(hit.select(key, "hits", "items").groupBy("key").agg(F.first("hits").alias("hits"), F.first("items").alias("items")),
                    "contamination")
        found = one if found is None else found.unionByName(one)
    # at most a row for each part and text
    by_text = stage(found.groupBy("key").agg(F.flatten(F.collect_list("hits")).alias("_hits"),
                                             F.flatten(F.collect_list("items")).alias("_items")), "contaminated")
    return _merged(docs, by_text)


def matched(docs: DataFrame, matcher: Matcher) -> DataFrame:
    """``docs`` with the result columns for the items of one matcher, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                buf, off = flat(part.column(part.schema.get_field_index("text")))
                words = Words(buf, off, ALNUM, lower=True)
                hit, found = matcher.hits(words)
                doc = words.doc()
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                new = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.empty(0, bool)
                prev = np.concatenate([[False], hit[:-1]]) if len(hit) else hit
                first = np.flatnonzero(hit & (~prev | new))
                nxt = np.concatenate([hit[1:], [False]]) if len(hit) else hit
                last = np.flatnonzero(hit & (~nxt | np.concatenate([new[1:], [True]]))) if len(hit) else first
                for a, b in zip(first.tolist(), last.tolist()):
                    d = int(doc[a])
                    spans[d].append({"start": a - int(words.first[d]), "end": b + 1 - int(words.first[d]),
                                     "first": int(words.start[a] - off[d]), "last": int(words.end[b] - off[d])})
                ids = matcher.automaton.items
                items = [sorted((None if ids[k] is None else str(ids[k]) for k in found.get(d, ())),
                                key=lambda x: (x is not None, x or "")) for d in range(part.num_rows)]
                kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "end", "first", "last")]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(words.first), pa.int64()), pa.array(spans, kind),
                     pa.array(items, pa.list_(pa.string()))],
                    names=[*part.schema.names, *NAMES])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in RESULT]]))


#: Rows of one text reach this many join tasks for each row of its hits.
TEXT_SALTS = 32

#: Spans of several passes as maximal runs: each extends the last one, or starts a run.
_RUNS = """aggregate(array_sort(_hits), cast(array() as array<struct<start: bigint, end: bigint, first: bigint, last: bigint>>),
    (acc, h) -> if(size(acc) > 0 and h.start <= element_at(acc, -1).end,
        concat(slice(acc, 1, size(acc) - 1), array(named_struct(
            'start', element_at(acc, -1).start, 'end', greatest(h.end, element_at(acc, -1).end),
            'first', element_at(acc, -1).first, 'last', greatest(h.last, element_at(acc, -1).last)))),
        concat(acc, array(h))))"""


def _merged(docs: DataFrame, by_text: DataFrame) -> DataFrame:
    """``docs`` with the result columns out of ``by_text`` (key, _hits, _items), one row a text.

    Only rows that may have hits are shuffled, and the copies of one text go to ``TEXT_SALTS`` tasks.
    """
    counted = matched(docs, Matcher([])).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "n_words",
                                                F.sha2(F.col("text").cast("binary"), 256).alias("key"))
    sketch = key_sketch(by_text, "key")
    clean = maybe_in(counted, "key", sketch, negate=True).withColumns({"_hits": F.lit(None).cast(RESULT[1][1]),
                                                                       "_items": F.lit(None).cast(RESULT[2][1])})
    salted = maybe_in(counted, "key", sketch).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(TEXT_SALTS)).cast("int"))
    copies = by_text.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(TEXT_SALTS - 1))))
    joined = salted.join(copies, ["key", "salt"], "left").drop("salt")
    return clean.unionByName(joined.select(*clean.columns)).select(
        *[F.col("_doc").getField(c).alias(c) for c in docs.columns], "n_words",
        F.coalesce(F.expr(_RUNS), F.array().cast(RESULT[1][1])).alias("hits"),
        F.coalesce(F.sort_array("_items"), F.array().cast(RESULT[2][1])).alias("items"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + h["end"] - h["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the hit passages; one of which nothing is left goes as a whole."""
    found = find_contamination(carried(docs), table(spark, sf_dir, "benchmark"))
    raw = F.col("text").cast("binary")
    kept = F.concat_ws("", F.transform(
        F.sequence(F.lit(0), F.size("hits")),
        lambda i: F.substring(raw, F.when(i == 0, 0).otherwise(F.get(F.col("hits.last"), i - 1)).cast("int") + 1,
                              (F.coalesce(F.get(F.col("hits.first"), i), F.octet_length("text"))
                               - F.when(i == 0, 0).otherwise(F.get(F.col("hits.last"), i - 1))).cast("int")).cast("string")))
    cut = F.when(F.size("hits") > 0, kept).otherwise(F.col("text"))
    out = found.withColumn("text", cut).filter((F.size("hits") == 0) | (F.length(F.trim("text")) > 0))
    return restored(out, docs.columns, F.size("hits") > 0)
