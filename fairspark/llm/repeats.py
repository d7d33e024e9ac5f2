"""Repeated passages by longest-previous-factor arrays over suffix order.

Every string of ``LENGTH`` bytes holds one anchor: the least hash among its ``GRAM``-byte grams.
Equal strings have the same anchor at the same place, so all copies of a string meet in the group of
that anchor's hash, and an anchor that stands once in the corpus rules out its strings at once.  The
strings of one anchor are a run of starts; the bytes they cover are its context.  Contexts that are
equal as a whole are one class and only counted.  Where classes differ, their texts go, shard by
shard, into suffix orders of whole anchors (prefix doubling to the needed depth, corpus order within
equal prefixes).  There the nearest starts with a smaller (larger) position on either side give each start
its longest previous (next) factor, as a length and a source: a start whose previous factor reaches
``LENGTH`` bytes has an earlier copy.  Factors are measured up to ``LENGTH`` bytes, which is all that
the threshold reads.

``keep_first`` removes later copies and keeps the first (by id, then place); without it every copy
goes.  Strings are judged on the input, matches never cross documents, and overlaps count.

The same machinery finds repeated runs of words: with ``unit=WORD`` a text is the sequence of its
words' 64-bit hashes, eight bytes each, and lengths count those bytes; strings start at words, and anchors
and suffix orders take a word as one symbol.  A removed word goes with all its characters and the white
space around a removed run stays.

Defined results: null text is empty and texts under ``LENGTH`` bytes lose nothing; null ids come
first; with ``keep_first`` rows equal in id and text are one document and keep the same bytes; an
empty table gives no rows; extra columns are kept and ``spans`` and ``kept_bytes`` replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import carried, key_sketch, maybe_in, restored, stage, table
from .textvec import BYTE, U, Words, chunks, flat, give_back, mix

LENGTH, GRAM = 400, 96
#: Bytes of a unit of text: a byte as it is, or a word as its hash.
BYTES, WORD = 1, 8
#: Words of a passage that the pipeline's stage removes, and the query counts, where it repeats.
PASSAGE_WORDS = 50
#: Contexts of a shard (under 1 MB of text).  An anchor with more classes than that (of bytes; of words, which
#: are one symbol for eight bytes, eight times as many) is not sorted in one place: its strings are grouped one
#: by one instead.
SHARD_CONTEXTS = 1_500
#: Bytes of contexts that one suffix order takes, beside the rest of the last anchor in it.
SORT_BYTES = 256 << 10
#: Bytes of contexts in one Arrow batch, beside the rest of the last text in it.
CONTEXT_BYTES = 4 << 20

#: Bytes that one numpy pass takes of a long text, and bits of a place in it.
SEGMENT, PLACE_BITS = 8 << 20, 24
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(int(_BASE), -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_POWERS[0]):
        for k, b in enumerate((_BASE, _INVERSE)):
            _POWERS[k] = np.concatenate([np.ones(1, U), np.cumprod(np.full(n - 1, b, U))])
    return _POWERS[0][:n], _POWERS[1][:n]


def coded(buf: np.ndarray, off: np.ndarray, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts (bytes and offsets) in units: as they are, or their words' hashes."""
    if unit == BYTES:
        return buf, off
    words = Words(buf, off)
    return words.hash.view(np.uint8), words.first.astype(np.int64) * WORD


def one_coded(data: bytes, unit: int) -> bytes:
    if unit == BYTES:
        return data
    return coded(np.frombuffer(data, np.uint8), np.array([0, len(data)]), unit)[0].tobytes()


def symbols(coded_bytes: np.ndarray, unit: int) -> np.ndarray:
    """A 64-bit number for every unit of a coded text."""
    return BYTE[coded_bytes] if unit == BYTES else coded_bytes.view(U)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    m = len(v) - w + 1
    pad = np.concatenate([v, np.full(-len(v) % w, np.iinfo(v.dtype).max, v.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(pad, axis=1).ravel()
    back = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:m], ahead[w - 1:w - 1 + m])


def anchors_of(buf: np.ndarray, off: np.ndarray, length: int, gram: int, unit: int = BYTES):
    """``(doc, hash, context, left, right, first start)`` of every anchor; starts are within the document."""
    off, length, gram, n = off // unit, length // unit, gram // unit, len(buf) // unit
    power, inverse = _powers(n + 1)
    total = np.concatenate([np.zeros(1, U), np.cumsum(symbols(buf, unit) * power[:n])])
    g = mix((total[gram:] - total[:-gram]) * inverse[:n - gram + 1])
    low = U((1 << PLACE_BITS) - 1)
    best = sliding_min((g & ~low) | np.arange(len(g), dtype=U), length - gram + 1)
    edge = np.zeros(n + 2, np.int64)
    big = np.flatnonzero(np.diff(off) >= length)
    np.add.at(edge, off[big], 1)
    np.add.at(edge, off[big + 1] - length + 1, -1)
    valid = np.cumsum(edge)[:len(best)] > 0
    place = (best & low).astype(np.int64)
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    lo, hi = np.flatnonzero(new), np.flatnonzero(last)
    p = place[lo]
    left, right = p - lo, hi + length - p
    context = mix((total[hi + length] - total[lo]) * inverse[lo] + mix((left << 32 | right).astype(U)))
    doc = np.searchsorted(off, lo, side="right") - 1
    return doc, g[p], context, left * unit, right * unit, (lo - off[doc]) * unit


def anchors(docs: DataFrame, length: int, gram: int, unit: int = BYTES) -> DataFrame:
    """``(text_key, doc_id, hash, context, left, right, lo)`` of ``docs`` (text_key, doc_id, text)."""
    names = ["text_key", "doc_id", "hash", "context", "left", "right", "lo"]

    def rows(part: pa.RecordBatch, buf, off, at: int = 0) -> pa.RecordBatch:
        doc, *cols = anchors_of(buf, off, length, gram, unit)
        take = pa.array(doc)
        return pa.RecordBatch.from_arrays(
            [part.column(0).take(take), part.column(1).take(take), *[pa.array(c.astype(np.int64)) for c in cols[:-1]],
             pa.array(cols[-1] + at)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                buf, off = coded(*flat(part.column(2)), unit)
                if len(buf) <= SEGMENT:
                    if len(buf) >= length:
                        yield rows(part, buf, off)
                    continue
                for at in range(0, len(buf) - length + 1, SEGMENT - length):  # one long text
                    piece = buf[at:at + SEGMENT - unit]
                    yield rows(part, piece, np.array([0, len(piece)]), at)

    # a word and the white space behind it are two bytes at least
    long_enough = docs.filter(F.octet_length("text") >= (length if unit == BYTES else 2 * (length // unit) - 1))
    return long_enough.select("text_key", "doc_id", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def prefix_ranks(text: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The first 8 bytes of every suffix as a number, and ``(length, rank)`` of every suffix by its
    first bytes, for lengths doubling from 8 up to ``depth`` (of 8 or more).  A text of 64-bit symbols
    gives its symbols, and lengths count them from 1."""
    n = len(text)
    if text.dtype == U:
        word, have = text, 1
    else:
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        word, have = np.zeros(n, U), 8
        for k in range(8):
            word = word << U(8) | padded[k:k + n]
    rank = np.unique(word, return_inverse=True)[1].astype(U)
    levels = [(have, rank.astype(np.uint32))]
    while have < depth:
        step = min(have, depth - have)
        nxt = np.zeros(n, U)
        nxt[:n - step] = rank[step:]
        rank = np.unique(rank << U(32) | nxt, return_inverse=True)[1].astype(U)
        have += step
        levels.append((have, rank.astype(np.uint32)))
    return word, levels


def nearest_smaller(a: np.ndarray) -> np.ndarray:
    """For every place the last place before it with a smaller value, or -1.

    All that lies between a place and its candidate is not smaller, so a candidate that is not either hands
    on its own candidate; places whose candidate is smaller are done.
    """
    near = np.arange(-1, len(a) - 1)
    todo = np.arange(1, len(a))
    while len(todo):
        at = near[todo]
        todo = todo[(at >= 0) & (a[at] >= a[todo])]
        near[todo] = near[near[todo]]
    return near


def common_prefix(word: np.ndarray, levels: list[tuple[int, np.ndarray]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bytes (or symbols, where levels count those) that the suffixes ``i`` and ``j`` have in common, up
    to the depth of the last level."""
    depth, rank = levels[-1]
    out = np.full(len(i), depth, np.int64)
    differ = np.flatnonzero(rank[i] != rank[j])
    a, b = i[differ], j[differ]
    for have, rank in reversed(levels[:-1]):
        step = np.where(rank[a] == rank[b], have, 0)
        a, b = a + step, b + step
    out[differ] = a - i[differ]
    if levels[0][0] > 1:
        out[differ] += ((word[a] ^ word[b]).astype(">u8").view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
    return out


def factors(text: np.ndarray, starts: np.ndarray, length: int,
            unit: int = BYTES) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """``(size, source)`` of the longest previous and of the longest next factor of each of the
    ascending ``starts`` among the starts, up to ``length`` bytes; without one 0 and -1.  With
    ``unit=WORD`` starts stand at words and whole words are compared.

    In suffix order (equal prefixes in text order) the earlier start with most in common is the nearest
    smaller position on one side or the other; later starts are the nearest larger positions.
    """
    if unit == WORD:
        text, starts, length = text.view(U), starts // WORD, length // WORD
    word, levels = prefix_ranks(text, length)
    order = np.argsort(levels[-1][1][starts], kind="stable")
    found = []
    for place in (order, -order):
        size, source = np.zeros(len(order), np.int64), np.full(len(order), -1, np.int64)
        for near in (nearest_smaller(place), len(order) - 1 - nearest_smaller(place[::-1])[::-1]):
            has = np.flatnonzero((near >= 0) & (near < len(order)))
            own, other = order[has], order[near[has]]
            common = common_prefix(word, levels, starts[own], starts[other])
            longer = common > size[own]
            size[own[longer]], source[own[longer]] = common[longer], starts[other[longer]]
        found.append((size * unit, np.where(source < 0, source, source * unit)))
    return found[0], found[1]


def ranges(flags: np.ndarray, length: int, unit: int = BYTES) -> list[dict]:
    """Byte ranges covered by the flagged starts (one for each unit) of one context."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"a": int(a) * unit, "b": (int(b) - 1) * unit + length}
            for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


RANGE = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
FOUND = T.StructType([T.StructField("hash", T.LongType()), T.StructField("context", T.LongType()),
                      T.StructField("earlier", RANGE), T.StructField("elsewhere", RANGE)])


def context_texts(docs: DataFrame, wanted: DataFrame, unit: int = BYTES) -> DataFrame:
    """``wanted`` (hash, context, left, right, n, first) with the bytes of each context."""
    lists = wanted.groupBy(F.col("first.text_key").alias("text_key")).agg(
        F.collect_list(F.struct("hash", "context", "left", "right", F.col("first.doc_id").alias("doc_id"),
                                F.col("first.lo").alias("lo"))).alias("wanted"))
    texts = maybe_in(docs.select("text_key", "text"), "text_key", key_sketch(lists, "text_key"))
    fields = ["hash", "context", "left", "right", "doc_id", "lo"]

    def batch_of(rows: list[list], keys: list[int], parts: list[bytes]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[] for _ in fields]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols], pa.array(keys, pa.int64()),
                                           pa.array(parts, pa.binary())], names=[*fields, "text_key", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            rows, keys, parts, held = [], [], [], 0
            for key, text, want in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if key in seen:  # equal texts: one of them gives the contexts
                    continue
                seen.add(key)
                data = one_coded(text.as_buffer().to_pybytes(), unit)
                for w in want.as_py():
                    rows.append([w[f] for f in fields])
                    keys.append(key)
                    parts.append(data[w["lo"]:w["lo"] + w["left"] + w["right"]])
                    held += len(parts[-1])
                if held > CONTEXT_BYTES:
                    yield batch_of(rows, keys, parts)
                    rows, keys, parts, held = [], [], [], 0
            yield batch_of(rows, keys, parts)
            give_back()

    return (texts.join(lists, "text_key").select("text_key", "text", "wanted")
            .mapInArrow(run, ", ".join(f"{f} long" for f in fields) + ", text_key long, bytes binary"))


def sorted_factors(contexts: DataFrame, shards: int, length: int, unit: int = BYTES) -> DataFrame:
    """``FOUND`` rows: per context the ranges that occur earlier, and those that occur elsewhere."""

    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["bytes"].map(len).to_numpy()
        base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        starts_of = [np.arange(b, b + s - length + 1, unit) for b, s in zip(base, sizes)]
        text = np.frombuffer(b"".join(pdf["bytes"]), np.uint8)
        (previous, _), (following, _) = factors(text, np.concatenate(starts_of), length, unit)
        before, after = previous >= length, following >= length
        cut = np.cumsum([len(x) for x in starts_of])[:-1]
        return pd.DataFrame({"hash": pdf["hash"].to_numpy(), "context": pdf["context"].to_numpy(),
                             "earlier": [ranges(x, length, unit) for x in np.split(before, cut)],
                             "elsewhere": [ranges(x, length, unit) for x in np.split(before | after, cut)]})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = (pdf.drop_duplicates(["hash", "context"])
               .sort_values(["hash", "doc_id", "text_key", "lo"], na_position="first", kind="stable"))
        # equal strings have one anchor, so whole anchors are sorted apart: the ranks of every byte are what is held
        before = pdf["bytes"].map(len).cumsum().shift(fill_value=0)
        found = [some(part) for _, part in pdf.groupby(before.groupby(pdf["hash"]).transform("min") // SORT_BYTES)]
        give_back()
        return pd.concat(found, ignore_index=True)

    return contexts.groupBy(F.pmod(F.xxhash64("hash"), F.lit(shards))).applyInPandas(run, FOUND)


def counted_factors(contexts: DataFrame, length: int, unit: int = BYTES) -> DataFrame:
    """The same for anchors with very many classes: every string is a row, grouped by its hash."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = {k: b.column(i)[r].as_py() for i, k in enumerate(b.schema.names)}
                units, size = symbols(np.frombuffer(row["bytes"], np.uint8), unit), length // unit
                power, inverse = _powers(len(units) + 1)
                total = np.concatenate([np.zeros(1, U), np.cumsum(units * power[:len(units)])])
                key = mix((total[size:] - total[:-size]) * inverse[:len(units) - size + 1])
                n = len(key)
                fill = lambda k: pa.array([row[k]] * n, pa.int64())
                yield pa.RecordBatch.from_arrays([fill("hash"), fill("context"), fill("doc_id"), fill("text_key"), fill("lo"),
                                                  pa.array(np.arange(n)), pa.array(key.astype(np.int64))],
                                                 names=["hash", "context", "doc_id", "text_key", "lo", "s", "key"])

    rows = contexts.dropDuplicates(["hash", "context"]).select("hash", "context", "doc_id", "text_key", "lo", "bytes").mapInArrow(
        strings, "hash long, context long, doc_id long, text_key long, lo long, s long, key long")
    rows = stage(rows, "strings")
    place = F.struct("doc_id", "text_key", "lo")
    twice = rows.groupBy("hash", "key").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = rows.join(twice, ["hash", "key"]).groupBy("hash", "context").agg(
        F.collect_list(F.when(place > F.col("least"), F.col("s"))).alias("e"), F.collect_list("s").alias("o"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in (2, 3):
                col = []
                for x in b.column(i).to_pylist():
                    flags = np.zeros(max(x, default=-1) + 1, bool)
                    flags[x] = True
                    col.append(ranges(flags, length, unit))
                out.append(pa.array(col, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *out], names=FOUND.names)

    return found.select("hash", "context", "e", "o").mapInArrow(run, FOUND)


def repeated_spans(docs: DataFrame, keep_first: bool, length: int = LENGTH, gram: int = GRAM,
                   shard_contexts: int = SHARD_CONTEXTS, unit: int = BYTES) -> DataFrame:
    """``(text_key, doc_id, spans)``: byte ranges (of the coded text) to remove, not yet merged; ``doc_id`` is null
    throughout without ``keep_first``, where equal texts lose the same bytes."""
    who = F.col("doc_id") if keep_first else F.lit(None)
    found = stage(anchors(docs.select("text_key", who.cast("long").alias("doc_id"), "text"), length, gram, unit), "anchors")
    place = F.struct("doc_id", "text_key", "lo")
    classes = stage(found.groupBy("hash", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min("left").alias("left"), F.min("right").alias("right"), F.min(place).alias("first")), "classes")
    groups = classes.groupBy("hash").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes")).filter("total > 1")
    groups = stage(groups, "groups")
    some = maybe_in(classes, "hash", key_sketch(groups, "hash")).join(groups, "hash")
    some = stage(some, "repeated")
    unlike = some.filter("classes > 1")
    contexts = stage(context_texts(docs, unlike, unit).join(unlike.select("hash", "context", "classes"), ["hash", "context"]), "contexts")
    most = shard_contexts * unit
    usual = contexts.filter(F.col("classes") <= most).drop("classes")
    shards = max(1, -(-unlike.count() // shard_contexts))
    factors_found = sorted_factors(usual, shards, length, unit)
    crowded = contexts.filter(F.col("classes") > most).drop("classes")
    if unlike.filter(F.col("classes") > most).limit(1).count():
        factors_found = factors_found.unionByName(counted_factors(crowded, length, unit))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.col("left") + F.col("right")).alias("b")))
    none = F.array().cast(RANGE)
    judged = some.join(stage(factors_found, "factors"), ["hash", "context"], "left")
    if keep_first:
        first = F.coalesce("earlier", none)
    else:
        first = F.when(F.col("n") > 1, whole).otherwise(F.coalesce("elsewhere", none))
    judged = judged.select("hash", "context", F.col("first").alias("_first"), first.alias("_own"), whole.alias("_whole"))
    judged = stage(judged.filter((F.size("_own") > 0) | F.lit(keep_first)), "judged")
    hits = maybe_in(found, "hash", key_sketch(judged, "hash")).join(judged, ["hash", "context"])
    cut = F.when(place == F.col("_first"), F.col("_own")).otherwise(F.col("_whole")) if keep_first else F.col("_own")
    return (hits.select("text_key", "doc_id", "lo", F.inline(cut))
            .groupBy("text_key", "doc_id").agg(F.collect_set(F.struct(
                (F.col("lo") + F.col("a")).alias("start"), (F.col("lo") + F.col("b")).alias("end"))).alias("spans")))


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def cut_repeats(docs: DataFrame, keep_first: bool = True, length: int = LENGTH, whole_chars: bool = False,
                gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS, unit: int = BYTES,
                beside: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``spans`` (maximal removed byte ranges) and ``kept_bytes`` (what is left).

    ``whole_chars`` leaves a character standing that a range covers only in part; so does a word with
    ``unit=WORD``, where ``length`` and ``gram`` are eight bytes for each word.  ``beside`` (text_key
    and more columns, one row for a text, only without ``keep_first``) goes to the documents with the
    spans; other documents have nulls there.
    """
    more = [c for c in beside.columns if c != "text_key"] if beside is not None else []
    docs = docs.drop("spans", "kept_bytes", *more).withColumn("text_key", F.xxhash64("text"))
    spans = repeated_spans(docs, keep_first, length, gram, shard_contexts, unit)
    spans = stage(spans.join(beside, "text_key", "full") if more else spans, "spans")
    sketch = key_sketch(spans, "text_key")
    plain = maybe_in(docs, "text_key", sketch, negate=True)
    other = spans.select(F.col("text_key").alias("_key"), F.col("doc_id").alias("_doc"), F.col("spans").alias("_spans"), *more)
    match = F.col("text_key") == F.col("_key")
    if keep_first:
        match = match & F.col("doc_id").cast("long").eqNullSafe(F.col("_doc"))
    joined = maybe_in(docs, "text_key", sketch).join(other, match, "left").drop("_key", "_doc")
    at = joined.columns.index("text")
    out = T.StructType([f for f in joined.schema.fields if f.name != "_spans"]
                       + [T.StructField("spans", SPANS), T.StructField("kept_bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            merged, kept = [], []
            for text, found in zip(b.column(at), b.column(b.schema.get_field_index("_spans")).to_pylist()):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                runs: list[list[int]] = []
                for s in sorted((x["start"], x["end"]) for x in found or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                if unit == WORD:
                    runs = _words_between(data, runs)
                elif whole_chars:
                    runs = [r for r in (_inner(data, *r) for r in runs) if r[0] < r[1]]
                merged.append([{"start": s, "end": e} for s, e in runs])
                edges = [0, *[x for r in runs for x in r], len(data)]
                kept.append(b"".join([data[s:e] for s, e in zip(edges[::2], edges[1::2])]))
            cols = [c for c, n in zip(b.columns, b.schema.names) if n != "_spans"]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(merged, kind), pa.array(kept, pa.binary())], names=out.names)
            give_back()

    untouched = plain.withColumns({"spans": F.array().cast(SPANS), "kept_bytes": F.coalesce("text", F.lit("")).cast("binary")})
    return untouched.unionByName(joined.mapInArrow(run, out), allowMissingColumns=True).drop("text_key")


def _words_between(data: bytes, runs: list[list[int]]) -> list[list[int]]:
    """Byte ranges of the text for ranges of its coded form: from the first whole word to the last."""
    if not runs:
        return []
    words = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    ranges = [(-(-s // WORD), e // WORD) for s, e in runs]
    return [[int(words.start[a]), int(words.end[b - 1])] for a, b in ranges if a < b]


def _inner(data: bytes, start: int, end: int) -> list[int]:
    while start < end and start < len(data) and data[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return [start, end]


def repeated_words(docs: DataFrame, words: int = PASSAGE_WORDS) -> DataFrame:
    """``(text_key, n_repeated_words)`` of the texts that have any: words in a run of ``words`` words that
    also starts elsewhere, in the same text or another."""
    found = repeated_spans(docs.withColumn("text_key", F.xxhash64("text")), False, words * WORD, unit=WORD)
    zero = F.lit(0).cast("long")
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(zero.alias("end"), zero.alias("size")),
        lambda so_far, s: F.struct(F.greatest(so_far["end"], s["end"]).alias("end"),
                                   (so_far["size"] + F.greatest(zero, s["end"] - F.greatest(so_far["end"], s["start"]))).alias("size")),
        lambda so_far: (so_far["size"] / WORD).cast("long"))
    return found.select("text_key", covered.alias("n_repeated_words"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left without repeated strings of ``LENGTH`` bytes; beside it ``n_repeated_words``, which also
    tells of repeated passages of ``PASSAGE_WORDS`` words with fewer bytes, which the removal leaves."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = cut_repeats(docs, keep_first=False, beside=repeated_words(docs))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return cut.select("doc_id", n_bytes.alias("n_bytes"),
                      (n_bytes - F.octet_length("kept_bytes")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"),
                      F.coalesce("n_repeated_words", F.lit(0).cast("long")).alias("n_repeated_words"))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated passages of ``PASSAGE_WORDS`` words or more; one
    of which nothing is left goes."""
    cut = cut_repeats(carried(docs), keep_first=True, length=PASSAGE_WORDS * WORD, unit=WORD)
    changed = F.size("spans") > 0
    out = cut.withColumn("text", F.when(changed, F.col("kept_bytes").cast("string")).otherwise(F.col("text")))
    return restored(out.filter(~changed | (F.length(F.trim("text")) > 0)), docs.columns, changed)
