"""Packing into fixed windows by minimum bin slack.

Each document's token ids (with an end id) are cut into whole windows and one rest.  The rests are
packed shard by shard: the longest rest left opens a window, and a subset-sum over the lengths left
finds the multiset that fills it best.  The sums reachable so far are the bits of one integer; a
length with ``c`` copies is or-ed in by doubling steps, and the sums before each length are kept, so
the counts are read back from the fullest reachable sum.  A window found this way is repeated for as
long as the counts allow.

Defined results: null text is empty and gives the end id alone; a document of any length is cut, so
nothing is dropped; equal rows are separate documents; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stage, table
from .textvec import chunks
from .tokens import tokenizer

WINDOW = 1024
#: Pieces that one task packs together; their number, not the tokens, is what it holds.
PIECES_PER_SHARD = 8_192


def subset_counts(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length bring the sum closest to ``room`` from below.

    Longer lengths are tried first, and the search ends as soon as the room can be filled exactly.
    """
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left:
            size = min(size, left)
            steps.append((length, size, reach))
            reach |= (reach << (length * size)) & full
            left -= size
            size *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter()
    for length, size, before in reversed(steps):
        if not before >> total & 1:
            total -= length * size
            chosen[length] += size
    return dict(chosen)


def minimum_slack(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each piece: the bins are numbered from 0 in the order they are filled."""
    order = np.argsort(-lengths, kind="stable")
    values, start, number = np.unique(-lengths[order], return_index=True, return_counts=True)
    at = {int(-v): int(s) for v, s in zip(values, start)}  # the next unused piece of each length
    left = {int(-v): int(n) for v, n in zip(values, number)}
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    filled = 0
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        chosen = Counter(subset_counts(rest, window - longest) if rest and longest < window else {})
        chosen[longest] += 1
        times = min(left[x] // n for x, n in chosen.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            rows = order[at[length]:at[length] + n * times].reshape(times, n)
            bins[rows] = filled + np.arange(times)[:, None]
            offsets[rows] = offset + length * np.arange(n)[None, :]
            offset += n * length
            at[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        filled += times
    return bins, offsets


PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, salt long"


def cut_documents(docs: DataFrame, path: str, end_id: int = 0, window: int = WINDOW,
                  digest: bool = False, caches: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, ids, salt)``: whole windows and one rest per document.

    ``ids`` are little-endian unsigned 32-bit ids; with ``digest`` a column ``ids_crc32`` (long)
    stands in their place, for callers that need no more of them.  ``caches``: most units and pieces
    that the tokenizer remembers, where not the usual ones.  ``salt`` numbers the documents of a task,
    so that rows equal in all else are dealt apart, however many they are.
    """
    schema = PIECES.replace("ids binary", "ids_crc32 long") if digest else PIECES
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, nth = tokenizer(path, *caches), 0
        for b in (part for batch in batches for part in chunks(batch, "text", 1 << 20, clear=False)):
            rows = ([], [], [], [], [], [])
            for doc, ids in zip(b.column(0).to_pylist(), tok.encode([x or "" for x in b.column(1).to_pylist()])):
                ids += end
                n, nth = len(ids) // 4, nth + 1
                for start in range(0, n, window):
                    part = ids[4 * start:4 * (start + window)]
                    for col, v in zip(rows, (doc, start, len(part) // 4, n, zlib.crc32(part) if digest else part, nth)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if k == 4 and not digest else pa.int64()) for k, c in enumerate(rows)],
                names=["doc_id", "start", "length", "doc_tokens", "ids_crc32" if digest else "ids", "salt"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pack_pieces(pieces: DataFrame, window: int = WINDOW,
                pieces_per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset`` in place of ``salt``.

    Only the pieces shorter than the window are dealt to shards; whole windows are sequences by
    themselves and stay where they are.  ``sequence_id`` is even for whole windows and odd, shard
    first, for packed ones.
    """
    whole = pieces.filter(F.col("length") >= window).withColumns({
        "sequence_id": F.monotonically_increasing_id() * 2, "offset": F.lit(0).cast("long")}).drop("salt")
    rests = pieces.filter(F.col("length") < window)
    shards = max(1, -(-rests.count() // pieces_per_shard))
    out = whole.schema
    names = [f.name for f in out.fields]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([c for c in ("length", "doc_id", "start", "ids_crc32") if c in pdf], kind="stable")
        bins, offsets = minimum_slack(pdf["length"].to_numpy(), window)
        pdf["sequence_id"] = (int(pdf["_shard"].iloc[0]) << 32 | bins) * 2 + 1
        pdf["offset"] = offsets
        return pdf[names]

    key = F.pmod(F.xxhash64("doc_id", "start", "doc_tokens", "salt"), F.lit(shards))
    packed = rests.withColumn("_shard", key).drop("salt").groupBy("_shard").applyInPandas(pack, out)
    return whole.unionByName(packed)


def padded_length(tokens: int, window: int = WINDOW) -> int:
    """Length of a sequence in the training batch: a power of two as it is, else the window."""
    return tokens if tokens & (tokens - 1) == 0 else window


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, ids, sequence_id, offset)`` for whole documents."""
    return pack_pieces(stage(cut_documents(docs, path, end_id, window), "pieces"), window)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(table(spark, sf_dir, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    pieces = cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), digest=True)
    return pack_pieces(stage(pieces, "pieces"))
