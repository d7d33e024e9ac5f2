"""Quality rules: base rules and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte 4-grams are counted over whole tables: one over the documents
that the labels trust (quality 1), one over the raw corpus.  The number of buckets grows with the
square root of the corpus, so a large corpus keeps more grams apart.  A document's score is the sum of
``log p_trusted / p_raw`` over its 4-grams, divided by their number; documents under the threshold
go, and so do those that fail the base rules.  Every document is judged and no random choice made.

Defined results: null and empty texts have no words and fail the base rules; a text of under four
bytes scores 0; repeated rows are counted and judged one by one; labels of the same document count
it once for each row of the corpus; with no trusted text at all every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import carried, key_sketch, maybe_in, restored, table
from .textstats import base_stats, per_doc
from .textvec import chunks, flat

#: Bits of a hashed n-gram of a small corpus, and the most of any (2^24 buckets belong to some 70 TB of text).
BITS, MOST_BITS = 14, 30
NGRAM = 4
#: Log ratios are added up as whole multiples of one in so many.
SCALE = 1 << 24
#: A document stays if its mean log ratio is at least this.
THRESHOLD = -0.30
#: Trusted ids that are sent to every task (some 100 MB there); where there are more, texts are shuffled to meet them.
SENT_IDS = 2_000_000
#: fixed values of the base rules
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


def bits_for(size: int) -> int:
    """Bits of the buckets for so many bytes of corpus: twice the root of its size, as a power of two.

    A task sends, and the driver holds, at most 2^bits counts: 2^15 for 0.1 GB, 2^19 for 30 GB.
    """
    return min(MOST_BITS, max(BITS, (max(1, size).bit_length() + 1) // 2 + 1))


def buckets(buf: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bucket of the 4-gram that starts at each byte but the last three."""
    if len(buf) < NGRAM:
        return np.empty(0, np.int64)
    b = buf.astype(np.uint32)
    gram = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24
    gram = gram * np.uint32(0x9E3779B1)
    gram ^= gram >> np.uint32(15)
    return ((gram * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)).astype(np.int64)


def inside(off: np.ndarray, n: int) -> np.ndarray:
    """Whether the 4-gram at a place ends within the same text."""
    ok = np.ones(max(0, n), dtype=bool)
    for k in range(1, NGRAM):
        at = off[1:-1] - k
        ok[at[(at >= 0) & (at < n)]] = False
    return ok


def gram_counts(docs: DataFrame, bits: int, column: str = "text") -> DataFrame:
    """``(bucket, n)`` over all texts: each task sums its own, at most 2^bits rows, before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part in chunks(batch, column):
                buf, off = flat(part.column(0))
                g = buckets(buf, bits)
                total += np.bincount(g[inside(off, len(g))], minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return docs.select(column).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted_texts(docs: DataFrame, trusted: DataFrame, sent_ids: int | None = None) -> DataFrame:
    """``(doc_id, text)`` of the documents whose id is in ``trusted``; the texts stay where they are read
    unless there are more than ``sent_ids`` (``SENT_IDS``) ids."""
    texts, most = docs.select("doc_id", "text"), SENT_IDS if sent_ids is None else sent_ids
    if trusted.limit(most + 1).count() <= most:
        return texts.join(F.broadcast(trusted), "doc_id", "left_semi")
    return maybe_in(texts, "doc_id", key_sketch(trusted, "doc_id")).join(trusted, "doc_id", "left_semi")


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The table of log ratios (one for each bucket), with one added to every count."""
    bits = bits_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    trusted = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    target = trusted_texts(docs, trusted)
    p = []
    for counted in (gram_counts(target, bits), gram_counts(docs, bits)):
        n = np.ones(1 << bits)
        found = counted.toArrow()  # at most 2^bits rows
        n[found.column("bucket").to_numpy()] += found.column("n").to_numpy()
        p.append(n / n.sum())
    if p[0].max() == p[0].min():
        return np.zeros(1 << bits)
    return np.log(p[0] / p[1])


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge_quality(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the base counts, ``base_failed, score, kept``; columns of these names are replaced."""
    new = [*STATS, "base_failed", "score", "kept"]
    docs = docs.drop(*new)
    bits = len(ratios).bit_length() - 1
    whole = np.rint(ratios * SCALE).astype(np.int32)  # sums of whole numbers do not depend on the batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                buf, off = flat(part.column(part.schema.get_field_index("text")))
                stats = base_stats(buf, off)
                g = buckets(buf, bits)
                ok = inside(off, len(g))
                value = np.zeros(len(buf), np.int64)
                value[:len(g)] = np.where(ok, whole[g], 0)
                total = np.concatenate([[0], np.cumsum(value)])
                n = per_doc(np.concatenate([ok, np.zeros(len(buf) - len(g), bool)]), off)
                score = (total[off[1:]] - total[off[:-1]]) / SCALE / np.maximum(n, 1)
                words = stats["n_words"]
                failed = (words < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * words)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(stats[k], pa.int64()) for k in STATS], pa.array(failed),
                     pa.array(score), pa.array(~failed & (score >= threshold))], names=[*part.schema.names, *new])

    kinds = [*[T.LongType()] * 5, T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(k, t) for k, t in zip(new, kinds)]])
    return docs.mapInArrow(run, schema)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge_quality(docs, log_ratios(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *STATS, "base_failed", "kept", "score")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, with the columns they came with."""
    judged = judge_quality(carried(docs), log_ratios(docs, table(spark, sf_dir, "labels")))
    return restored(judged.filter("kept"), docs.columns)
