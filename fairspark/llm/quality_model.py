"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed once by Spark and stored.  The trees are fitted on a sample
of at most ``SAMPLE`` labelled rows (those with the smallest hashes), whose statistics are a few
megabytes at most whatever the corpus holds.  A fitted forest is flat arrays (feature, bin edge,
children, value), walked level by level for a whole batch at once.

Defined results: null and empty texts have zero statistics and a score like any other; a null id is
never held out nor learned from; repeated rows are scored one by one; without labels of both kinds
every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stage, table
from .textstats import base_stats, count_bytes, per_doc_distinct
from .textvec import Words, chunks, flat

#: Labelled rows that the trees are fitted on at most.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST = 80, 4, 64, 0.15, 20
#: A score from here on predicts label 1 (fixed value of the query).
CUT = 0.3

FEATURES = ["log_bytes", "log_words", "word_length", "symbol_share", "upper_share", "digit_share",
            "punctuation_share", "foreign_share", "bang_share", "bar_share", "at_share", "line_words",
            "dup_line_share", "repeat_share", "distinct_share", "longest_word", "short_word_share"]


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    words = Words(buf, off)
    s = base_stats(buf, off, words)
    n_docs = len(off) - 1
    size = np.diff(off)
    by, nw, nl = np.maximum(size, 1), np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
    doc, length = words.doc(), words.end - words.start
    longest = np.zeros(n_docs)
    np.maximum.at(longest, doc, length)
    share = lambda values: count_bytes(buf, off, values) / by
    short = np.concatenate([[0], np.cumsum(length <= 3)])
    cols = [np.log1p(size), np.log1p(s["n_words"]), s["word_chars"] / nw, s["n_symbols"] / by,
            share(range(65, 91)), share(range(48, 58)),
            share([x for x in range(33, 127) if not chr(x).isalnum()]), share(range(128, 256)),
            share(b"!"), share(b"|"), share(b"@"), s["n_words"] / nl, s["n_dup_lines"] / nl,
            s["n_repeat_words"] / nw, per_doc_distinct(words.hash, doc, n_docs) / nw, np.log1p(longest),
            (short[words.first[1:]] - short[words.first[:-1]]) / nw]
    return np.stack([np.asarray(c, np.float32) for c in cols], axis=1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, features binary)``: little-endian floats, one per feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                x = statistics(*flat(part.column(1))).astype("<f4")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in x], pa.binary())],
                                                 names=["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, features binary")


@dataclass
class Forest:
    """Flat trees: node i of tree t sends a row left if ``x[feature] <= edge``; a leaf is its own child."""

    feature: np.ndarray
    edge: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                go = x[rows, self.feature[t][node]] <= self.edge[t][node]
                node = np.where(go, self.left[t][node], self.right[t][node])
            total += self.value[t][node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Boosted trees for the log loss; splits are sought over histograms of at most ``BINS`` bins."""
    x = x.astype(np.float32)
    n_nodes = 2 ** (DEPTH + 1) - 1
    shape = (trees, n_nodes)
    f = Forest(np.zeros(shape, np.int64), np.zeros(shape, np.float32), np.tile(np.arange(n_nodes), (trees, 1)),
               np.tile(np.arange(n_nodes), (trees, 1)), np.zeros(shape), 0.0)
    rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    f.base = float(np.log(rate / (1 - rate)))
    if len(np.unique(y)) < 2:
        return Forest(*[a[:0] for a in (f.feature, f.edge, f.left, f.right, f.value)], f.base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), f.base)
    d = x.shape[1]
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        first, width = 0, 1
        for _ in range(DEPTH):
            key = ((node - first)[:, None] * d + np.arange(d)) * BINS + binned
            live = (node >= first)
            hist = [np.bincount(key[live].ravel(), np.repeat(w[live], d), width * d * BINS).reshape(width, d, BINS)
                    for w in (grad, hess, np.ones(len(y)))]
            g, h, n = (np.cumsum(a, axis=2) for a in hist)
            gt, ht, nt = (a[:, :, -1:] for a in (g, h, n))
            gain = g**2 / (h + 1) + (gt - g)**2 / (ht - h + 1) - gt**2 / (ht + 1)
            gain[(n < LEAST) | (nt - n < LEAST)] = 0
            for j, e in enumerate(edges):
                gain[:, j, len(e):] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            top = gain.reshape(width, -1).max(axis=1)
            for k in range(width):
                i = first + k
                if top[k] > 1e-6:
                    j, b = divmod(int(best[k]), BINS)
                    f.feature[t, i], f.edge[t, i] = j, edges[j][b]
                    f.left[t, i], f.right[t, i] = 2 * i + 1, 2 * i + 2
            go = binned[np.arange(len(y)), f.feature[t][node]] <= _bin(edges, f, t, node)
            node = np.where(go, f.left[t][node], f.right[t][node])
            first, width = 2 * first + 1, 2 * width
        gl, hl = np.bincount(node, grad, n_nodes), np.bincount(node, hess, n_nodes)
        f.value[t] = -RATE * gl / (hl + 1)
        margin += f.value[t][node]
    return f


def _bin(edges: list[np.ndarray], f: Forest, t: int, node: np.ndarray) -> np.ndarray:
    at = np.array([np.searchsorted(edges[j], e, side="left") for j, e in zip(f.feature[t], f.edge[t])])
    return at[node]


def unpack(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f4").reshape(len(column), len(FEATURES))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit on at most ``sample`` labelled rows that are not held out."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), "quality")
    # a threshold on the hash leaves few more than the sample, so no task sorts or sends more
    places = 1 << 20
    share = min(places, -(-places * 3 * sample // (2 * max(1, known.count()))))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(places)) < share)
    rows = (stats.join(drawn, "doc_id").select("features", "quality", "doc_id")
            .orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(places)), "doc_id", "quality").limit(sample).collect())
    if not rows:
        return fit(np.empty((0, len(FEATURES))), np.empty(0))
    return fit(unpack([bytes(r["features"]) for r in rows]), np.array([r["quality"] for r in rows], float))


def score_documents(stats: DataFrame, forest: Forest) -> DataFrame:
    """``(doc_id, score)`` for rows of ``document_statistics``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = forest.score(unpack(b.column(1).to_pylist())) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], names=["doc_id", "score"])

    return stats.select("doc_id", "features").mapInArrow(run, "doc_id long, score double")


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stage(document_statistics(table(spark, sf_dir, "documents")), "statistics")
    forest = train(stats, table(spark, sf_dir, "labels"))
    return score_documents(stats, forest).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
