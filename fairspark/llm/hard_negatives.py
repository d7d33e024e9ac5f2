"""Hard negatives by anchor-clustered shared lists.

Anchors are clustered by direction; the cluster directions are fitted on a bounded sample of them.
The inner product of a candidate with any anchor of a cluster is at most the product of their norms
and the cosine of (candidate's angle to the direction, less the widest angle of an anchor).  In each
block of candidates the list of a cluster is sorted once by that angular upper bound, and all
anchors of the cluster walk it together.  An anchor stops for certain where its norm times the
bound is below the least score that could still enter its result.  What an anchor must beat is
known before the walk from a bounded sample of candidates, so a block gives few rows.

Two walks: the nearest rows of the same label (positives), then, per positive, the best rows of
another label whose score lies in the positive's band.  Scores are inner products of whole numbers
and exact; the bounds only decide what is computed.  Anchors are sent in chunks of bounded size, one
pass over the candidates for each.

Defined results: rows with a null label, a null vector or a null or non-finite component take no
part; a shorter vector ends in zeros; a null id is no anchor and comes first among equal scores;
equal rows are separate rows, so an anchor's copy may be its positive, and a repeated anchor gives
its rows again; without a positive or a negative an anchor gives no row; an empty table gives none;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stage, table
from .vectors import unpack_rows, whole_vectors

POSITIVES, NEGATIVES = 5, 3
#: The band of a negative's score, in hundredths of the positive's.
BAND = (50, 95)
#: Anchors sent to all tasks at once, candidates of a block, and list entries walked at a time.
CHUNK_ANCHORS, BLOCK, STEP = 50_000, 32_768, 512
#: Sampled anchors that fit the directions, the most directions, and sampled candidates.
FIT_ANCHORS, DIRECTIONS, SAMPLE = 8_192, 64, 4_096
NO_ID = np.iinfo(np.int64).min
#: Products are exact in doubles below this; beyond it they are computed in integers.
EXACT = float(1 << 53)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two whole-number matrices, exact in 64-bit integers."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
    return v / np.where(norm > 0, norm, 1)[:, None], norm


def fit_directions(sample: np.ndarray, most: int = DIRECTIONS, rounds: int = 8) -> np.ndarray:
    """Unit directions of a sample of anchors by spherical k-means, started at evenly spaced rows."""
    x, _ = unit(sample)
    k = max(1, min(most, round(len(x) ** 0.5)))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        moved, size = unit(sums)
        c = np.where((size > 0)[:, None], moved, c)
    return c


def at_most(v: np.ndarray, label: np.ndarray, vec_id: np.ndarray, copies: int) -> np.ndarray:
    """Rows that can matter to any anchor: of rows equal in label and vector the ``copies`` smallest ids.

    More of them than an anchor takes in all are never among its first, whatever the anchor.
    """
    mixer = np.random.default_rng(7).integers(1, 2**62, v.shape[1]) | 1
    key = (v.astype(np.int64) * mixer).sum(axis=1) + label * 0x9E3779B9
    _, first, of = np.unique(key, return_index=True, return_inverse=True)
    like = (v == v[first[of]]).all(axis=1) & (label == label[first[of]])
    order = np.lexsort((vec_id, ~like, of))
    nth = np.arange(len(order)) - np.searchsorted(of[order], of[order])
    return np.sort(order[(nth < copies) | ~like[order]])


class Queries:
    """The best ``k`` scores between ``least`` and ``most`` for each (anchor, slot), found while walking.

    ``least`` rises to the ``k``-th score as soon as there are ``k``.
    """

    def __init__(self, k: int, least: np.ndarray, most: np.ndarray):
        self.k, self.shape = k, least.shape
        self.least, self.most = least.astype(np.float64).copy(), most
        self.query, self.item, self.score = (np.empty(0, np.int64) for _ in range(3))

    def needed(self, members: np.ndarray) -> np.ndarray:
        """The least score that can still enter, over the slots of each anchor."""
        return self.least[members].min(axis=1)

    def take(self, members: np.ndarray, scores: np.ndarray, allowed: np.ndarray, items: np.ndarray,
             order: tuple[np.ndarray, ...]) -> None:
        """``scores`` of ``members`` x ``items``; ``order``: what ranks equal scores, by item."""
        q, i, s = [self.query], [self.item], [self.score]
        for slot in range(self.shape[1]):
            ok = allowed & (scores >= self.least[members, slot, None]) & (scores <= self.most[members, slot, None])
            m, c = np.nonzero(ok)
            q.append(members[m] * self.shape[1] + slot)
            i.append(items[c])
            s.append(scores[m, c])
        if sum(map(len, q)) == len(self.query):
            return
        query, item, score = map(np.concatenate, (q, i, s))
        by = np.lexsort((*[x[item] for x in order[::-1]], -score, query))
        query = query[by]
        nth = np.arange(len(by)) - np.searchsorted(query, query)
        keep = by[nth < self.k]
        full = by[nth == self.k - 1]
        self.query, self.item, self.score = query[nth < self.k], item[keep], score[keep]
        flat = self.least.reshape(-1)
        flat[query[nth == self.k - 1]] = np.maximum(flat[query[nth == self.k - 1]], score[full])


def walk(block: dict[str, np.ndarray], anchors: dict[str, np.ndarray], same: bool, k: int) -> tuple[Queries, int]:
    """All anchors of a chunk against a block of candidates; returns the queries and products computed."""
    found, computed = Queries(k, anchors["least"], anchors["most"]), 0
    direction, norm = unit(block["v"])
    for c, centre in enumerate(anchors["directions"]):
        members = np.flatnonzero(anchors["cluster"] == c)
        if not len(members):
            continue
        angle = np.arccos(np.clip(direction @ centre, -1, 1))
        # the allowances are far above the rounding of angles and cosines
        bound = norm * (np.cos(np.maximum(0, angle - anchors["widest"][c] - 1e-6)) + 1e-9)
        order = np.argsort(-bound, kind="stable")
        for at in range(0, len(order), STEP):
            reach = anchors["norm"][members] * bound[order[at]]
            members = members[reach >= found.needed(members)]
            if not len(members):
                break
            items = order[at:at + STEP]
            scores = products(anchors["v"][members], block["v"][items])
            computed += scores.size
            like = anchors["label"][members, None] == block["label"][None, items]
            other = anchors["row"][members, None] != block["row"][None, items]
            found.take(members, scores, like & other if same else ~like, items, (block["vec_id"], block["row"]))
    return found, computed


FOUND = "anchor_row long, slot int, item_id long, item_row long, score long"


def walked(candidates: DataFrame, anchors: dict[str, np.ndarray], same: bool, k: int) -> DataFrame:
    """``FOUND``: what each block of the candidates (row, vec_id, label, v) holds for the chunk."""
    sent = candidates.sparkSession.sparkContext.broadcast(anchors)  # CHUNK_ANCHORS rows at most
    width = anchors["v"].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, waiting, size = sent.value, [], 0

        def results() -> pa.RecordBatch:
            block = read_rows(waiting, width)
            keep = at_most(block["v"], block["label"], block["vec_id"], k + 1)
            block = {name: x[keep] for name, x in block.items()}
            d = max(block["v"].shape[1], width)
            own = chunk if d == width else chunk | {"v": np.pad(chunk["v"], ((0, 0), (0, d - width))),
                                                    "directions": np.pad(chunk["directions"], ((0, 0), (0, d - width)))}
            found, _ = walk(block, own, same, k)
            slots = found.shape[1]
            ids = block["vec_id"][found.item]
            return pa.RecordBatch.from_arrays(
                [pa.array(chunk["row"][found.query // slots]), pa.array((found.query % slots).astype(np.int32)),
                 pa.array(ids, mask=ids == NO_ID), pa.array(block["row"][found.item]), pa.array(found.score)],
                names=[x.split()[0] for x in FOUND.split(", ")])

        for b in batches:
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                if waiting and size + part.num_rows > BLOCK:
                    yield results()
                    waiting, size = [], 0
                waiting.append(part)
                size += part.num_rows
        if size:
            yield results()

    return candidates.select("row", "vec_id", "label", "v").mapInArrow(run, FOUND)


def read_rows(batches: list[pa.RecordBatch], width: int = 0) -> dict[str, np.ndarray]:
    """``row, vec_id, label, v`` of Arrow batches as numpy; a null id is ``NO_ID``."""
    t = pa.Table.from_batches(batches).combine_chunks()
    num = {n: t[n].combine_chunks() if isinstance(t[n], pa.ChunkedArray) else t[n] for n in ("row", "vec_id", "label")}
    out = {n: x.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False) for n, x in num.items()}
    return out | {"v": unpack_rows(t["v"].combine_chunks(), "<i4", width)}


def with_least(anchors: DataFrame, sample: dict[str, np.ndarray], same: bool, k: int) -> DataFrame:
    """``anchors`` with ``least array<double>``: per slot the ``k``-th best score among the sampled
    candidates, or the slot's own lower end, so no better row is ever passed over.

    The slots of a walk for positives are the whole range; otherwise ``positives`` gives their bands.
    """
    sent = anchors.sparkSession.sparkContext.broadcast(sample)  # SAMPLE rows
    names = anchors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                rows = read_rows([b.select(["row", "vec_id", "label", "v"])], s["v"].shape[1])
                items = s["v"] if s["v"].shape[1] == rows["v"].shape[1] else np.pad(s["v"], ((0, 0), (0, rows["v"].shape[1] - s["v"].shape[1])))
                scores = products(rows["v"], items).astype(np.float64)
                like = rows["label"][:, None] == s["label"][None, :]
                ok = like & (rows["row"][:, None] != s["row"][None, :]) if same else ~like
                least, most = slot_ends(None if same else b.column(names.index("positives")), b.num_rows)
                for slot in range(least.shape[1]):
                    fits = ok & (scores >= least[:, slot, None]) & (scores <= most[:, slot, None])
                    if scores.shape[1] >= k:
                        best = np.partition(np.where(fits, scores, -np.inf), -k, axis=1)[:, -k]
                        least[:, slot] = np.maximum(least[:, slot], best)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(least), pa.list_(pa.float64()))], names=[*names, "least"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(run, f"{fields}, least array<double>")


def slot_ends(positives: pa.Array | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest score of each slot: one whole range, or the band of each positive's score."""
    if positives is None:
        return np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
    least, most = np.full((n, POSITIVES), np.inf), np.full((n, POSITIVES), -np.inf)
    for r, scores in enumerate(positives.to_pylist()):
        for slot, score in enumerate(scores):
            low, high = -(-BAND[0] * score // 100), BAND[1] * score // 100
            if low <= high:
                least[r, slot], most[r, slot] = low, high
    return least, most


def chunk_walks(candidates: DataFrame, anchors: DataFrame, directions: np.ndarray, same: bool, k: int, name: str) -> DataFrame:
    """The walks of all anchors, chunk by chunk, as one staged result."""
    chunks = max(1, -(-anchors.count() // CHUNK_ANCHORS))
    parts = []
    for c in range(chunks):
        rows = anchors.filter(F.pmod(F.xxhash64("row"), F.lit(chunks)) == c).toArrow()  # a chunk at a time
        if not rows.num_rows:
            continue
        a = read_rows(rows.to_batches(), directions.shape[1])
        width = a["v"].shape[1]
        a["directions"] = np.pad(directions, ((0, 0), (0, width - directions.shape[1])))
        u, a["norm"] = unit(a["v"])
        cosine = u @ a["directions"].T
        a["cluster"] = cosine.argmax(axis=1)
        angle = np.arccos(np.clip(cosine[np.arange(len(u)), a["cluster"]], -1, 1))
        a["widest"] = np.zeros(len(directions))
        np.maximum.at(a["widest"], a["cluster"], angle)
        a["least"] = np.array(rows["least"].to_pylist(), np.float64).reshape(len(u), -1)
        _, a["most"] = slot_ends(None if same else rows["positives"].combine_chunks(), len(u))
        parts.append(stage(walked(candidates, a, same, k), f"{name}-{c}"))
    return reduce(DataFrame.unionByName, parts) if parts else candidates.sparkSession.createDataFrame([], FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of every (anchor, slot), numbered from 1 in ``rank``."""
    order = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), F.asc_nulls_first("item_id"), "item_row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: str, vector: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` has ``vec_id``, ``label`` and ``vector``; ``is_anchor`` is a condition on them.
    """
    spark = rows.sparkSession
    keep = {"vec_id": F.col("vec_id"), "label": F.col("label")}
    vectors = whole_vectors(rows.filter(F.col("label").isNotNull()), vector, keep)
    candidates = stage(vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v"), "candidates")
    anchors = candidates.filter(is_anchor)
    n, n_anchors = candidates.count(), anchors.count()
    if not n_anchors:
        return spark.createDataFrame([], RESULT)

    def some(df: DataFrame, share: float, most: int) -> dict[str, np.ndarray]:
        got = (df.sample(share, seed=1).limit(2 * most) if share < 1 else df).toArrow()  # bounded
        return read_rows((got if got.num_rows else df.limit(most).toArrow()).to_batches())

    directions = fit_directions(some(anchors, FIT_ANCHORS / n_anchors, FIT_ANCHORS)["v"])
    sample = some(candidates, SAMPLE / n, SAMPLE)
    first = stage(with_least(anchors, sample, True, POSITIVES), "anchors")
    positives = stage(best_of(chunk_walks(candidates, first, directions, True, POSITIVES, "positives"), POSITIVES), "best-positives")
    scores = positives.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))  # five at most
    second = (anchors.join(scores.withColumnRenamed("anchor_row", "row"), "row")
              .select("row", "vec_id", "label", "v", F.col("p.score").alias("positives")))
    second = stage(with_least(second, sample, False, NEGATIVES), "anchors")
    negatives = best_of(chunk_walks(candidates, second, directions, False, NEGATIVES, "negatives"), NEGATIVES)
    pairs = positives.select("anchor_row", (F.col("rank") - 1).alias("slot"), F.col("item_id").alias("positive_id"),
                             F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return (negatives.join(pairs, ["anchor_row", "slot"]).join(ids, "anchor_row")
            .select("anchor_id", "positive_id", "rank", F.col("item_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), "vec_id % 50 = 0")


#: DuckDB text: all inner products of the anchors, without bounds.
ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES}),
n AS (
  SELECT p.a, p.b AS p, p.score AS ps, s.b AS n, s.score AS ns,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same
  WHERE {BAND[0]} * p.score <= 100 * s.score AND 100 * s.score <= {BAND[1]} * p.score)
SELECT a AS anchor_id, p AS positive_id, CAST(rank AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE rank <= {NEGATIVES}"""
