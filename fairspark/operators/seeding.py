"""Reproducible starting centres: k-means|| with hashed draws.

1. The first candidate is the point with the least draw.
2. In each round a point becomes a candidate when its draw of that round is below
   ``factor * k * d2 / phi``, where ``d2`` is its squared distance to the nearest candidate so far and
   ``phi`` the sum over all points (Bahmani et al., "Scalable k-means++", 2012).
3. Every candidate is weighted by the points nearest to it.
4. The ``k`` centres are picked among the candidates one by one: each with a chance in proportion to
   its weight times its squared distance to the centres picked before.

A draw is a hash of (seed, round, point), so the centres do not depend on partitioning, order or the
retry of a task; equal points share their draws and are one candidate.  The points are persisted
meanwhile.  A round is two passes over them (``phi``, then the draw) and brings about ``factor * k`` distinct candidates to the
driver; weights come back as one row per candidate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import Centers, batch_nearest, feature_matrix
from ..sources.points import persist_points
from ..sources.synth import TWO_POW_52, hash_uniform

# fixed values: rounds and oversampling factor of the usual k-means|| start
ROUNDS = 2
FACTOR = 2.0
#: Rounds at most, where the usual ones gave fewer candidates than centres asked for.
MOST_ROUNDS = 20


def driver_uniform(seed: int, axis: str) -> float:
    """The uniform of ``hash_uniform`` for text without a point."""
    return int(hashlib.md5(f"{seed}-{axis}".encode()).hexdigest()[:13], 16) / TWO_POW_52


def _distances(rows: np.ndarray, center: np.ndarray) -> np.ndarray:
    d = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        d += (rows[:, j] - center[j]) * (rows[:, j] - center[j])
    return d


def pick_weighted(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> list[int]:
    """Positions of up to ``k`` candidates, drawn one by one by weight times squared distance to those
    drawn before (the first by weight alone); fewer where all others lie on drawn ones."""
    picked: list[int] = []
    d2 = np.ones(len(candidates))
    for i in range(min(k, len(candidates))):
        up_to = np.cumsum(weights * d2)
        if not up_to[-1] > 0:
            break
        at = int(np.searchsorted(up_to, driver_uniform(seed, f"pick{i}") * up_to[-1], side="right"))
        picked.append(at)
        new = _distances(candidates, candidates[at])
        d2 = new if i == 0 else np.minimum(d2, new)
    return picked


def keyed_points(points: DataFrame, key: Column | None = None) -> DataFrame:
    """``(features, _key)``: points and the text that stands for each in its draws."""
    name = key if key is not None else F.xxhash64("features").cast("string")
    return points.select("features", name.alias("_key"))


def with_nearest(points: DataFrame, centers: Centers) -> DataFrame:
    """Points (features first) plus ``d2`` (squared distance to) and ``cid`` (index of) the nearest centre."""
    cs = np.array(centers, dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d2, cid = batch_nearest(feature_matrix(b.column(0), cs.shape[1]), cs)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d2), pa.array(cid.astype(np.int32))],
                                                 names=[*b.schema.names, "d2", "cid"])

    return points.mapInArrow(run, T.StructType([*points.schema.fields, T.StructField("d2", T.DoubleType()),
                                                T.StructField("cid", T.IntegerType())]))


def seed_candidates(points: DataFrame, k: int, seed: int = 1, rounds: int = ROUNDS, factor: float = FACTOR,
                    key: Column | None = None) -> list[tuple[float, ...]]:
    """Distinct candidate points in the order they were drawn (within a round by coordinates).

    ``key`` is the text that stands for a point in its draws (default: a hash of the coordinates).
    More than ``rounds`` rounds are made while there are fewer than ``k`` candidates and other points.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    pts = keyed_points(points, key)

    def draw(r: int) -> Column:
        return hash_uniform(seed, f"draw{r}", F.col("_key"))

    first = pts.agg(F.min(F.struct(draw(0).alias("u"), "features")).alias("m")).first()["m"]
    if first is None:
        return []
    candidates = [tuple(first["features"])]
    for r in range(1, MOST_ROUNDS + 1):
        if r > rounds and len(candidates) >= k:
            break
        near = with_nearest(pts, candidates)
        phi = near.agg(F.sum("d2")).first()[0]
        if not phi > 0:  # every point is a candidate
            break
        drawn = near.filter(draw(r) < F.lit(factor * k) * F.col("d2") / F.lit(phi))
        new = [tuple(row["features"]) for row in drawn.select("features").distinct().collect()]  # about factor * k
        candidates += sorted(set(new) - set(candidates))
    return candidates


def seed_centers(points: DataFrame, k: int, seed: int = 1, rounds: int = ROUNDS, factor: float = FACTOR,
                 key: Column | None = None) -> list[tuple[float, ...]]:
    """``k`` starting centres, or all distinct points where there are fewer."""
    pts = persist_points(keyed_points(points, key))
    try:
        candidates = seed_candidates(pts, k, seed, rounds, factor, F.col("_key"))
        if len(candidates) <= k:
            return candidates
        weights = np.zeros(len(candidates))
        cells = with_nearest(pts.select("features"), candidates).groupBy("cid").count()
        for r in cells.collect():  # one row per candidate
            weights[r["cid"]] = r["count"]
    finally:
        pts.unpersist()
    rows = np.array(candidates)
    return [candidates[i] for i in pick_weighted(rows, weights, k, seed)]
