"""Standard k-means: a reproducible k-means|| start, Lloyd steps, and pyspark.ml training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Centers
from ..sources.points import GROUP_A, persist_points
from .bounds import BoundedPoints
from .moments import merged, moment_rows
from .seeding import seed_centers

# fixed values of the training call: init mode, seed and tolerance
INIT_MODE = "k-means||"
SEED = 1
TOL = 1e-4
#: The start of this library: the same centres whatever the partitioning.
HASHED = "hashed"


def kmeans_centers(points: DataFrame, k: int, max_iter: int, tol: float = TOL, seed: int = SEED,
                   init_mode: str = HASHED, key: Column | None = None,
                   starts: Centers | None = None) -> list[tuple[float, ...]]:
    """``k`` centres after at most ``max_iter`` Lloyd steps; ``max_iter=0`` gives the starting centres.

    ``init_mode='hashed'`` starts from ``seeding.seed_centers`` (``key`` goes there); ``'k-means||'`` and
    ``'random'`` train with ``pyspark.ml``, whose start depends on the partitioning.  There may be
    fewer than ``k`` centres when there are fewer distinct points.  ``starts``: the hashed starting
    centres of these points, where the caller has them already.
    """
    if init_mode != HASHED:
        return _trained(points, k, max_iter, tol, seed, init_mode)
    if starts is None:
        starts = seed_centers(points, k, seed, key=key)
    return lloyd(points, starts, max_iter, tol) if starts else []


def _trained(points: DataFrame, k: int, max_iter: int, tol: float, seed: int, init_mode: str) -> list[tuple[float, ...]]:
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    vecs = points.select(array_to_vector("features").alias("fv"))
    model = KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, initMode=init_mode,
                   featuresCol="fv").fit(vecs)
    return [tuple(float(v) for v in c) for c in model.clusterCenters()]


def _sqdist(a, b) -> float:
    s = 0.0
    for x, y in zip(a, b):
        s += (x - y) * (x - y)
    return s


def one_group(points: DataFrame) -> DataFrame:
    return points.select("features", F.lit(GROUP_A).alias("grp"))


def lloyd_step(points: DataFrame, centers: Centers, bounded: BoundedPoints | None = None) -> list[tuple[float, ...]]:
    """One Lloyd step: each centre moves to the mean of its points; an empty one stays."""
    out = [tuple(float(v) for v in c) for c in centers]
    # at most one row per centre and task leaves Python, whatever the dimension
    rows = bounded.moments(centers) if bounded else merged(
        moment_rows(one_group(points), centers), dim=len(centers[0])).collect()  # at most K rows
    total: dict[int, tuple[int, list[float]]] = {}
    for r in rows:  # bounded points may come in two groups
        n, sums = total.get(r["cid"], (0, [0.0] * len(r["s1"])))
        total[r["cid"]] = n + r["n"], [a + b for a, b in zip(sums, r["s1"])]
    for cid, (n, sums) in total.items():
        out[cid] = tuple(c + s / n for c, s in zip(out[cid], sums))
    return out


def lloyd(points: DataFrame, centers: Centers, max_iter: int, tol: float = TOL,
          bounds: bool = False) -> list[tuple[float, ...]]:
    """Lloyd iterations from given centres; stops early once no centre moves more than ``tol``.

    ``bounds`` stages the points with a distance bound each (``bounds.BoundedPoints``) in place of
    persisting them, which spares most distances of later steps; it pays for many centres and steps.
    """
    cur = [tuple(float(v) for v in c) for c in centers]
    bounded = BoundedPoints(one_group(points)) if bounds else None
    points = points if bounds else persist_points(points.select("features"))
    try:
        for _ in range(max_iter):
            new = lloyd_step(points, cur, bounded)
            done = all(_sqdist(a, b) <= tol * tol for a, b in zip(cur, new))
            cur = new
            if done:
                break
        return cur
    finally:
        if bounded is not None:
            bounded.drop()
        else:
            points.unpersist()
