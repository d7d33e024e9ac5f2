"""Mergeable moments of (model, centre, group): one pass, few rows a task.

A moment row holds, for the points of one group at one centre, their number ``n``, the sum of their
differences from the centre (``s1``, one value per coordinate) and the sum of their squared distances
to it (``s2``).  Rows of the same centre add up, so they merge in any order and any number.  With a
centre c: the points' sum is ``n c + s1`` and their squared deviation from their own mean is
``s2 - |s1|^2 / n``.  Points lie near their centre, so little is lost in that difference.

``moment_rows`` assigns a batch of points and adds it up in one vectorised step, so a point never
leaves Python as a row: a task gives at most 2 K rows (one model).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Centers, batch_nearest, feature_matrix
from ..sources.points import GROUP_A, GROUP_B

MOMENTS = "cid int, grp string, n long, s1 array<double>, s2 double"


class MomentTable:
    """Moments of K centres and two groups, added up batch by batch."""

    def __init__(self, centers: np.ndarray):
        k, dim = centers.shape
        self.centers = centers
        self.n = np.zeros(2 * k, np.int64)
        self.s1 = np.zeros((2 * k, dim))
        self.s2 = np.zeros(2 * k)

    def add(self, x: np.ndarray, is_b: np.ndarray, cid: np.ndarray, d2: np.ndarray) -> None:
        slot = 2 * cid + is_b
        self.n += np.bincount(slot, minlength=len(self.n))
        self.s2 += np.bincount(slot, weights=d2, minlength=len(self.n))
        for j in range(x.shape[1]):
            gap = x[:, j] - self.centers[cid, j]
            self.s1[:, j] += np.bincount(slot, weights=gap, minlength=len(self.n))

    def batch(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.n)
        return pa.RecordBatch.from_arrays(
            [pa.array((some // 2).astype(np.int32)), pa.array([GROUP_B if s % 2 else GROUP_A for s in some], pa.string()),
             pa.array(self.n[some]), pa.array(list(self.s1[some]), pa.list_(pa.float64())), pa.array(self.s2[some])],
            names=["cid", "grp", "n", "s1", "s2"])


def moment_rows(points: DataFrame, centers: Centers) -> DataFrame:
    """``(cid, grp, n, s1, s2)`` of each task's points (features, grp) at their nearest centres."""
    cs = np.asarray(centers, np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = MomentTable(cs)
        for b in batches:
            if b.num_rows:
                x = feature_matrix(b.column(0), cs.shape[1])
                d2, cid = batch_nearest(x, cs)
                table.add(x, is_group_b(b.column(1)), cid, d2)
        yield table.batch()

    return points.select("features", "grp").mapInArrow(run, MOMENTS)


def is_group_b(col: pa.Array) -> np.ndarray:
    """0 for group A, 1 for group B."""
    codes = col.dictionary_encode()
    which = np.array([g == GROUP_B for g in codes.dictionary.to_pylist()], np.int64)
    return which[codes.indices.to_numpy(zero_copy_only=False)]


#: Up to this many coordinates the sums are columns of one aggregation.
WIDE_DIM_LIMIT = 24


def merged(rows: DataFrame, by: tuple[str, ...] = (), dim: int | None = None) -> DataFrame:
    """One moment row per (*by, cid, grp).

    The rows are few (2 K a task and model).  With ``dim`` of at most ``WIDE_DIM_LIMIT`` each coordinate
    is a column; else it becomes a row before the sum, so the plan does not grow with the dimension.
    """
    keys = [*by, "cid", "grp"]
    if dim is not None and dim <= WIDE_DIM_LIMIT:
        wide = rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("s2").alias("s2"),
                                       *[F.sum(F.col("s1")[j]).alias(f"_s{j}") for j in range(dim)])
        return wide.select(*keys, "n", F.array(*[F.col(f"_s{j}") for j in range(dim)]).alias("s1"), "s2")
    per_coord = rows.select(*keys, "n", "s2", F.posexplode("s1").alias("j", "v")).groupBy(*keys, "j").agg(
        F.sum("v").alias("v"), F.sum("n").alias("n"), F.sum("s2").alias("s2"))
    return per_coord.groupBy(*keys).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("j", "v"))).alias("_jv"), F.max("s2").alias("s2")).select(
        *keys, "n", F.col("_jv.v").alias("s1"), "s2")


def center_group_stats(points: DataFrame, centers: Centers) -> DataFrame:
    """``(cid, grp, n, sums array<double>, cost)`` at the nearest of ``centers``: the columns of
    ``fair.cluster_group_stats`` without a row per coordinate of every point."""
    cs = [[float(v) for v in c] for c in centers]
    all_centers = F.array(*[F.array(*[F.lit(v) for v in c]) for c in cs])
    own = F.element_at(all_centers, F.col("cid") + 1)
    rows = merged(moment_rows(points, centers), dim=len(cs[0])).withColumn("_c", own)
    return rows.select("cid", "grp", "n", F.expr("zip_with(s1, _c, (s, c) -> s + n * c)").alias("sums"),
                       F.expr("s2 - aggregate(s1, 0D, (acc, s) -> acc + s * s) / n").alias("cost"))
