"""Lloyd steps that carry a distance bound per point, so most points skip the search for their centre.

A point is staged with its centre and a lower bound of its distance to every other one.  A step moves
the centres; the bound falls by the largest move of any other centre, summed over the steps since it
was set.  A point measures its own centre first (one distance, which the moments need anyway).  Is it
nearer than the bound, or than half the way from its centre to the next one, no other centre can be
as near, and the search is skipped; else all centres are measured, as in the plain step.  An allowance
far above the rounding keeps ties and near ties on the search, so every point gets the centre and the
distance of the plain form.

The moves are K numbers in the plan.  The staged rows are written anew (shared folder, the rows
before deleted) only after a step that searched more than ``refresh`` of the points; in other steps a
pass reads them and writes nothing.  A lost executor costs a staged read.

Defined results: a point or centre with a NaN is searched in every step, as in the plain form; with one
centre nothing is searched after the first step; no points give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row

from ..functions.geometry import UDF_BLOCK, Centers, batch_nearest, feature_matrix
from ..staging import Staged
from .moments import MOMENTS, MomentTable, is_group_b, merged

#: Share of the points that a step may search before their bounds are set anew.
REFRESH = 0.2
#: Allowance for rounding, relative to the distances and norms.
ROUNDING = 1e-9
STATE = "features array<double>, grp string, cid int, bound double, work long"


def own_distances(x: np.ndarray, centers: np.ndarray, cid: np.ndarray) -> np.ndarray:
    """Squared distances to one centre per row, added up in coordinate order as in the plain form."""
    d = np.zeros(len(x))
    for j in range(x.shape[1]):
        gap = x[:, j] - centers[cid, j]
        d += gap * gap
    return d


def two_nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre of each row and distance to the nearest of the others."""
    cid, second = np.empty(len(x), np.int64), np.empty(len(x))
    step = max(1, UDF_BLOCK // len(centers))
    for i in range(0, len(x), step):
        part = x[i:i + step]
        d = np.zeros((len(part), len(centers)))
        for j in range(x.shape[1]):
            gap = part[:, j:j + 1] - centers[None, :, j]
            d += gap * gap
        near = np.where(np.isnan(d), np.inf, d).argmin(axis=1)
        d[np.arange(len(part)), near] = np.inf
        cid[i:i + step], second[i:i + step] = near, np.sqrt(d.min(axis=1))  # a NaN distance proves nothing
    return cid, second


class StepBounds:
    """What a step knows beside the points: centres, how far the others moved, half the ways between them."""

    def __init__(self, centers: np.ndarray, moved: np.ndarray):
        self.centers, self.moved = centers, moved
        between = np.full((len(centers), len(centers)), np.inf)
        for i in range(len(centers)):
            gap = np.sqrt(((centers - centers[i]) ** 2).sum(axis=1))
            gap[i] = np.inf
            between[i] = gap
        self.half = between.min(axis=1) / 2  # NaN where a centre has one
        self.norm = float(np.sqrt((centers ** 2).sum(axis=1)).max())

    def slack(self, x: np.ndarray, far: np.ndarray) -> np.ndarray:
        return ROUNDING * (far + np.sqrt((x * x).sum(axis=1)) + self.norm)

    def search(self, x: np.ndarray, cid: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to the carried centres, and the rows that they do not prove nearest."""
        d2 = own_distances(x, self.centers, cid)
        r = np.sqrt(d2)
        proved = r + self.slack(x, r) < np.fmax(bound - self.moved[cid], self.half[cid])
        return d2, np.flatnonzero(~proved)


class BoundedPoints:
    """Points (features, grp) with carried bounds.  ``moments`` is one step's pass over them.

    ``computed`` lists the distances that each step computed, ``searched`` the points it searched.
    """

    def __init__(self, points: DataFrame, refresh: float = REFRESH):
        self.points, self.refresh = points.select("features", "grp"), refresh
        self.state: Staged | None = None
        self.centers: np.ndarray | None = None
        self.moved: np.ndarray | None = None
        self.computed: list[int] = []
        self.searched: list[int] = []
        self._stale = True

    def drop(self) -> None:
        if self.state is not None:
            self.state.drop()
            self.state = None

    def moments(self, centers: Centers) -> list[Row]:
        """The merged moment rows (at most 2 K) of the points at their nearest centres."""
        cs = np.array([[float(v) for v in c] for c in centers])
        if self.centers is not None:
            if self.centers.shape != cs.shape:
                raise ValueError("the centres of all steps need one shape")
            step = np.sqrt(((cs - self.centers) ** 2).sum(axis=1))
            self.moved = self.moved + np.array([np.delete(step, i).max(initial=0) for i in range(len(cs))])
        else:
            self.moved = np.zeros(len(cs))
        self.centers = cs
        fresh, own = self._stale, 1
        if fresh:
            own += self.state is not None  # a pass that sets bounds measures the carried centres too
            new = Staged(self._set(StepBounds(cs, self.moved)), "bounds")
            self.drop()
            self.state, self.moved = new, np.zeros(len(cs))
        rows = merged(self._rows(StepBounds(cs, self.moved), fresh), dim=cs.shape[1]).collect()
        work = next((r["n"] for r in rows if r["cid"] == -1), 0)
        rows = [r for r in rows if r["cid"] >= 0]
        points = sum(r["n"] for r in rows)
        self.computed.append(work)
        self.searched.append((work - own * points) // len(cs))
        self._stale = self.searched[-1] > self.refresh * points
        return rows

    def _set(self, step: StepBounds) -> DataFrame:
        """The points with their centres and bounds; those that a bound still proves are not searched."""
        k, dim = step.centers.shape
        first = self.state is None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = feature_matrix(b.column(0), dim)
                cid, bound, rest = np.zeros(len(x), np.int64), np.zeros(len(x)), np.arange(len(x))
                work = np.zeros(len(x), np.int64)
                if not first:
                    cid, bound = b.column(2).to_numpy().astype(np.int64), b.column(3).to_numpy().copy()
                    _, rest = step.search(x, cid, bound)
                    bound -= step.moved[cid]
                    work += 1
                cid[rest], far = two_nearest(x[rest], step.centers)
                bound[rest] = far - step.slack(x[rest], np.where(np.isinf(far), 0, far))
                work[rest] += k
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cid.astype(np.int32)), pa.array(bound), pa.array(work)],
                                                 names=["features", "grp", "cid", "bound", "work"])

        return (self.points if first else self.state.df).mapInArrow(run, STATE)

    def _rows(self, step: StepBounds, fresh: bool) -> DataFrame:
        """Moment rows, and as a row of centre -1 the number of distances computed."""
        k, dim = step.centers.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, work = MomentTable(step.centers), 0
            for b in batches:
                if not b.num_rows:
                    continue
                x = feature_matrix(b.column(0), dim)
                cid = b.column(2).to_numpy().astype(np.int64)
                d2, rest = step.search(x, cid, b.column(3).to_numpy())
                if len(rest):
                    d2[rest], cid[rest] = batch_nearest(x[rest], step.centers)
                work += len(x) + k * len(rest) + (int(b.column(4).to_numpy().sum()) if fresh else 0)
                table.add(x, is_group_b(b.column(1)), cid, d2)
            yield table.batch()
            if work:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1], pa.int32()), pa.array(["A"]), pa.array([work], pa.int64()),
                     pa.array([[0.0] * dim], pa.list_(pa.float64())), pa.array([0.0])], names=["cid", "grp", "n", "s1", "s2"])

        return self.state.df.mapInArrow(run, MOMENTS)
