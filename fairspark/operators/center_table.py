"""Nearest centre out of a table of centres, for more of them than literals carry.

Centres are read in blocks of bounded size.  In a block they are grouped around about sqrt(K) of
their own number (pivots).  For a point the distance to a pivot less the group's radius, and the gap
between the point's norm and the group's range of norms, are bounds below which no centre of the
group can come; a point searches the group of its nearest pivot first and then only groups whose
bounds do not exclude a nearer centre.  Distances are those of the plain form, added up in coordinate
order, and the lowest id wins ties.

The plan does not depend on the number of centres in a block; each further block is another pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import UDF_BLOCK, feature_matrix
from ..staging import BROADCAST_BYTES, Staged

#: Points that one numpy pass compares with all pivots.
ROWS = 4_096


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    d = np.zeros((len(x), len(centers)))
    for j in range(x.shape[1]):
        gap = x[:, j:j + 1] - centers[None, :, j]
        d += gap * gap
    return d


class CenterIndex:
    """Centres grouped around pivots, searched with bounds.  ``computed`` counts distances."""

    def __init__(self, cid: np.ndarray, centers: np.ndarray):
        whole = ~np.isnan(centers).any(axis=1)  # a NaN distance is never the nearest
        order = np.argsort(cid[whole], kind="stable")
        self.first = int(cid.min())
        self.cid, self.centers = cid[whole][order], np.ascontiguousarray(centers[whole][order])
        k = len(self.cid)
        some = np.unique(np.linspace(0, k - 1, max(1, round(k ** 0.5))).astype(int)) if k else np.empty(0, int)
        by_first = np.argsort(self.centers[:, 0], kind="stable") if k else some
        self.pivots = self.centers[by_first[some]] if k else self.centers
        of = np.concatenate([_squares(self.centers[i:i + ROWS], self.pivots).argmin(axis=1) for i in range(0, k, ROWS)]) if k else some
        self.groups = [np.flatnonzero(of == g) for g in range(len(self.pivots))]
        norm = np.sqrt((self.centers ** 2).sum(axis=1))
        far = [np.sqrt(_squares(self.centers[g], p[None]).max(initial=0)) for g, p in zip(self.groups, self.pivots)]
        self.radius = np.array(far)
        self.low = np.array([norm[g].min(initial=np.inf) for g in self.groups])
        self.high = np.array([norm[g].max(initial=-np.inf) for g in self.groups])
        self.computed = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance to, and id of, the nearest centre of each row; a row with a NaN gets the
        lowest id, as in the plain form."""
        parts = [self._nearest(x[i:i + ROWS]) for i in range(0, len(x), ROWS)]
        return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.empty(0), np.empty(0, np.int64))

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, at = np.full(len(x), np.inf), np.full(len(x), -1)
        if len(self.cid):
            to_pivot = np.sqrt(_squares(x, self.pivots))
            self.computed += to_pivot.size
            norm = np.sqrt((x * x).sum(axis=1))
            bound = np.maximum(to_pivot - self.radius, np.maximum(self.low - norm[:, None], norm[:, None] - self.high))
            # the allowance is far above the rounding of roots and sums
            bound -= 1e-9 * (to_pivot + self.radius + norm[:, None] + self.high)
            home = np.where(np.isnan(to_pivot), np.inf, to_pivot).argmin(axis=1)
            for g in np.unique(home):
                self._search(x, np.flatnonzero(home == g), g, best, at)
            for g in range(len(self.groups)):
                self._search(x, np.flatnonzero((bound[:, g] <= np.sqrt(best)) & (home != g)), g, best, at)
        lost = at < 0
        return np.where(lost, np.nan, best), np.where(lost, self.first, self.cid[np.maximum(at, 0)] if len(self.cid) else self.first)

    def _search(self, x: np.ndarray, rows: np.ndarray, group: int, best: np.ndarray, at: np.ndarray) -> None:
        members = self.groups[group]
        if not len(members):
            return
        for i in range(0, len(rows), max(1, UDF_BLOCK // len(members))):
            part = rows[i:i + max(1, UDF_BLOCK // len(members))]
            d = _squares(x[part], self.centers[members])
            self.computed += d.size
            d = np.where(np.isnan(d), np.inf, d)
            near = d.argmin(axis=1)  # members are in the order of their ids
            least, which = d[np.arange(len(part)), near], members[near]
            wins = (least < best[part]) | ((least == best[part]) & (which < at[part]) & np.isfinite(least))
            best[part[wins]], at[part[wins]] = least[wins], which[wins]


def _block_pass(points: DataFrame, centers: DataFrame, dim: int, names: list[str], chained: bool) -> DataFrame:
    rows = centers.select("cid", "center").toArrow()  # one block
    index = CenterIndex(rows["cid"].to_numpy().astype(np.int64), feature_matrix(rows["center"].combine_chunks(), dim).copy())
    sent = points.sparkSession.sparkContext.broadcast(index)
    at = points.columns.index("features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, cid = sent.value.nearest(feature_matrix(b.column(at), dim))
            cols = list(b.columns)
            if chained:
                old_cid, old_d = cols.pop().to_numpy().astype(np.int64), cols.pop().to_numpy()
                new = (d < old_d) | ((d == old_d) & (cid < old_cid)) | (np.isnan(old_d) & (~np.isnan(d) | (cid < old_cid)))
                d, cid = np.where(new, d, old_d), np.where(new, cid, old_cid)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(d), pa.array(cid.astype(np.int32))], names=[*names, "d2", "cid"])

    fields = ", ".join(f"`{n}` {points.schema[n].dataType.simpleString()}" for n in names)
    return points.mapInArrow(run, f"{fields}, d2 double, cid int")


def assign_from_table(points: DataFrame, centers: DataFrame, block_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``points`` plus ``d2`` and ``cid`` of the nearest row of ``centers`` (cid int, center array<double>).

    Up to ``block_bytes`` of centres are sent at once.  With more, the best so far of every point is
    staged after each block, so neither the plan nor what is sent grows with the centres.
    """
    names = points.columns
    size = centers.agg(F.count(F.lit(1)).alias("k"), F.min(F.size("center")).alias("low"), F.max(F.size("center")).alias("high")).first()
    if not size["k"]:
        raise ValueError("need at least one centre")
    if size["low"] != size["high"]:
        raise ValueError("all centres need the same number of coordinates")
    dim = size["high"]
    blocks = -(-size["k"] * 8 * (dim + 1) // block_bytes)
    if blocks <= 1:
        return _block_pass(points, centers, dim, names, False)
    out, last = points, None
    for i in range(blocks):
        part = centers.filter(F.pmod(F.xxhash64("cid"), F.lit(blocks)) == i)
        if part.isEmpty():
            continue
        new = Staged(_block_pass(out, part, dim, names, last is not None), "nearest")
        if last is not None:
            last.drop()
        out, last = new.df, new
    return out
