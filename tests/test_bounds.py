"""Steps with carried bounds: the centres of the plain steps, and fewer distances."""

import numpy as np
import pytest

from fairspark.operators import fair, kmeans
from fairspark.operators.bounds import BoundedPoints
from fairspark.operators.kmeans import lloyd_step, one_group

SCHEMA = "features array<double>, grp string"


def blobs(spark, n=6000, k=12, dim=3, parts=1):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, dim)) + 6 * rng.integers(0, 4, size=(n, dim))
    rows = [([float(v) for v in r], "AB"[i % 3 == 0]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts).persist(), [tuple(r) for r in x[:k].tolist()]


def test_the_same_centres_from_fewer_distances(spark):
    pts, start = blobs(spark)
    bounded, cur, plain = BoundedPoints(one_group(pts)), start, start
    for _ in range(12):
        cur, plain = lloyd_step(pts, cur, bounded), lloyd_step(pts, plain)
        assert cur == plain  # one task: sums in one order, so to the last bit
    full = 6000 * len(start)
    # the first step measures everything once and each point's own centre again
    assert bounded.computed[0] == full + 6000
    assert max(bounded.computed[6:]) < 0.5 * full and sum(bounded.computed[6:]) < 0.4 * 6 * full
    assert max(bounded.searched[6:]) < 0.3 * 6000
    bounded.drop()


@pytest.mark.parametrize("refresh", [0.0, 0.2, 2.0])
def test_fair_steps_at_any_refresh(spark, refresh):
    pts, start = blobs(spark, n=2000, k=7, parts=4)
    bounded, cur = BoundedPoints(pts, refresh), start
    plain = fair.fair_lloyd(pts, init_centers=start, max_iter=5)
    for _ in range(5):
        cur = fair.fair_step(pts, cur, bounded=bounded)
    assert np.allclose(cur, plain, rtol=0, atol=1e-10)
    assert np.allclose(fair.fair_lloyd(pts, init_centers=start, max_iter=5, bounds=True), plain, rtol=0, atol=1e-10)
    bounded.drop()


def test_ties_nan_empty_centres_and_one_centre(spark):
    # points in the middle of two centres, equal centres, a far empty centre, rows that repeat
    rows = [([float(a), float(b)], "AB"[(a + b) % 2]) for a in range(-3, 4) for b in range(-3, 4)] * 2
    pts = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    for start in ([(-1.0, 0.0), (1.0, 0.0), (1.0, 0.0)], [(0.0, -1.0), (0.0, 1.0), (500.0, 0.0)], [(2.0, 2.0)]):
        assert kmeans.lloyd(pts, start, 4, tol=0.0, bounds=True) == kmeans.lloyd(pts, start, 4, tol=0.0)
        assert np.allclose(fair.fair_lloyd(pts, init_centers=start, max_iter=3, bounds=True),
                           fair.fair_lloyd(pts, init_centers=start, max_iter=3), rtol=0, atol=1e-12)
    one = BoundedPoints(pts)
    for c in ([(0.0, 0.0)], [(9.0, 9.0)]):
        one.moments(c)
    assert one.searched[1] == 0
    one.drop()
    odd = pts.union(spark.createDataFrame([([float("nan"), 0.0], "A")], SCHEMA)).coalesce(1)
    a, b = BoundedPoints(odd), lloyd_step(odd, [(-1.0, 0.0), (1.0, 0.0)])
    assert np.array_equal(lloyd_step(odd, [(-1.0, 0.0), (1.0, 0.0)], a), b, equal_nan=True)
    a.drop()
    none = BoundedPoints(pts.limit(0))
    assert none.moments([(0.0, 0.0)]) == [] and none.computed == [0]
    none.drop()
