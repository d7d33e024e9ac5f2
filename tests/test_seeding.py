"""k-means|| with hashed draws: against plain Python, and under any partitioning."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairspark.operators import kmeans, objective, seeding

SCHEMA = "features array<double>, grp string, name string"


def uniform(seed, axis, key):
    return int(hashlib.md5(f"{seed}-{axis}-{key}".encode()).hexdigest()[:13], 16) / 2.0**52


def sq(a, b):
    return sum((x - y) * (x - y) for x, y in zip(a, b))


def brute_seeds(rows, k, seed=1, rounds=2, factor=2.0):
    pts = [(tuple(r[0]), r[2]) for r in rows]
    cands = [min((uniform(seed, "draw0", key), x) for x, key in pts)[1]]
    for r in range(1, 21):
        if r > rounds and len(cands) >= k:
            break
        d2 = [min(sq(x, c) for c in cands) for x, _ in pts]
        phi = sum(d2)
        if not phi > 0:
            break
        cands += sorted({x for (x, key), d in zip(pts, d2) if uniform(seed, f"draw{r}", key) < factor * k * d / phi} - set(cands))
    if len(cands) <= k:
        return cands
    weights = [0] * len(cands)
    for x, _ in pts:
        weights[min((sq(x, c), i) for i, c in enumerate(cands))[1]] += 1
    picked, d2 = [], [1.0] * len(cands)
    for i in range(k):
        mass = [w * d for w, d in zip(weights, d2)]
        if not sum(mass) > 0:
            break
        target, up_to = int(hashlib.md5(f"{seed}-pick{i}".encode()).hexdigest()[:13], 16) / 2.0**52 * sum(mass), 0.0
        for at, m in enumerate(mass):
            up_to += m
            if up_to > target:
                break
        picked.append(cands[at])
        new = [sq(c, cands[at]) for c in cands]
        d2 = new if i == 0 else [min(a, b) for a, b in zip(d2, new)]
    return picked


def cloud(n, seed, dim=2):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 6, (n, 1)) * 50 + rng.normal(size=(n, dim)).round(3)
    x[: n // 3] = x[0]  # a third of all rows is one point
    return [([float(v) for v in row], "A" if i % 3 else "B", ",".join(map(str, row))) for i, row in enumerate(x)]


@pytest.mark.parametrize("k,seed", [(1, 1), (4, 1), (6, 7), (40, 3)])
def test_seeds_equal_brute_force_under_any_partitioning(spark, k, seed):
    rows = cloud(300, seed)
    want = brute_seeds(rows, k, seed)
    df = spark.createDataFrame(rows, SCHEMA)
    for parts in (1, 3, 7):
        got = seeding.seed_centers(df.repartition(parts, F.rand(parts)), k, seed, key=F.col("name"))
        assert got == want
    assert len(want) == k and len(set(want)) == k


def test_default_draws_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(cloud(200, 2, dim=30), SCHEMA)
    first = kmeans.kmeans_centers(df.repartition(1), 5, 0)
    assert first == kmeans.kmeans_centers(df.repartition(6, F.rand(1)), 5, 0) and len(first) == 5


def test_fewer_points_than_centres(spark):
    rows = [([0.0, 0.0], "A", "p"), ([0.0, 0.0], "B", "p"), ([1.0, 1.0], "B", "q")]
    assert sorted(seeding.seed_centers(spark.createDataFrame(rows, SCHEMA), 5)) == [(0.0, 0.0), (1.0, 1.0)]
    assert seeding.seed_centers(spark.createDataFrame(rows[:2], SCHEMA), 2) == [(0.0, 0.0)]


def test_no_points_no_centres(spark):
    assert seeding.seed_centers(spark.createDataFrame([], SCHEMA), 3) == []
    assert kmeans.kmeans_centers(spark.createDataFrame([], SCHEMA), 3, 2) == []
    with pytest.raises(ValueError):
        seeding.seed_centers(spark.createDataFrame([], SCHEMA), 0)


def test_seeds_are_better_than_arbitrary_points(spark):
    df = spark.createDataFrame(cloud(600, 5), SCHEMA)
    cost = lambda cs: objective.standard_objective(df, cs).first()[0]
    arbitrary = [tuple(r[0]) for r in cloud(600, 5)[200:206]]
    assert cost(seeding.seed_centers(df, 6)) < cost(arbitrary)


def test_training_does_not_raise_the_cost(spark):
    df = spark.createDataFrame(cloud(300, 8), SCHEMA)
    cost = lambda cs: objective.standard_objective(df, cs).first()[0]
    assert cost(kmeans.kmeans_centers(df, 4, 10)) <= cost(kmeans.kmeans_centers(df, 4, 0)) + 1e-9


def test_wide_lloyd_step_is_the_mean_of_each_cell(spark):
    rows = cloud(200, 9, dim=30)
    centers = [rows[i][0] for i in (0, 90, 150)]
    got = kmeans.lloyd_step(spark.createDataFrame(rows, SCHEMA).repartition(4), centers)
    x = np.array([r[0] for r in rows])
    near = ((x[:, None] - np.array(centers)[None]) ** 2).sum(axis=2).argmin(axis=1)
    for c in range(3):
        np.testing.assert_allclose(got[c], x[near == c].mean(axis=0), rtol=1e-12)
