"""Many models as a table: against one fair Lloyd per model, with NULL keys, lacking groups and empty centres."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairspark.operators import fair, models, moments

POINTS = "seg string, features array<double>, grp string"
MODELS = "seg string, cid int, center array<double>"


def cloud(n, seed, segs, dim=2):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 4, (n, 1)) * 20 + rng.integers(0, 12, (n, dim)) / 2
    of = rng.integers(0, len(segs), n)
    of[: n // 3] = 0  # a third of all points belong to one model
    return [(segs[s], [float(v) for v in row], "A" if rng.random() < 0.4 else "B") for s, row in zip(of, x)]


def starts(segs, centers):
    return [(s, i, [float(v) for v in c]) for s in segs for i, c in enumerate(centers[s] if isinstance(centers, dict) else centers)]


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["seg"], {})[r["cid"]] = tuple(r["center"])
    return out


def alone(spark, rows, seg, centers, steps):
    pts = spark.createDataFrame([r for r in rows if r[0] == seg], POINTS)
    return fair.fair_lloyd(pts, init_centers=centers, max_iter=steps)


def close(got, want):
    assert len(got) == len(want)
    for i, c in enumerate(want):
        np.testing.assert_allclose(got[i], c, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("dim,dealt", [(2, 262_144), (2, 40), (30, 262_144)])
def test_models_equal_one_run_each(spark, dim, dealt, monkeypatch):
    monkeypatch.setattr(models, "DEALT_POINTS", dealt)
    segs = ["a", "b", None, "d"]
    rows = cloud(500, 1, segs, dim)
    centers = {"a": [[0.0] * dim, [30.0] * dim], "b": [[5.0] * dim, [25.0] * dim, [60.0] * dim],
               None: [[10.0] * dim, [50.0] * dim], "d": [[20.0] * dim]}
    got = collected(models.fair_lloyd_models(spark.createDataFrame(rows, POINTS).repartition(3),
                                             spark.createDataFrame(starts(segs, centers), MODELS), "seg", 3))
    for s in segs:
        close(got[s], alone(spark, rows, s, centers[s], 3))


@pytest.mark.parametrize("dealt", [262_144, 30])
def test_empty_centres_of_several_models_are_repaired(spark, dealt, monkeypatch):
    monkeypatch.setattr(models, "DEALT_POINTS", dealt)
    segs = ["a", "b", "c"]
    rows = cloud(300, 5, segs)
    rows += rows[:50]  # donors with copies
    centers = {"a": [(10.0, 10.0), (500.0, 500.0), (501.0, 501.0), (30.0, 30.0)], "b": [(10.0, 10.0), (60.0, 60.0)],
               "c": [(-400.0, -400.0), (20.0, 20.0), (-400.0, -400.0)]}
    got = collected(models.fair_lloyd_models(spark.createDataFrame(rows, POINTS).repartition(4),
                                             spark.createDataFrame(starts(segs, centers), MODELS), "seg", 2))
    for s in segs:
        close(got[s], alone(spark, rows, s, centers[s], 2))


def test_without_repair_an_empty_centre_stays(spark):
    rows = [("a", [0.0, 0.0], "A"), ("a", [1.0, 0.0], "B")]
    got = collected(models.fair_lloyd_models(spark.createDataFrame(rows, POINTS),
                                             spark.createDataFrame(starts(["a"], [(0.0, 0.0), (90.0, 90.0)]), MODELS), "seg", 1, repair=False))
    assert got["a"][1] == (90.0, 90.0)


def test_models_that_cannot_be_fair_or_have_no_points_keep_their_centres(spark):
    rows = cloud(60, 3, ["a"]) + [("only_a", [1.0, 1.0], "A"), ("two", [2.0, 2.0], "A"), ("two", [2.0, 2.0], "B")]
    segs = ["a", "only_a", "two", "nobody"]
    start = [(0.0, 0.0), (40.0, 40.0)]
    table = starts(segs, start) + [("two", 2, [70.0, 70.0])]
    got = collected(models.fair_lloyd_models(spark.createDataFrame(rows, POINTS), spark.createDataFrame(table, MODELS), "seg", 2))
    close(got["a"], alone(spark, rows, "a", start, 2))
    assert got["only_a"] == {0: (0.0, 0.0), 1: (40.0, 40.0)} and got["nobody"] == got["only_a"]
    # one of its two rows moves to the first empty centre; the other has to stay
    assert got["two"] == {0: (2.0, 2.0), 1: (2.0, 2.0), 2: (70.0, 70.0)}


def test_a_point_of_no_model_is_an_error(spark):
    pts = spark.createDataFrame([("x", [1.0, 1.0], "A")], POINTS)
    with pytest.raises(Exception, match="a point of no model"):
        models.fair_lloyd_models(pts, spark.createDataFrame(starts(["a"], [(0.0, 0.0)]), MODELS), "seg", 1).collect()


def test_no_models_and_no_points(spark):
    none = models.fair_lloyd_models(spark.createDataFrame([], POINTS), spark.createDataFrame([], MODELS), "seg", 2)
    assert none.count() == 0
    start = spark.createDataFrame(starts(["a"], [(0.0, 1.0)]), MODELS)
    assert collected(models.fair_lloyd_models(spark.createDataFrame([], POINTS), start, "seg", 2)) == {"a": {0: (0.0, 1.0)}}


def test_centres_of_unlike_length_are_an_error(spark):
    start = spark.createDataFrame([("a", 0, [1.0]), ("a", 1, [1.0, 2.0])], MODELS)
    with pytest.raises(ValueError, match="same number of coordinates"):
        models.fair_lloyd_models(spark.createDataFrame([], POINTS), start, "seg", 1)


def test_the_plan_does_not_grow_with_the_models(spark):
    size = {}
    for n in (3, 300):
        segs = [f"s{i}" for i in range(n)]
        df = models.fair_lloyd_models(spark.createDataFrame(cloud(600, 2, segs), POINTS),
                                      spark.createDataFrame(starts(segs, [(0.0, 0.0), (40.0, 40.0)]), MODELS), "seg", 1, repair=False)
        size[n] = len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())
        assert df.count() == 2 * n
    assert size[3] == size[300]


def test_large_states_are_joined_by_a_shuffle(spark, monkeypatch):
    from fairspark import staging
    monkeypatch.setattr(staging, "BROADCAST_BYTES", 0)
    segs = ["a", "b"]
    rows = cloud(200, 6, segs)
    start = [(10.0, 10.0), (300.0, 300.0), (50.0, 50.0)]
    got = collected(models.fair_lloyd_models(spark.createDataFrame(rows, POINTS).repartition(3),
                                             spark.createDataFrame(starts(segs, start), MODELS), "seg", 2))
    for s in segs:
        close(got[s], alone(spark, rows, s, start, 2))


def test_solver_agrees_with_the_line_search_operators(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2)) * 10
    grp = np.where(x[:, 0] < -4, "A", "B")
    pts = spark.createDataFrame([([float(a), float(b)], str(g)) for (a, b), g in zip(x, grp)], "features array<double>, grp string")
    centers = [(-10.0, 0.0), (10.0, 0.0), (0.0, 12.0)]
    stats = moments.center_group_stats(pts, centers)
    want = {r["cid"]: r["center"] for r in fair.fair_centers(fair.line_search(fair.fair_params(stats))).collect()}
    close(dict(enumerate(fair.fair_step(pts, centers))), [want[i] for i in range(3)])
    close(dict(enumerate(fair.fair_step(pts, centers, method="expr"))), [want[i] for i in range(3)])


def test_moments_far_from_the_origin(spark):
    rng = np.random.default_rng(9)
    x = np.array([-74.0, 40.7]) + rng.normal(size=(300, 2)) * 0.02
    pts = spark.createDataFrame([([float(a), float(b)], "A" if i % 2 else "B") for i, (a, b) in enumerate(x)], "features array<double>, grp string")
    got = {r["grp"]: r for r in moments.center_group_stats(pts.repartition(5), [(-74.0, 40.7)]).collect()}
    for g, rows in (("A", x[1::2]), ("B", x[0::2])):
        assert got[g]["n"] == len(rows)
        np.testing.assert_allclose(got[g]["sums"], rows.sum(axis=0), rtol=1e-13)
        np.testing.assert_allclose(got[g]["cost"], ((rows - rows.mean(axis=0)) ** 2).sum(), rtol=1e-12)


def test_wide_and_long_merges_agree(spark):
    pts = spark.createDataFrame([([float(i), float(i % 7)], "A" if i % 3 else "B") for i in range(100)], "features array<double>, grp string")
    rows = moments.moment_rows(pts.repartition(4), [(10.0, 1.0), (60.0, 3.0)])
    a, b = ({(r["cid"], r["grp"]): (r["n"], r["s1"], r["s2"]) for r in moments.merged(rows, dim=d).collect()} for d in (2, None))
    assert a.keys() == b.keys() and all(a[k][0] == b[k][0] for k in a)
    for k in a:
        np.testing.assert_allclose(a[k][1], b[k][1])
        np.testing.assert_allclose(a[k][2], b[k][2])
