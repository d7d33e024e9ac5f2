import math

import pytest
from pyspark.sql import functions as F

from fairspark.operators import fair, kmeans, objective
from fairspark.sources.points import load_points, points_from

C0 = [(40.75, -73.98), (40.72, -74.19), (40.78, -73.43), (40.66, -73.78)]
FAIR_1 = [(40.735974416406805, -73.9864213926918), (40.724438513943426, -74.19369831842641),
          (40.77613850408217, -73.42123535686068), (40.657238350487205, -73.79080752520352)]
STD_2 = [(40.75072129436318, -73.98043643006254), (40.72421388888889, -74.19368888888889),
         (40.7793, -73.4287), (40.66339375, -73.7866125)]


def close(a, b, tol=1e-9):
    return all(abs(x - y) <= tol for p, q in zip(a, b) for x, y in zip(p, q))


@pytest.fixture(scope="module")
def labelled(spark, points_file):
    return load_points(spark, points_file, 2).cache()


def _means(spark, pts, cs):
    return {r["grp"]: r["mean_cost"] for r in objective.group_mean_costs(pts, cs).collect()}


def test_objectives_golden(spark, labelled):
    r = objective.evaluate(labelled, C0).head()
    assert (r["n"], r["n_a"], r["n_b"]) == (1012, 782, 230)
    assert r["delta"] == pytest.approx(0.0020373476778656, rel=1e-12)
    assert r["phi"] == pytest.approx(0.0026388332608695, rel=1e-12)
    m = _means(spark, labelled, C0)
    assert m["A"] == pytest.approx(0.0018604401534527, rel=1e-12)
    assert objective.standard_objective(labelled, C0).head()[0] == pytest.approx(r["delta"], rel=1e-14)
    assert objective.fair_objective(labelled, C0).head()[0] == pytest.approx(r["phi"], rel=1e-14)


def test_center_stats_golden(spark, labelled):
    rows = objective.center_stats(labelled, C0).collect()
    assert [r["n_a"] for r in rows] == [749, 22, 1, 10]
    assert [r["n_b"] for r in rows] == [209, 14, 1, 6]
    assert rows[0]["center"] == "40.750000,-73.980000"


def test_center_stats_empty_center_has_zero_counts(spark, labelled):
    rows = objective.center_stats(labelled, [*C0, (41.5, -73.0)]).collect()
    assert (rows[4]["n_a"], rows[4]["n_b"]) == (0, 0)


def test_fair_params_golden(spark, labelled):
    stats = fair.cluster_group_stats(objective.assign(labelled, C0), 2)
    params = {r["cid"]: r for r in fair.fair_params(stats).collect()}
    for cid, ell in enumerate([0.026826897, 0.000433498, 0.018461853, 0.014122479]):
        assert params[cid]["ell"] == pytest.approx(ell, abs=1e-9)
    fx = fair.fixed_costs(stats).head()
    assert fx["fixed_a"] == pytest.approx(0.0018194391726143, rel=1e-10)
    assert fx["fixed_b"] == pytest.approx(0.0022512054555460, rel=1e-10)
    search = fair.line_search(fair.fair_params(stats)).head()
    assert search["gamma"] == 0.1806640625
    xs = [e["x"] for e in search["xs"]]
    assert xs == pytest.approx([0.021767725, 0.000393406, 0.017337464, 0.012744901], abs=1e-9)


def test_fair_step_golden_both_paths(spark, labelled):
    driver = fair.fair_lloyd(labelled, init_centers=C0, max_iter=1)
    assert close(driver, FAIR_1, 1e-12)
    params = fair.fair_params(fair.cluster_group_stats(objective.assign(labelled, C0), 2))
    frame = {r["cid"]: tuple(r["center"]) for r in
             fair.fair_centers(fair.line_search(params)).collect()}
    assert close([frame[i] for i in range(4)], FAIR_1, 1e-12)
    m = _means(spark, labelled, driver)
    assert m["A"] == pytest.approx(0.002275743358998, rel=1e-10)
    assert m["B"] == pytest.approx(0.002274518820104, rel=1e-10)
    assert close(fair.fair_lloyd(labelled, init_centers=C0, max_iter=5), FAIR_1, 1e-12)


def test_standard_lloyd_golden(spark, labelled):
    cs = kmeans.lloyd(labelled, C0, 2, tol=0.0)
    assert close(cs, STD_2, 1e-12)
    r = objective.evaluate(labelled, cs).head()
    assert r["delta"] == pytest.approx(0.0020346814127193, rel=1e-10)


def test_empty_center_repair_golden(spark, labelled):
    cs = [*C0, (41.5, -73.0)]
    assigned = objective.assign(labelled, cs)
    repaired = fair.repair_empty(assigned, cs, {0, 1, 2, 3})
    counts = {r["cid"]: (r["n_a"], r["n_b"]) for r in
              repaired.groupBy("cid").agg(F.count_if(F.col("grp") == "A").alias("n_a"),
                                          F.count_if(F.col("grp") == "B").alias("n_b")).collect()}
    assert [counts[i] for i in range(5)] == [(749, 209), (22, 14), (1, 0), (10, 6), (0, 1)]
    out = fair.fair_lloyd(labelled, init_centers=cs, max_iter=1)
    assert close([out[0], out[1], out[3]], [FAIR_1[0], FAIR_1[1], FAIR_1[3]], 1e-12)
    assert close([out[2], out[4]], [(40.7829, -73.4372), (40.7757, -73.4202)], 1e-12)


def test_line_search_fixture_and_many_models(spark):
    # alpha, beta, ell per centre; fixed_a = 1, fixed_b = 2 (costs / sizes)
    rows = [("m1", 0, 0.6, 0.3, 2.0, 1, 1, 1.0, 2.0), ("m1", 1, 0.4, 0.7, 1.0, 1, 1, 1.0, 2.0)]
    rows += [("m2", c, a, b, ell, na, nb, ca, cb) for (_, c, a, b, ell, na, nb, ca, cb) in rows]
    rows += [("m3", 0, 0.5, 0.5, 1.0, 1, 1, 1.0, 1.0)]
    params = spark.createDataFrame(rows, "model string, cid int, alpha double, beta double, ell double, "
                                         "n_a long, n_b long, cost_a double, cost_b double")
    got = {r["model"]: r for r in fair.line_search(params, by=["model"]).collect()}
    for m in ("m1", "m2"):
        assert got[m]["gamma"] == 0.2392578125
        assert [e["x"] for e in got[m]["xs"]] == pytest.approx([1.227738377, 0.847660501], abs=1e-9)
    # symmetric model: equal costs at gamma = 1/2, the search stops at once
    assert got["m3"]["gamma"] == 0.5
    assert [e["x"] for e in got["m3"]["xs"]] == [0.5]


def test_missing_group_borrows_other_mean(spark):
    df = spark.createDataFrame([(0.0, 0.0, "A"), (2.0, 0.0, "B"), (10.0, 0.0, "B"), (12.0, 0.0, "B")],
                               "x double, y double, g string")
    pts = points_from(df, ["x", "y"], "g")
    out = fair.fair_lloyd(pts, init_centers=[(1.0, 0.0), (11.0, 0.0)], max_iter=1)
    assert out[1] == (11.0, 0.0)   # centre with only B points: ell = 0, stays at the B mean


def test_nearest_ties_pick_lowest_index(spark):
    df = spark.createDataFrame([(1.0, 0.0, "A")], "x double, y double, g string")
    pts = points_from(df, ["x", "y"], "g")
    for method in ("expr", "udf"):
        r = objective.assign(pts, [(0.0, 0.0), (2.0, 0.0), (1.0, 1.0)], method=method).head()
        assert (r["cid"], r["d2"]) == (0, 1.0)


def test_udf_and_expression_paths_agree(spark):
    from fairspark.plans import tables
    pts = tables.p64_points(spark, "/root/testdata/sf0.001", keep=("vec_id",))
    cs = tables.p64_centers(spark, "/root/testdata/sf0.001")
    a = {r["vec_id"]: (r["cid"], r["d2"]) for r in objective.assign(pts, cs, method="expr").collect()}
    b = {r["vec_id"]: (r["cid"], r["d2"]) for r in objective.assign(pts, cs, method="udf").collect()}
    assert a == b


def test_properties_on_table_points(spark):
    from fairspark.plans import tables
    pts = tables.p2_points(spark, "/root/testdata/sf0.01").cache()
    cs = tables.P2_CENTERS
    r = objective.evaluate(pts, cs).head()
    assert r["phi"] >= r["delta"]
    deltas = [objective.evaluate(pts, kmeans.lloyd(pts, cs, i, tol=0.0)).head()["delta"] for i in range(4)]
    assert all(b <= a + 1e-12 for a, b in zip(deltas, deltas[1:]))
    one_group = pts.withColumn("grp", F.lit("A"))
    r1 = objective.evaluate(one_group, cs).head()
    assert r1["phi"] == pytest.approx(r1["delta"], rel=1e-14)
    # the gamma search compares costs far from rounding noise on this fixture
    stats = fair.cluster_group_stats(objective.assign(pts, cs), 2)
    fx = fair.fixed_costs(stats).head()
    assert abs(fx["fixed_a"] - fx["fixed_b"]) / fx["fixed_a"] > 1e-6
    many = objective.compare(pts, {"a": cs, "b": cs[:3]})
    got = {x["model"]: x for x in many.collect()}
    assert got["a"]["delta"] == pytest.approx(r["delta"], rel=1e-12)
    assert got["a"]["phi"] == pytest.approx(r["phi"], rel=1e-12)
    assert got["b"]["delta"] >= got["a"]["delta"]
    pts.unpersist()


def test_kmeans_ml(spark, labelled):
    cs = kmeans.kmeans_centers(labelled, 4, 20)
    assert len(cs) == 4 and all(len(c) == 2 for c in cs)
    init = kmeans.kmeans_centers(labelled, 4, 0)
    assert len(init) == 4
    d_trained = objective.evaluate(labelled, cs).head()["delta"]
    d_init = objective.evaluate(labelled, init).head()["delta"]
    assert d_trained <= d_init + 1e-12
    assert math.isfinite(d_trained)


def test_udf_blocks_rows_for_many_centres(spark, monkeypatch):
    from fairspark.functions import geometry
    from fairspark.plans import tables
    pts = tables.p2_points(spark, "/root/testdata/sf0.001")
    cs = [(float(i % 50), float(i * 7 % 100)) for i in range(300)]

    def run():
        # the assignment depends only on the coordinates, so key by them
        return {tuple(r["features"]): (r["cid"], r["d2"])
                for r in objective.assign(pts, cs, method="udf").select("features", "cid", "d2").collect()}

    whole = run()
    monkeypatch.setattr(geometry, "UDF_BLOCK", 900)  # 3 rows per block
    assert run() == whole
    # brute force: first index reaching the least squared distance
    for (x, y), got in list(whole.items())[:300]:
        ds = [(x - cx) * (x - cx) + (y - cy) * (y - cy) for cx, cy in cs]
        m = min(ds)
        assert got == (ds.index(m), m)
