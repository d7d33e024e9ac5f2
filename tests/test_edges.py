import pytest
from pyspark.sql import functions as F

from fairspark.operators import fair, objective, words
from fairspark.plans import tables
from fairspark.sources.points import points_from
from fairspark.sources.text import lines_from

SF = "/root/testdata/sf0.01"


def _pts(spark, rows):
    df = spark.createDataFrame(rows, "x double, y double, g string")
    return points_from(df, ["x", "y"], "g")


def test_empty_input_objectives_are_null(spark):
    pts = _pts(spark, [(0.0, 0.0, "A")]).filter(F.lit(False))
    assert objective.standard_objective(pts, [(0.0, 0.0)]).head()["delta"] is None
    assert objective.fair_objective(pts, [(0.0, 0.0)]).head()["phi"] is None


def test_fair_lloyd_needs_both_groups(spark):
    pts = _pts(spark, [(0.0, 0.0, "A"), (1.0, 0.0, "A")])
    with pytest.raises(ValueError):
        fair.fair_lloyd(pts, init_centers=[(0.0, 0.0)], max_iter=1)


def test_word_length_counts_code_points(spark):
    df = spark.createDataFrame([(0, "\U0001F600a bb")], "doc_id long, text string")
    counts = words.word_counts(lines_from(df, "text", ["doc_id"]))
    assert words.avg_word_length(counts).head()[0] == 2.0


def test_repair_keeps_every_point_and_fills_every_centre(spark):
    pts = tables.p2_points(spark, SF).select("features", "grp").cache()
    cs = [*tables.P2_CENTERS, (200.0, 200.0), (-50.0, -50.0)]
    assigned = objective.assign(pts, cs)
    present = {r["cid"] for r in assigned.select("cid").distinct().collect()}
    assert len(present) == 5
    repaired = fair.repair_empty(assigned, cs, present)
    sizes = {r["cid"]: r["n"] for r in repaired.groupBy("cid").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(sizes) == list(range(7))
    assert sum(sizes.values()) == pts.count()
    pts.unpersist()


def test_repair_never_empties_the_donor_centre(spark):
    # the point nearest the empty centre is alone in its centre: the next one is taken
    pts = _pts(spark, [(0.0, 0.0, "A"), (0.1, 0.0, "B"), (10.0, 0.0, "A"), (10.2, 0.0, "B")])
    cs = [(0.0, 0.0), (10.0, 0.0), (50.0, 0.0)]
    assigned = objective.assign(pts, cs)
    repaired = fair.repair_empty(assigned, cs, {0, 1})
    got = {r["cid"]: r["n"] for r in repaired.groupBy("cid").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {0: 2, 1: 1, 2: 1}
    moved = repaired.filter("cid = 2").head()
    assert list(moved["features"]) == [10.2, 0.0]


def test_many_models_side_by_side_equal_single_models(spark):
    pts = tables.p2_points(spark, SF)
    seg = pts.withColumn("seg", F.when(F.col("features")[0] % 2 == 0, "even").otherwise("odd"))
    assigned = objective.assign(seg, tables.P2_CENTERS)
    stats = fair.cluster_group_stats(assigned, 2, by=["seg"])
    params = fair.fair_params(stats, by=["seg"])
    together = {(r["seg"], r["cid"]): tuple(r["center"])
                for r in fair.fair_centers(fair.line_search(params, by=["seg"]), by=["seg"]).collect()}
    for s in ("even", "odd"):
        one = assigned.filter(F.col("seg") == s).drop("seg")
        p1 = fair.fair_params(fair.cluster_group_stats(one, 2))
        alone = {r["cid"]: tuple(r["center"]) for r in fair.fair_centers(fair.line_search(p1)).collect()}
        for cid, c in alone.items():
            assert together[(s, cid)] == pytest.approx(c, abs=1e-9)
        fx = fair.fixed_costs(fair.cluster_group_stats(one, 2)).head()
        fxs = fair.fixed_costs(stats, by=["seg"]).filter(F.col("seg") == s).head()
        assert fxs["fixed_a"] == pytest.approx(fx["fixed_a"], rel=1e-12)


def test_line_search_gamma_in_bracket(spark):
    pts = tables.p2_points(spark, SF, "balanced")
    params = fair.fair_params(fair.cluster_group_stats(objective.assign(pts, tables.P2_CENTERS), 2))
    g = fair.line_search(params).head()["gamma"]
    assert 0.0 < g < 1.0
    assert (g * 1024) == int(g * 1024)   # a multiple of 2^-10 after 10 halvings


def test_fair_step_is_the_operators_in_a_row(spark):
    pts = tables.p2_points(spark, SF)
    stats = fair.cluster_group_stats(objective.assign(pts, tables.P2_CENTERS), 2)
    driver = fair.fair_step(pts, tables.P2_CENTERS)
    params = fair.fair_params(stats)
    frame = {r["cid"]: tuple(r["center"]) for r in fair.fair_centers(fair.line_search(params)).collect()}
    for cid, c in frame.items():
        assert driver[cid] == pytest.approx(c, abs=1e-10)


def test_report_matches_separate_operators(spark):
    pts = tables.p2_points(spark, SF, "balanced")
    cs = [*tables.P2_CENTERS, tables.P2_FAR_CENTER]
    summary, stats, cached = objective.report(pts, cs)
    try:
        assert summary.collect() == objective.evaluate(pts, cs).collect()
        assert stats.collect() == objective.center_stats(pts, cs).collect()
    finally:
        cached.unpersist()


def test_compare_on_the_udf_path_matches_separate_evaluations(spark):
    pts = tables.p64_points(spark, "/root/testdata/sf0.001")
    cs = tables.p64_centers(spark, "/root/testdata/sf0.001")
    models = {"all": cs, "half": cs[:5]}
    got = {r["model"]: r for r in objective.compare(pts, models).collect()}
    for name, centers in models.items():
        one = objective.evaluate(pts, centers).head()
        assert got[name]["delta"] == pytest.approx(one["delta"], rel=1e-12)
        assert got[name]["phi"] == pytest.approx(one["phi"], rel=1e-12)


def test_null_key_and_one_group_models_do_not_disturb_others(spark):
    rows = [(seg, 0, g, 2, [x, x], 0.5) for seg in (None, "s1") for g, x in (("A", 1.0), ("B", 5.0))] + [("only_a", 0, "A", 2, [1.0, 1.0], 0.5)]
    stats = spark.createDataFrame(rows, "seg string, cid int, grp string, n long, sums array<double>, cost double")
    params = fair.fair_params(stats, ["seg"])
    got = {r["seg"]: r["center"] for r in fair.fair_centers(fair.line_search(params, ["seg"]), ["seg"]).collect()}
    assert got[None] == got["s1"] and {None, "s1"} <= set(got)


@pytest.mark.parametrize("nan_at", [0, 1, 2])
def test_nan_centre_same_for_both_methods(spark, nan_at):
    centers = [(0.0, 0.0), (2.0, 2.0), (5.0, 5.0)]
    centers[nan_at] = (float("nan"), float("nan"))
    pts = spark.createDataFrame([([1.0, 1.0], "A"), ([2.0, 2.0], "B"), ([4.0, 5.0], "B")], "features array<double>, grp string")
    expr, udf = ([r["cid"] for r in objective.assign(pts, centers, method=m).orderBy("features").collect()] for m in ("expr", "udf"))
    assert expr == udf and nan_at not in expr


@pytest.mark.parametrize("method", ["expr", "udf"])
def test_a_vector_of_another_length_is_an_error(spark, method):
    pts = spark.createDataFrame([([1.0, 1.0, 99.0], "A"), ([1.0, 2.0, 3.0], "B")], "features array<double>, grp string")
    with pytest.raises(Exception, match="expected 2 coordinates"):
        objective.assign(pts, [(0.0, 0.0), (2.0, 2.0)], method=method).collect()


def test_repair_reads_the_points_once_for_all_empty_centres(spark):
    pts = spark.createDataFrame([([float(i), 0.0], "AB"[i % 2]) for i in range(40)] + [([39.0, 0.0], "B")] * 3,
                                "features array<double>, grp string")
    cs = [(0.0, 0.0), (30.0, 0.0), (100.0, 0.0), (101.0, 0.0), (102.0, 0.0)]
    assigned = objective.assign(pts, cs).select("features", "grp", "cid").repartition(5)
    moved = fair.repair_empty(assigned, cs, {0, 1})
    got = {r["cid"]: (r["n"], r["x"]) for r in moved.filter("cid > 1").groupBy("cid").agg(
        F.count("*").alias("n"), F.max(F.col("features")[0]).alias("x")).collect()}
    assert got == {2: (4, 39.0), 3: (1, 38.0), 4: (1, 37.0)}


def test_persisting_starts_no_job(spark):
    from fairspark.sources.points import persist_points

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("persist-test", "persist")
    pts = persist_points(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert list(tracker.getJobIdsForGroup("persist-test")) == []
    pts.unpersist()


def test_fair_lloyd_of_many_models_equals_each_alone(spark):
    rows = [(seg, float(x), float(x * 7 % 5) + off, "A" if x % 3 else "B")
            for seg, off in ((None, 0.0), ("s1", 3.0)) for x in range(24)] + [("only_a", 1.0, 1.0, "A")]
    df = spark.createDataFrame(rows, "seg string, x double, y double, g string")
    pts = points_from(df, ["x", "y"], "g", keep=("seg",))
    start = [(3.0, 2.0), (18.0, 4.0)]
    got = fair.fair_lloyd_by(pts, "seg", {s: start for s in (None, "s1", "only_a")}, 2)
    for seg in (None, "s1"):
        alone = fair.fair_lloyd(pts.filter(F.col("seg").eqNullSafe(F.lit(seg))), init_centers=start, max_iter=2)
        assert got[seg] == [pytest.approx(c, rel=1e-12) for c in alone]
    assert got["only_a"] == start  # lacks a group: stays
    with pytest.raises(Exception, match="no model"):
        fair.fair_lloyd_by(pts, "seg", {"s1": start}, 1)
