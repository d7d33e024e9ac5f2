import pytest
from pyspark.errors import PySparkException

from fairspark.sources.points import group_counts, parse_points, points_from
from fairspark.sources.synth import synth_points


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_parse_points(spark):
    pts = parse_points(_lines(spark, ["1.5,2,A", " 3.0 ,-4e1,B", "NaN,1,A"]), 2)
    rows = pts.collect()
    assert [list(r["features"]) for r in rows][:2] == [[1.5, 2.0], [3.0, -40.0]]
    assert [r["grp"] for r in rows] == ["A", "B", "A"]


def test_parse_maps_labels(spark):
    pts = parse_points(_lines(spark, ["1,2,F", "3,4,O"]), 2, group_a="F", group_b="O")
    assert [r["grp"] for r in pts.collect()] == ["A", "B"]


@pytest.mark.parametrize("bad", ["1,A", "1,2,3,A", "x,2,A", "1,2,C"])
def test_parse_fails_fast(spark, bad):
    with pytest.raises(PySparkException):
        parse_points(_lines(spark, ["1,2,A", bad]), 2).collect()


def test_parse_drop_mode(spark):
    pts = parse_points(_lines(spark, ["1,2,A", "1,A", "x,2,A", "1,2,C", "5,6,B"]), 2, on_bad="drop")
    assert sorted((tuple(r["features"]), r["grp"]) for r in pts.collect()) == [
        ((1.0, 2.0), "A"), ((5.0, 6.0), "B")]


def test_group_counts(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (3.0, "x")], "v double, g string")
    pts = points_from(df, ["v", "v"], "g", group_a="x", group_b="y")
    r = group_counts(pts).head()
    assert (r["n"], r["n_a"], r["n_b"]) == (3, 2, 1)


def test_third_label_is_an_error(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "z")], "v double, g string")
    with pytest.raises(PySparkException):
        points_from(df, ["v"], "g", group_a="x", group_b="y").collect()


def test_synth_shape_and_values(spark):
    df = synth_points(spark, 103, 4, seed=42)
    rows = df.orderBy("id").collect()
    per, n_a = 103 // 4, int(0.8 * (103 // 4))
    assert len(rows) == 4 * per
    assert rows[0]["x"] == round(0.0 + 0.8722287388701144 * 20.0, 6)
    for r in rows:
        i = r["id"]
        assert r["cid"] == i // per
        assert r["grp"] == ("A" if i % per < n_a else "B")
        lo = 100.0 * r["cid"]
        assert lo <= r["x"] <= lo + 20.0
        assert (40.0 if r["grp"] == "A" else 0.0) <= r["y"] - 10.0 <= (60.0 if r["grp"] == "A" else 20.0)
    assert round(r["x"], 6) == r["x"]


def test_synth_independent_of_partitioning(spark):
    parts = [sorted(tuple(r) for r in synth_points(spark, 500, 5, 7, partitions=p).collect())
             for p in (1, 4, 8)]
    assert parts[0] == parts[1] == parts[2]


def test_load_points_from_file(spark, tmp_path):
    from fairspark.sources.points import load_points
    p = tmp_path / "pts.csv"
    p.write_text("1.0,2.0,A\n3.5,-1.0,B\n0,0,A\n")
    pts = load_points(spark, str(p), 2, partitions=3)
    assert pts.rdd.getNumPartitions() == 3
    assert sorted((tuple(r["features"]), r["grp"]) for r in pts.collect()) == [
        ((0.0, 0.0), "A"), ((1.0, 2.0), "A"), ((3.5, -1.0), "B")]


def test_parse_fails_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException):
            parse_points(_lines(spark, ["1,2,A", "1,x,B"]), 2).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_number_forms_parse_like_java(spark):
    import math
    rows = ["NaN,1,A", "Infinity,1,A", " 1.5 ,1,A", "1.5d,1,A", "0x1p3,1,A", "-0.0,1e-3,B"]
    got = [list(r["features"]) for r in parse_points(_lines(spark, rows), 2).collect()]
    assert math.isnan(got[0][0]) and got[1][0] == math.inf
    assert [g[0] for g in got[2:]] == [1.5, 1.5, 8.0, -0.0] and got[5][1] == 0.001


def test_null_coordinates_are_errors(spark):
    from fairspark.sources.points import points_from_array
    df = spark.createDataFrame([(1.0, None, "x")], "a double, b double, g string")
    with pytest.raises(PySparkException):
        points_from(df, ["a", "b"], "g", group_a="x", group_b="y").collect()
    arr = spark.createDataFrame([([1.0, None], "x")], "e array<float>, g string")
    with pytest.raises(PySparkException):
        points_from_array(arr, "e", "g", group_a="x", group_b="y").collect()
