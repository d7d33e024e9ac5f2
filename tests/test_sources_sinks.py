"""Numbered rows, dealt points, reading with diversion, published results, centres as a table."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairspark import sinks
from fairspark.operators import center_table, objective
from fairspark.sources import diverted, numbering, synth


# ---------------------------------------------------------------- row numbers and dealt points

@pytest.mark.parametrize("parts", [1, 3, 9])
def test_rows_are_numbered_without_gaps(spark, parts):
    df = spark.range(0, 1000, 1, parts).filter("id % 7 <> 3").withColumnRenamed("id", "key")
    rows, n = numbering.numbered(df)
    got = rows.collect()
    assert n == len(got) == df.count()
    assert sorted(r["id"] for r in got) == list(range(n)) and len({r["key"] for r in got}) == n


def test_numbers_of_no_rows_and_of_a_clashing_name(spark):
    rows, n = numbering.numbered(spark.range(0).withColumnRenamed("id", "key"))
    assert n == 0 and rows.count() == 0
    with pytest.raises(ValueError):
        numbering.numbered(spark.range(3).withColumnRenamed("id", "ID"))


@pytest.mark.parametrize("n,k", [(103, 4), (100, 5), (3, 5), (0, 2)])
def test_dealt_points_have_exact_shares(spark, n, k):
    per = n // k
    got = synth.deal_points(spark.range(0, n, 1, 3).withColumnRenamed("id", "key"), k).collect()
    assert len(got) == per * k
    want = {tuple(r) for r in synth.synth_points(spark, n, k).collect()}
    assert {(r["id"], r["cid"], r["x"], r["y"], r["grp"]) for r in got} == want
    for c in range(k if per else 0):
        assert sum(r["cid"] == c and r["grp"] == "A" for r in got) == int(0.8 * per)


# ---------------------------------------------------------------- reading with diversion

LINES = ["1.0,2.0,A", "3,4,B", "1.0,2.0", "x,2.0,A", "", "5,6,C", "7.5,8.5,A", "1,2,3,A", "NaN,1,B", ",1,A", "9,9,B"]
REASONS = {3: "field count", 4: "malformed number", 5: "field count", 6: "label is neither group", 8: "field count", 10: "malformed number"}


def test_bad_lines_stand_beside_the_points(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES) + "\n")
    (tmp_path / "b.csv").write_text("1,1,A\nbad\n")
    got = diverted.read_points_diverted(spark, str(tmp_path), 2)
    bad = sorted((os.path.basename(r["file"]), r["line"], r["value"], r["reason"]) for r in got.bad.collect())
    assert bad == sorted([("a.csv", n, LINES[n - 1], why) for n, why in REASONS.items()] + [("b.csv", 2, "bad", "field count")])
    assert got.good.count() == len(LINES) - len(REASONS) + 1
    assert got.good.columns == ["features", "grp"] and got.good.filter("grp = 'B'").count() == 3
    got.drop()
    with pytest.raises(Exception):
        got.good.collect()


def test_line_numbers_over_many_splits(spark, tmp_path):
    lines = [f"{i},{i % 13},{'A' if i % 2 else 'B'}" if i % 17 else f"bad line {i}" for i in range(20_000)]
    (tmp_path / "long.csv").write_text("\n".join(lines))
    conf = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = diverted.read_points_diverted(spark, str(tmp_path), 2)
        bad = {r["line"]: r["value"] for r in got.bad.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert bad == {i + 1: f"bad line {i}" for i in range(0, 20_000, 17)}


def test_an_empty_file_has_neither(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    got = diverted.read_points_diverted(spark, str(tmp_path), 2)
    assert got.good.count() == got.bad.count() == 0


# ---------------------------------------------------------------- published results

@pytest.mark.parametrize("format", ["parquet", "json", "orc"])
def test_a_published_result_comes_back(spark, tmp_path, format):
    path = str(tmp_path / "out")
    df = spark.range(0, 100, 1, 4).select("id", (F.col("id") * 2).alias("twice"))
    assert sinks.publish(df, path, format) == 100
    assert sinks.publish(df.filter("id < 10"), path, format) == 10
    got = sinks.read_published(spark, path)
    assert got.schema.simpleString() == df.schema.simpleString() and sorted(r["id"] for r in got.collect()) == list(range(10))
    assert sinks.manifests(spark, path).count() == 2


def test_a_failed_job_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, path)
    good = spark.range(0, 50, 1, 3)
    sinks.publish(good, path)
    broken = spark.range(0, 50, 1, 3).select(F.when(F.col("id") == 49, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, path)
    assert sinks.read_published(spark, path).count() == 50
    assert sinks.manifests(spark, path).count() == 1


def test_missing_files_are_noticed(spark, tmp_path):
    path = tmp_path / "out"
    sinks.publish(spark.range(0, 50, 1, 3), str(path))
    folder = next(p for p in path.iterdir() if p.name.startswith("data-"))
    next(folder.glob("*.parquet")).unlink()
    with pytest.raises(RuntimeError, match="its manifest says 50"):
        sinks.read_published(spark, str(path))


def test_centres_are_written_with_their_text(spark, tmp_path):
    path = str(tmp_path / "centres")
    sinks.publish(sinks.center_rows(spark, {"standard": [(1.0, 2.5)], "fair": [(0.1234567, -3.0)]}), path)
    got = {(r["model"], r["cid"]): (tuple(r["center"]), r["center_text"]) for r in sinks.read_published(spark, path).collect()}
    assert got == {("standard", 0): ((1.0, 2.5), "1.000000,2.500000"), ("fair", 0): ((0.1234567, -3.0), "0.123457,-3.000000")}
    with pytest.raises(ValueError):
        sinks.center_rows(spark, {})


# ---------------------------------------------------------------- centres as a table

def _cloud(n, dim, seed):
    rng = np.random.default_rng(seed)
    return np.round(rng.integers(0, 9, (n, 1)) * 4 + rng.normal(size=(n, dim)), 1)


@pytest.mark.parametrize("dim,k,block", [(2, 1, 1 << 20), (2, 700, 1 << 20), (8, 300, 1 << 20), (2, 700, 3_000)])
def test_table_of_centres_equals_the_plain_form(spark, dim, k, block):
    x, c = _cloud(600, dim, 1), _cloud(k, dim, 2)
    c[k // 2:] = c[: k - k // 2]  # every centre twice: the lower id wins
    points = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, features array<double>").repartition(3)
    centers = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(c)], "cid int, center array<double>").repartition(4)
    want = {r["id"]: (r["d2"], r["cid"]) for r in objective.assign(points, [tuple(p) for p in c.tolist()], method="udf").collect()}
    got = center_table.assign_from_table(points, centers, block)
    assert got.columns == ["id", "features", "d2", "cid"]
    assert {r["id"]: (r["d2"], r["cid"]) for r in got.collect()} == want


def test_bounds_skip_most_distances():
    x, c = _cloud(2000, 3, 3), _cloud(4000, 3, 4)
    index = center_table.CenterIndex(np.arange(len(c)), c)
    d, cid = index.nearest(x)
    full = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    np.testing.assert_allclose(d, full.min(axis=1))
    assert (np.abs(full[np.arange(len(x)), cid] - full.min(axis=1)) < 1e-12).all()
    assert index.computed < 0.2 * full.size


def test_nan_points_and_centres(spark):
    centers = spark.createDataFrame([(0, [float("nan"), 0.0]), (1, [5.0, 5.0]), (2, [0.0, 0.0])], "cid int, center array<double>")
    points = spark.createDataFrame([(0, [1.0, 1.0]), (1, [float("nan"), 1.0])], "id long, features array<double>")
    got = {r["id"]: r["cid"] for r in center_table.assign_from_table(points, centers).collect()}
    assert got == {0: 2, 1: 0}
    with pytest.raises(ValueError):
        center_table.assign_from_table(points, centers.limit(0))
    with pytest.raises(ValueError):
        center_table.assign_from_table(points, centers.unionByName(spark.createDataFrame([(3, [1.0])], "cid int, center array<double>")))


def test_many_centres_in_one_plan(spark):
    x, c = _cloud(3000, 2, 5), np.round(np.random.default_rng(6).normal(size=(10_000, 2)) * 20, 2)
    points = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, features array<double>").repartition(3)
    centers = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(c)], "cid int, center array<double>")
    out = center_table.assign_from_table(points, centers)
    few = center_table.assign_from_table(points, centers.limit(3))
    lines = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert lines(out) == lines(few)
    d = np.zeros((len(x), len(c)))
    for j in range(2):
        d += (x[:, j:j + 1] - c[None, :, j]) ** 2
    assert {r["id"]: r["cid"] for r in out.collect()} == dict(enumerate(d.argmin(axis=1).tolist()))


def test_staged_points_give_the_same_centres(spark):
    from fairspark.operators import fair
    x = _cloud(300, 2, 7)
    points = spark.createDataFrame([([float(v) for v in p], "A" if i % 3 else "B") for i, p in enumerate(x)], "features array<double>, grp string").repartition(3)
    start = [(0.0, 0.0), (20.0, 20.0)]
    want = fair.fair_lloyd(points, init_centers=start, max_iter=3)
    np.testing.assert_allclose(fair.fair_lloyd(points, init_centers=start, max_iter=3, persist="staged"), want, rtol=1e-9)
