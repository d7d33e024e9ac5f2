"""How often queries read and shuffle their points and lines."""

from fairspark.functions.geometry import nearest
from fairspark.operators import kmeans, seeding
from fairspark.plans import queries, tables


def test_properties_seed_once(spark, monkeypatch):
    calls, kept = [], []
    pts = spark.createDataFrame([([float(i % 13), float(i % 7)], "A") for i in range(300)], "features array<double>, grp string")
    monkeypatch.setattr(tables, "p2_points", lambda *_: pts)
    seed, persist = kmeans.seed_centers, seeding.persist_points
    monkeypatch.setattr(kmeans, "seed_centers", lambda *a, **k: calls.append(1) or seed(*a, **k))
    monkeypatch.setattr(seeding, "persist_points", lambda p: kept.append(persist(p)) or kept[-1])
    row = queries.kmeans_properties(spark, "").first()
    assert (row["n_centers"], row["n_points"], row["costs"], row["improved"]) == (5, 300, True, True)
    assert len(calls) == len(kept) == 1
    assert not kept[0].storageLevel.useMemory


def test_with_nearest_as_expression(spark):
    pts = spark.createDataFrame([([float(i % 13), i / 7], str(i)) for i in range(100)], "features array<double>, name string")
    cs = [(1.0, 2.0), (5.0, 9.0), (1.0, 2.0)]
    near = nearest("features", cs)
    want = pts.select("name", near.d.alias("d2"), near.cid.alias("cid")).collect()
    assert sorted(seeding.with_nearest(pts, cs).select("name", "d2", "cid").collect()) == sorted(want)
