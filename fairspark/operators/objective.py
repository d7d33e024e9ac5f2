"""Nearest-centre assignment, the standard and the fair objective, per-centre statistics.

Every function here is one pass over the points: the assignment is a
projection fused into the scan's codegen stage, and everything after it is a
partial (map-side) aggregation down to at most 2 K rows per partition, so the
only shuffle carries a few rows per task whatever the data size or skew.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Centers, nearest, sqdist
from ..sources.points import GROUP_A, GROUP_B


def assign(points: DataFrame, centers: Centers, features: str = "features",
           method: str = "auto") -> DataFrame:
    """Points plus ``d2`` (squared distance to) and ``cid`` (index of) the nearest centre."""
    nc = nearest(features, centers, method).alias("_nc")
    return points.select("*", nc).select(
        *[c for c in points.columns], F.col("_nc.d").alias("d2"), F.col("_nc.cid").alias("cid"))


def point_distances(points: DataFrame, centers: Centers, features: str = "features") -> DataFrame:
    """Points plus ``d0 .. d{K-1}``: squared distance to each centre."""
    return points.select("*", *[sqdist(features, c).alias(f"d{i}") for i, c in enumerate(centers)])


def cluster_costs(points: DataFrame, centers: Centers, method: str = "auto") -> DataFrame:
    """``(cid, grp, n, cost)``: points and summed squared distance per centre and group."""
    return (assign(points, centers, method=method)
            .groupBy("cid", "grp")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("d2").alias("cost")))


def standard_objective(points: DataFrame, centers: Centers) -> DataFrame:
    """``(delta)``: mean over all points of the squared distance to the nearest centre."""
    return assign(points, centers).agg(F.avg("d2").alias("delta"))


def group_mean_costs(points: DataFrame, centers: Centers) -> DataFrame:
    """``(grp, n, mean_cost)`` for each group present."""
    return (assign(points, centers).groupBy("grp")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("d2").alias("mean_cost")))


def fair_objective(points: DataFrame, centers: Centers) -> DataFrame:
    """``(phi)``: the larger of the two groups' mean squared distances."""
    return group_mean_costs(points, centers).agg(F.max("mean_cost").alias("phi"))


def cluster_group_counts(points: DataFrame, centers: Centers) -> DataFrame:
    """``(cid, n_a, n_b)`` for every centre that has points."""
    return (assign(points, centers).groupBy("cid")
            .agg(F.count_if(F.col("grp") == GROUP_A).alias("n_a"),
                 F.count_if(F.col("grp") == GROUP_B).alias("n_b")))


def literal_rows(spark, rows: Sequence[Sequence], names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """A small DataFrame from one literal parsed on the JVM side: the plan does not grow with the rows."""
    text = json.dumps([dict(zip(names, r)) for r in rows])
    schema = "array<struct<" + ", ".join(f"{n}: {t}" for n, t in zip(names, types)) + ">>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), schema)))


def centers_frame(spark, centers: Centers) -> DataFrame:
    """``(cid, center array<double>)`` from a driver-side centre list (K rows)."""
    return literal_rows(spark, [(i, [float(v) for v in c]) for i, c in enumerate(centers)],
                        ["cid", "center"], ["int", "array<double>"])


def center_text(center_col: str = "center", decimals: int = 6) -> F.Column:
    """``c0,c1,...`` with each coordinate printed to ``decimals`` places."""
    fmt = f"%.{decimals}f"
    return F.array_join(F.transform(F.col(center_col), lambda c: F.format_string(fmt, c)), ",")


def _stats_from_costs(spark, costs: DataFrame, centers: Centers) -> DataFrame:
    counts = costs.groupBy("cid").agg(
        F.sum(F.when(F.col("grp") == GROUP_A, F.col("n")).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("grp") == GROUP_B, F.col("n")).otherwise(0)).alias("n_b"))
    # both sides have at most K rows (cid ranges over the centre list)
    return (centers_frame(spark, centers).join(F.broadcast(counts), "cid", "left")
            .select("cid", center_text().alias("center"),
                    F.coalesce("n_a", F.lit(0)).cast("long").alias("n_a"),
                    F.coalesce("n_b", F.lit(0)).cast("long").alias("n_b"))
            .orderBy("cid"))


def _summary_from_costs(costs: DataFrame) -> DataFrame:
    g = costs.groupBy("grp").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"))
    return g.agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("grp") == GROUP_A, F.col("n")).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("grp") == GROUP_B, F.col("n")).otherwise(0)).alias("n_b"),
        (F.sum("cost") / F.sum("n")).alias("delta"),
        F.max(F.col("cost") / F.col("n")).alias("phi"),
    )


def center_stats(points: DataFrame, centers: Centers) -> DataFrame:
    """``(cid, center, n_a, n_b)`` in centre order; a centre without points has zero counts."""
    return _stats_from_costs(points.sparkSession, cluster_costs(points, centers), centers)


def evaluate(points: DataFrame, centers: Centers) -> DataFrame:
    """``(n, n_a, n_b, delta, phi)`` from one pass over the points."""
    return _summary_from_costs(cluster_costs(points, centers))


def report(points: DataFrame, centers: Centers) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summary ``(n, n_a, n_b, delta, phi)`` and centre statistics from one pass.

    Both derive from the at most 2 K (centre, group) rows, kept in memory; the
    third item is that cached frame, to ``unpersist`` when done.
    """
    costs = cluster_costs(points, centers).persist()
    return _summary_from_costs(costs), _stats_from_costs(points.sparkSession, costs, centers), costs


def compare(points: DataFrame, models: Mapping[str, Centers]) -> DataFrame:
    """``(model, delta, phi)`` for several centre sets, from one pass over the points."""
    names = list(models)
    per_point = points.select(
        "grp", *[nearest("features", models[m]).d.alias(f"_d{i}") for i, m in enumerate(names)])
    by_group = per_point.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"_d{i}").alias(f"_s{i}") for i in range(len(names))])
    one = by_group.agg(
        *[(F.sum(f"_s{i}") / F.sum("n")).alias(f"_delta{i}") for i in range(len(names))],
        *[F.max(F.col(f"_s{i}") / F.col("n")).alias(f"_phi{i}") for i in range(len(names))])
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"_delta{i}").alias("delta"),
                              F.col(f"_phi{i}").alias("phi")) for i, m in enumerate(names)])
    return one.select(F.inline(rows))
