"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Computed doubles are rounded to 6 places so that an oracle summing in another
order gives the same values.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import center_table, fair, kmeans, models, moments, objective, words
from ..session import ensure_checkpoint_dir
from ..sources.diverted import read_points_diverted
from ..sources.points import group_counts, parse_points
from ..sources.synth import deal_points, synth_points_of
from . import tables
from .tables import P2_CENTERS, P2_FAR_CENTER

KEYS = ("l_orderkey", "l_linenumber")
SALTS = 8
SEEDED_STEPS = 5


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _centers_df(spark: SparkSession, centers, prefix: str = "c") -> DataFrame:
    dim = len(centers[0])
    names = ["cid"] + [f"{prefix}{j}" for j in range(dim)]
    df = objective.literal_rows(spark, [(i, *[float(v) for v in c]) for i, c in enumerate(centers)],
                                names, ["int"] + ["double"] * dim)
    return df.select("cid", *[r6(f"{prefix}{j}").alias(f"{prefix}{j}") for j in range(dim)])


def _centers_long(spark: SparkSession, centers) -> DataFrame:
    rows = [(i, j, float(v)) for i, c in enumerate(centers) for j, v in enumerate(c)]
    df = objective.literal_rows(spark, rows, ["cid", "j", "value"], ["int", "int", "double"])
    return df.select("cid", "j", r6("value").alias("value"))


# ---------------------------------------------------------------- text

def wc_num_docs(spark, d):
    return words.num_docs(tables.doc_lines(spark, d, keep_line_no=False))


def wc_per_doc(spark, d):
    return words.per_doc_counts(tables.doc_lines(spark, d), ["doc_id", "line_no"])


def wc_one_round(spark, d):
    return words.word_counts(tables.doc_lines(spark, d, keep_line_no=False))


def wc_salted(spark, d):
    return words.word_counts(tables.doc_lines(spark, d), "salted", SALTS, ["doc_id", "line_no"])


def wc_salted_expr(spark, d):
    return words.word_counts(tables.doc_lines(spark, d), "salted_expr", SALTS, ["doc_id", "line_no"])


def wc_partitions(spark, d):
    return words.word_counts(tables.doc_lines(spark, d, keep_line_no=False), "partition")


def wc_distinct_words(spark, d):
    return words.distinct_words(words.word_counts(tables.doc_lines(spark, d, keep_line_no=False)))


def wc_avg_word_length(spark, d):
    counts = words.word_counts(tables.doc_lines(spark, d, keep_line_no=False))
    return words.avg_word_length(counts).select(r6("avg_word_length").alias("avg_word_length"))


# ---------------------------------------------------------------- points, objectives

def points_parse(spark, d):
    li = tables.table(spark, d, "lineitem")
    text = F.concat_ws(",", F.col("l_quantity").cast("string"),
                       (F.col("l_extendedprice") / F.lit(tables.PRICE_SCALE)).cast("string"),
                       F.col("l_linestatus"))
    pts = parse_points(li.select(text.alias("value")), 2, group_a="F", group_b="O")
    return pts.select(F.col("features")[0].alias("x"), F.col("features")[1].alias("y"), "grp")


def points_group_counts(spark, d):
    return group_counts(tables.p2_points(spark, d, "balanced"))


def point_center_distance(spark, d):
    pts = tables.p2_points(spark, d, keep=KEYS)
    out = objective.point_distances(pts, P2_CENTERS)
    return out.select(*KEYS, *[r6(f"d{i}").alias(f"d{i}") for i in range(len(P2_CENTERS))])


def nearest_center(spark, d):
    pts = tables.p2_points(spark, d, keep=KEYS)
    return objective.assign(pts, P2_CENTERS).select(*KEYS, "cid", r6("d2").alias("d2"))


def delta_objective(spark, d):
    return objective.standard_objective(tables.p2_points(spark, d), P2_CENTERS).select(
        r6("delta").alias("delta"))


def group_mean_costs(spark, d):
    return objective.group_mean_costs(tables.p2_points(spark, d), P2_CENTERS).select(
        "grp", "n", r6("mean_cost").alias("mean_cost"))


def phi_objective(spark, d):
    return objective.fair_objective(tables.p2_points(spark, d), P2_CENTERS).select(
        r6("phi").alias("phi"))


def center_stats(spark, d):
    return objective.center_stats(tables.p2_points(spark, d), [*P2_CENTERS, P2_FAR_CENTER])


def cluster_group_counts(spark, d):
    return objective.cluster_group_counts(tables.p2_points(spark, d), P2_CENTERS)


def evaluate_balanced(spark, d):
    return objective.evaluate(tables.p2_points(spark, d, "balanced"), P2_CENTERS).select(
        "n", "n_a", "n_b", r6("delta").alias("delta"), r6("phi").alias("phi"))


# ---------------------------------------------------------------- fair clustering pieces

def _p2_stats(spark, d):
    assigned = objective.assign(tables.p2_points(spark, d), P2_CENTERS)
    return fair.cluster_group_stats(assigned, 2)


def cluster_group_sums(spark, d):
    s = _p2_stats(spark, d)
    # y carries five decimals, so six-place rounding keeps summation-order noise
    # away from a rounding boundary
    return s.select("cid", "grp", "n", r6(F.col("sums")[0]).alias("sum_x"),
                    r6(F.col("sums")[1]).alias("sum_y"))


def _params_cols():
    return ["cid", "n_a", "n_b", r6("alpha").alias("alpha"), r6("beta").alias("beta"),
            r6(F.col("mu_a")[0]).alias("mu_a_x"), r6(F.col("mu_a")[1]).alias("mu_a_y"),
            r6(F.col("mu_b")[0]).alias("mu_b_x"), r6(F.col("mu_b")[1]).alias("mu_b_y"),
            r6("ell").alias("ell")]


def cluster_fair_params(spark, d):
    return fair.fair_params(_p2_stats(spark, d)).select(*_params_cols())


def fair_fixed_costs(spark, d):
    return fair.fixed_costs(_p2_stats(spark, d)).select(
        r6("fixed_a").alias("fixed_a"), r6("fixed_b").alias("fixed_b"))


def fair_line_search(spark, d):
    search = fair.line_search(fair.fair_params(_p2_stats(spark, d)))
    return search.select("gamma", F.inline("xs")).select("cid", "gamma", r6("x").alias("x"))


def fair_centers(spark, d):
    params = fair.fair_params(_p2_stats(spark, d))
    out = fair.fair_centers(fair.line_search(params))
    return out.select("cid", r6(F.col("center")[0]).alias("c0"), r6(F.col("center")[1]).alias("c1"))


def fair_lloyd_1(spark, d):
    return _centers_df(spark, fair.fair_lloyd(tables.p2_points(spark, d), init_centers=P2_CENTERS,
                                              max_iter=1))


def fair_lloyd_2(spark, d):
    return _centers_df(spark, fair.fair_lloyd(tables.p2_points(spark, d), init_centers=P2_CENTERS,
                                              max_iter=2))


def _start_models(pts, by, centers, extra=None, extra_for=None):
    """One row per model and start centre; models whose key is ``extra_for`` have further ones."""
    rows = lambda cs: F.array(*[F.struct(F.lit(i).alias("cid"), F.array(*[F.lit(v) for v in c]).alias("center"))
                                for i, c in enumerate(cs)])
    start = rows(centers) if extra is None else F.when(F.col(by) == extra_for, rows([*centers, *extra])).otherwise(rows(centers))
    return pts.select(by).distinct().select(by, F.inline(start))


def _models_out(df, by):
    return df.select(by, "cid", r6(F.col("center")[0]).alias("c0"), r6(F.col("center")[1]).alias("c1"))


def fair_lloyd_by_segment(spark, d):
    """Two fair steps of one model per return flag, all models in the same passes."""
    pts = tables.p2_points(spark, d, keep=("l_returnflag",))
    out = models.fair_lloyd_models(pts, _start_models(pts, "l_returnflag", P2_CENTERS), "l_returnflag", 2)
    return _models_out(out, "l_returnflag")


def fair_lloyd_by_segment_repair(spark, d):
    """The same, one step; the model of flag N starts with three far centres that want the same points."""
    pts = tables.p2_points(spark, d, keep=("l_returnflag",))
    start = _start_models(pts, "l_returnflag", P2_CENTERS, tables.P2_FAR_CENTERS, "N")
    return _models_out(models.fair_lloyd_models(pts, start, "l_returnflag", 1), "l_returnflag")


def fair_lloyd_by_part(spark, d):
    """Two fair steps of one model per part, as many models as there are parts."""
    pts = tables.p2_points(spark, d, keep=("l_partkey",))
    start = _start_models(pts, "l_partkey", tables.PART_CENTERS)
    out = models.fair_lloyd_models(pts, start, "l_partkey", 2, repair=False)
    return out.select("l_partkey", "cid", *[r6(F.col("center")[j] + tables.OFF_HALVES).alias(f"c{j}") for j in (0, 1)])


def lloyd_standard_2(spark, d):
    return _centers_df(spark, kmeans.lloyd(tables.p2_points(spark, d), P2_CENTERS, 2))


def lloyd_bounded(spark, d):
    """Six standard steps with carried distance bounds."""
    return _centers_df(spark, kmeans.lloyd(tables.p2_points(spark, d), P2_CENTERS, 6, tol=0.0, bounds=True))


def fair_lloyd_bounded(spark, d):
    """Two fair steps with carried distance bounds."""
    return _centers_df(spark, fair.fair_lloyd(tables.p2_points(spark, d), init_centers=P2_CENTERS, max_iter=2,
                                              persist=False, bounds=True))


def fair_vs_standard(spark, d):
    pts = tables.p2_points(spark, d)
    std = kmeans.lloyd(pts, P2_CENTERS, 2)
    fc = fair.fair_lloyd(pts, init_centers=P2_CENTERS, max_iter=2)
    return objective.compare(pts, {"standard": std, "fair": fc}).select(
        "model", r6("delta").alias("delta"), r6("phi").alias("phi"))


def empty_center_repair(spark, d):
    centers = fair.fair_lloyd(tables.p2_points(spark, d),
                              init_centers=[*P2_CENTERS, P2_FAR_CENTER], max_iter=1)
    return _centers_df(spark, centers)


def empty_center_repair_many(spark, d):
    """Three empty centres that all want the same point."""
    centers = fair.fair_lloyd(tables.p2_points(spark, d), init_centers=[*P2_CENTERS, *tables.P2_FAR_CENTERS],
                              max_iter=1)
    return _centers_df(spark, centers)


def kmeans_properties(spark, d):
    """What holds for k-means whatever its random start: five centres, every point in one cluster, and
    training that does not raise the objective of the initial centres."""
    pts = tables.p2_points(spark, d).select("features", "grp")
    init = kmeans.kmeans_centers(pts, 5, 0)
    trained = kmeans.kmeans_centers(pts, 5, 10, starts=init)
    both = objective.assign(objective.assign(pts, init).select("features", F.col("d2").alias("d_init")), trained)
    return both.agg(F.count("cid").alias("n_points"), (F.avg("d2") > 0).alias("costs"),
                    (F.avg("d2") <= F.avg("d_init")).alias("improved")).select(
        F.lit(len(trained)).alias("n_centers"), "n_points", "costs", "improved")


def synth(spark, d):
    """As many synthetic points as there are order lines, with exact shares of centres and groups."""
    return deal_points(tables.table(spark, d, "lineitem", KEYS), 5, seed=42)


def _read_back(spark, d):
    """Point lines of the order lines, written as text and read with diversion; every seventh line of an
    order is broken in one of three ways."""
    x, y = F.col("l_quantity").cast("string"), (F.col("l_extendedprice") / F.lit(tables.PRICE_SCALE)).cast("string")
    good = F.concat_ws(",", x, y, F.col("l_linestatus"))
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    broken = F.when(F.col("l_orderkey") % 3 == 0, F.concat_ws(",", key, F.col("l_linestatus"))).when(
        F.col("l_orderkey") % 3 == 1, F.concat_ws(",", key, F.lit("1.5"), F.col("l_linestatus"))).otherwise(F.concat_ws(",", F.lit("1"), F.lit("2"), key))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/point-text-{uuid.uuid4().hex}"
    li = tables.table(spark, d, "lineitem", ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus"))
    li.select(F.when(F.col("l_linenumber") == 7, broken).otherwise(good).alias("value")).write.text(folder)
    return read_points_diverted(spark, folder, 2, group_a="F", group_b="O")


def points_read_good(spark, d):
    return _read_back(spark, d).good.select(F.col("features")[0].alias("x"), F.col("features")[1].alias("y"), "grp")


def points_read_bad(spark, d):
    """The diverted lines; ``line > 0`` in a file of ours stands for their place, which depends on the files."""
    return _read_back(spark, d).bad.select("value", "reason", (F.col("line") > 0).alias("placed"))


def nearest_center_table(spark, d):
    """Nearest of up to 2,000 centres, themselves a table: least quantity and highest price by order."""
    li = tables.table(spark, d, "lineitem", ("l_orderkey", "l_quantity", "l_extendedprice"))
    centers = li.groupBy((F.col("l_orderkey") % tables.TABLE_CENTERS).cast("int").alias("cid")).agg(
        F.array(F.min("l_quantity"), F.max("l_extendedprice") / F.lit(tables.PRICE_SCALE)).alias("center"))
    out = center_table.assign_from_table(tables.p2_points(spark, d, keep=KEYS), centers)
    return out.select(*KEYS, "cid", r6("d2").alias("d2"))


def synth_by_key(spark, d):
    """One synthetic point per order line, drawn by the line's key."""
    lines = tables.table(spark, d, "lineitem", KEYS)
    return synth_points_of(lines, KEYS, 5, seed=42)


def _seeded_points(spark, d):
    """The 2-d points with their draw key: quantity and price in cents, as text."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").cast("string")
    key = F.concat_ws("-", F.col("l_quantity").cast("long").cast("string"), cents)
    return tables.p2_points(spark, d, keep=("l_quantity", "l_extendedprice")).select(
        "features", "grp", key.alias("name"))


def _seeds(spark, d):
    return kmeans.kmeans_centers(_seeded_points(spark, d), 5, 0, key=F.col("name"))


def kmeans_standard(spark, d):
    return _centers_df(spark, kmeans.lloyd(tables.p2_points(spark, d), _seeds(spark, d), SEEDED_STEPS, tol=0.0))


def kmeans_init(spark, d):
    return _centers_df(spark, _seeds(spark, d))


def fair_vs_standard_kmeans(spark, d):
    """The comparison of the fair-clustering program: trained standard centres
    against fair Lloyd from the same k-means|| start (2 steps each)."""
    pts = tables.p2_points(spark, d).select("features", "grp")
    seeds = _seeds(spark, d)
    std = kmeans.lloyd(pts, seeds, 2)
    fc = fair.fair_lloyd(pts, init_centers=seeds, max_iter=2)
    return objective.compare(pts, {"standard": std, "fair": fc}).select(
        "model", r6("delta").alias("delta"), r6("phi").alias("phi"))


# ---------------------------------------------------------------- 64-d points

def nearest_center_p64(spark, d):
    pts = tables.p64_points(spark, d, keep=("vec_id",))
    cs = tables.p64_centers(spark, d)
    return objective.assign(pts, cs).select("vec_id", "cid", r6("d2").alias("d2"))


def phi_objective_p64(spark, d):
    cs = tables.p64_centers(spark, d)
    return objective.fair_objective(tables.p64_points(spark, d), cs).select(r6("phi").alias("phi"))


def cluster_group_counts_p64(spark, d):
    cs = tables.p64_centers(spark, d)
    return objective.cluster_group_counts(tables.p64_points(spark, d), cs)


def fair_lloyd_2_p64(spark, d):
    cs = tables.p64_centers(spark, d)
    return _centers_long(spark, fair.fair_lloyd(tables.p64_points(spark, d), init_centers=cs,
                                                max_iter=2))


def cluster_group_sums_p64(spark, d):
    stats = moments.center_group_stats(tables.p64_points(spark, d), tables.p64_centers(spark, d))
    return stats.select("cid", "grp", "n", F.posexplode("sums").alias("j", "v")).select(
        "cid", "grp", "n", "j", r6("v").alias("total"))


def fair_fixed_costs_p64(spark, d):
    stats = moments.center_group_stats(tables.p64_points(spark, d), tables.p64_centers(spark, d))
    return fair.fixed_costs(stats).select(r6("fixed_a").alias("fixed_a"), r6("fixed_b").alias("fixed_b"))


QUERIES = {
    "wc_num_docs": wc_num_docs,
    "wc_per_doc": wc_per_doc,
    "wc_one_round": wc_one_round,
    "wc_salted": wc_salted,
    "wc_salted_expr": wc_salted_expr,
    "wc_partitions": wc_partitions,
    "wc_distinct_words": wc_distinct_words,
    "wc_avg_word_length": wc_avg_word_length,
    "points_parse": points_parse,
    "points_group_counts": points_group_counts,
    "point_center_distance": point_center_distance,
    "nearest_center": nearest_center,
    "delta_objective": delta_objective,
    "group_mean_costs": group_mean_costs,
    "phi_objective": phi_objective,
    "center_stats": center_stats,
    "cluster_group_counts": cluster_group_counts,
    "evaluate_balanced": evaluate_balanced,
    "cluster_group_sums": cluster_group_sums,
    "cluster_fair_params": cluster_fair_params,
    "fair_fixed_costs": fair_fixed_costs,
    "fair_line_search": fair_line_search,
    "fair_centers": fair_centers,
    "fair_lloyd_1": fair_lloyd_1,
    "fair_lloyd_2": fair_lloyd_2,
    "fair_lloyd_by_segment": fair_lloyd_by_segment,
    "fair_lloyd_by_segment_repair": fair_lloyd_by_segment_repair,
    "fair_lloyd_by_part": fair_lloyd_by_part,
    "lloyd_standard_2": lloyd_standard_2,
    "lloyd_bounded": lloyd_bounded,
    "fair_lloyd_bounded": fair_lloyd_bounded,
    "fair_vs_standard": fair_vs_standard,
    "empty_center_repair": empty_center_repair,
    "empty_center_repair_many": empty_center_repair_many,
    "kmeans_properties": kmeans_properties,
    "synth_points": synth,
    "synth_points_by_key": synth_by_key,
    "points_read_good": points_read_good,
    "points_read_bad": points_read_bad,
    "nearest_center_table": nearest_center_table,
    "kmeans_standard": kmeans_standard,
    "kmeans_init": kmeans_init,
    "fair_vs_standard_kmeans": fair_vs_standard_kmeans,
    "nearest_center_p64": nearest_center_p64,
    "phi_objective_p64": phi_objective_p64,
    "cluster_group_counts_p64": cluster_group_counts_p64,
    "fair_lloyd_2_p64": fair_lloyd_2_p64,
    "cluster_group_sums_p64": cluster_group_sums_p64,
    "fair_fixed_costs_p64": fair_fixed_costs_p64,
}
