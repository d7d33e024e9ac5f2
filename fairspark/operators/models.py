"""Fair Lloyd of many independent models, their centres a table.

* Points are staged once, as blocks: the points of one model, up to an Arrow batch of them, are one
  row of packed coordinates.  A large model has many blocks in many tasks.
* A step joins the blocks with the models' centres (sent to the executors below a checked size,
  else by a shuffle), assigns each block in one vectorised pass and gives moment rows (see
  ``moments``); they are merged per model, and one numpy solve finds the centres of all models of a
  batch.  The new centres are staged, so the plan is the same in every step and for any number of
  models, and the driver sees none of them.
* Where a model has centres without points, a second pass over that model's blocks ranks the donors
  of each empty centre: every block keeps as many as could be needed, blocks are merged, and the
  moved points are added to and taken from the moments, without another pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import batch_nearest, feature_matrix
from ..staging import Staged, sent_if_small
from .moments import MomentTable, is_group_b, merged

# fixed values of the bisection on gamma
GAMMA_START = 0.5
SEARCH_STEPS = 10
#: Points of a model that are dealt to one place when its blocks are made.
DEALT_POINTS = 262_144

BLOCKS = "_model long, x binary, b binary"
ROWS = "_model long, cid int, grp int, n long, s1 array<double>, s2 double"
STATE = "_model long, centers array<double>"
DONORS = "_model long, target int, d double, features array<double>, grp int, cid int, n long"


def solve_models(n: np.ndarray, mean: np.ndarray, cost: np.ndarray,
                 steps: int = SEARCH_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Fair centres of M models at once: ``(centres (M, K, d), which of them are new)``.

    ``n`` (M, K, 2) are points per centre and group, ``mean`` (M, K, 2, d) their means and ``cost``
    (M, K, 2) their squared deviations from them.  gamma starts at 1/2 and moves by a halved step,
    up while group A's cost is the larger; it stays once both are equal, and x is that of the last
    gamma evaluated.  A centre without points, or of a model without one of the groups, is not new.
    """
    total = n.sum(axis=1).astype(np.float64)
    has = n > 0
    present = has.any(axis=2)
    both = (total > 0).all(axis=1)
    mu_a = np.where(has[:, :, 0, None], mean[:, :, 0], mean[:, :, 1])
    mu_b = np.where(has[:, :, 1, None], mean[:, :, 1], mean[:, :, 0])
    with np.errstate(invalid="ignore", divide="ignore"):
        ell = np.where(present, np.sqrt(((mu_a - mu_b) ** 2).sum(axis=2)), 0)
        alpha, beta = np.moveaxis(n / total[:, None, :], 2, 0)
        fixed_a, fixed_b = (cost.sum(axis=1) / total).T
        gamma = np.full(len(n), GAMMA_START)
        x, open_, power = np.zeros(ell.shape), both.copy(), GAMMA_START
        for _ in range(steps):
            g = gamma[:, None]
            at = np.where(present, (1 - g) * beta * ell / (g * alpha + (1 - g) * beta), 0)
            x = np.where(open_[:, None], at, x)
            a = fixed_a + (alpha * x * x).sum(axis=1)
            b = fixed_b + (beta * (ell - x) ** 2).sum(axis=1)
            power /= 2
            gamma = gamma + np.where(open_, np.sign(a - b) * power, 0)
            open_ &= a != b
        e, x = ell[:, :, None], x[:, :, None]
        centers = np.where(e == 0, mu_a, ((e - x) * mu_a + x * mu_b) / e)
    return centers, present & both[:, None]


def moments_to_stats(n: np.ndarray, s1: np.ndarray, s2: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means (..., K, 2, d) and costs (..., K, 2) from moments about ``centers`` (..., K, d)."""
    some = np.maximum(n, 1)
    shift = s1 / some[..., None]
    return centers[..., :, None, :] + shift, np.maximum(s2 - (s1 * shift).sum(axis=-1), 0)


class Model:
    """A model's table: its number, keys and centres, with sizes that hold for all models."""

    def __init__(self, models: DataFrame, by: Sequence[str]):
        packed = models.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("cid", "center"))).alias("_cs")).select(
            F.monotonically_increasing_id().alias("_model"), *by, F.col("_cs.cid").alias("_cids"),
            F.flatten("_cs.center").cast("array<double>").alias("centers"),
            F.array_min(F.transform("_cs.center", F.size)).alias("_low"), F.array_max(F.transform("_cs.center", F.size)).alias("_high"))
        self.by, self.staged = list(by), Staged(packed, "models")
        self.df = self.staged.df
        size = self.df.agg(F.count("*").alias("n"), F.max(F.size("_cids")).alias("k"), F.min("_low").alias("low"), F.max("_high").alias("high")).first()
        if size["low"] != size["high"]:
            raise ValueError("all centres need the same number of coordinates")
        self.n, self.k, self.dim = size["n"], size["k"] or 0, size["low"] or 0

    def send(self, df: DataFrame, values: int) -> DataFrame:
        """``df``, one row a model of ``values`` numbers, broadcast below the checked size."""
        return sent_if_small(df, self.n, 64 + 8 * values)


def point_blocks(points: DataFrame, model: Model) -> DataFrame:
    """``(_model, x, b)``: packed points of one model a row, spread over the tasks.

    A point of no model is an error.  Points meet by model and, for models of more than
    ``DEALT_POINTS``, by part of the model, so no task holds a large one.
    """
    by = model.by
    sizes = points.groupBy(*by).agg(F.count(F.lit(1)).alias("_points"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]
    known = model.df.select("_model", *by).alias("m").join(sizes.alias("p"), same, "left").select(
        "_model", *[F.col(f"m.{c}").alias(c) for c in by], F.ceil(F.coalesce("_points", F.lit(0)) / DEALT_POINTS).alias("_parts"))
    found = points.alias("p").join(model.send(known, 2 + 4 * len(by)).alias("m"), same, "left")
    number = F.when(F.col("_model").isNull(), F.raise_error(F.lit("a point of no model"))).otherwise(F.col("_model"))
    dealt = found.select(number.cast("long").alias("_model"), F.expr("pmod(monotonically_increasing_id(), greatest(_parts, 1))").alias("_part"),
                         F.col("p.features").alias("features"), F.col("p.grp").alias("grp"))
    dim = model.dim

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            of = b.column(0).to_numpy()
            x, group = feature_matrix(b.column(2), dim), is_group_b(b.column(3)).astype(np.uint8)
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            runs = list(zip(edges[:-1], edges[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[[i for i, _ in runs]]), pa.array([x[i:j].tobytes() for i, j in runs], pa.binary()),
                 pa.array([group[i:j].tobytes() for i, j in runs], pa.binary())], names=["_model", "x", "b"])

    return dealt.repartition("_model", "_part").sortWithinPartitions("_model").mapInArrow(pack, BLOCKS)


def _blocks_of(b: pa.RecordBatch, dim: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, model, points, groups, centres)`` of each block of a joined batch (_model, x, b, centers)."""
    for r in range(b.num_rows):
        x = np.frombuffer(b.column(1)[r].as_py()).reshape(-1, dim)
        group = np.frombuffer(b.column(2)[r].as_py(), np.uint8).astype(np.int64)
        yield r, b.column(0)[r].as_py(), x, group, np.array(b.column(3)[r].as_py()).reshape(-1, dim)


def block_moments(blocks: DataFrame, dim: int) -> DataFrame:
    """``ROWS`` of joined blocks; consecutive blocks of a model are added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tables: list[tuple[int, MomentTable]] = []
            for _, m, x, group, centers in _blocks_of(b, dim):
                if not tables or tables[-1][0] != m:
                    tables.append((m, MomentTable(centers)))
                d2, cid = batch_nearest(x, centers)
                tables[-1][1].add(x, group, cid, d2)
            some = [np.flatnonzero(t.n) for _, t in tables]
            slots = np.concatenate(some) if some else np.empty(0, np.int64)
            pick = lambda name: [v for (_, t), s in zip(tables, some) for v in getattr(t, name)[s]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m for (m, _), s in zip(tables, some) for _ in s], pa.int64()), pa.array((slots // 2).astype(np.int32)),
                 pa.array((slots % 2).astype(np.int32)), pa.array(pick("n"), pa.int64()),
                 pa.array(pick("s1"), pa.list_(pa.float64())), pa.array(pick("s2"), pa.float64())],
                names=["_model", "cid", "grp", "n", "s1", "s2"])

    return blocks.mapInArrow(run, ROWS)


def solved(state: DataFrame, rows: DataFrame, dim: int) -> DataFrame:
    """The next ``STATE``: models without points, or without one of the groups, keep their centres."""
    per_model = rows.groupBy("_model").agg(F.collect_list(F.struct("cid", "grp", "n", "s1", "s2")).alias("rows"))  # 2 K a model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [np.array(c) for c in b.column(1).to_pylist()]
            size = np.array([len(c) // dim for c in out])
            for k in np.unique(size):  # models of one size are solved together
                which = np.flatnonzero(size == k)
                n, s1, s2 = np.zeros((len(which), k, 2), np.int64), np.zeros((len(which), k, 2, dim)), np.zeros((len(which), k, 2))
                centers = np.stack([out[w] for w in which]).reshape(len(which), k, dim)
                for i, w in enumerate(which):
                    for r in b.column(2)[int(w)].as_py() or ():
                        n[i, r["cid"], r["grp"]], s2[i, r["cid"], r["grp"]] = r["n"], r["s2"]
                        s1[i, r["cid"], r["grp"]] = r["s1"]
                new, valid = solve_models(n, *moments_to_stats(n, s1, s2, centers))
                for i, c in zip(which, np.where(valid[:, :, None], new, centers)):
                    out[i] = c.ravel()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float64()))], names=["_model", "centers"])

    return state.join(per_model, "_model", "left").select("_model", "centers", "rows").mapInArrow(run, STATE)


def donor_rows(blocks: DataFrame, dim: int) -> DataFrame:
    """``DONORS`` of joined blocks (_model, x, b, centers, empty): the distinct rows of each block that
    lead for some empty centre, with their number.

    As many are kept as there are centres: one a centre must stay and one an earlier empty centre
    has moved.  A row that leads overall leads in every block that has it, so its number is whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple] = []
            for r, m, x, group, centers in _blocks_of(b, dim):
                _, cid = batch_nearest(x, centers)
                rows, n = np.unique(np.column_stack([x + 0.0, group, cid]), axis=0, return_counts=True)
                targets = b.column(4)[r].as_py()
                for t in targets:
                    d = np.zeros(len(rows))
                    for j in range(dim):
                        d += (rows[:, j] - centers[t, j]) ** 2
                    for i in np.argsort(d, kind="stable")[:len(targets) + len(centers)]:  # rows are in order already
                        found.append((m, t, float(d[i]), rows[i, :dim].tolist(), int(rows[i, dim]), int(rows[i, dim + 1]), int(n[i])))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("_model", "target", "d", "features", "grp", "cid", "n"), f)) for f in found], schema=pa.schema([
                    ("_model", pa.int64()), ("target", pa.int32()), ("d", pa.float64()), ("features", pa.list_(pa.float64())),
                    ("grp", pa.int32()), ("cid", pa.int32()), ("n", pa.int64())]))

    return blocks.mapInArrow(run, DONORS)


def _chooser(dim: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def choose(donors: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
        """The moments that the moves of one model take away and add."""
        rows: list[tuple] = []
        if len(about):
            m = int(about["_model"].iloc[0])
            centers = np.array(about["centers"].iloc[0]).reshape(-1, dim)
            sizes = {s["cid"]: s["n"] for s in about["sizes"].iloc[0]}
            moved: set[tuple] = set()
            for t, ranked in donors.groupby("target", sort=True):
                for r in ranked.sort_values("place").itertuples():
                    key = (tuple(r.features), r.grp, r.cid)
                    if key in moved or sizes[r.cid] <= r.n:
                        continue
                    moved.add(key)
                    sizes[r.cid] -= r.n
                    for cid, n in ((r.cid, -r.n), (t, r.n)):
                        gap = np.array(r.features) - centers[cid]
                        rows.append((m, int(cid), int(r.grp), int(n), (n * gap).tolist(), float(n * (gap * gap).sum())))
                    break
        return pd.DataFrame(rows, columns=["_model", "cid", "grp", "n", "s1", "s2"])

    return choose


def repaired(blocks: DataFrame, state: DataFrame, rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` after every empty centre of a model was given the point nearest to it.

    Empty centres in ascending order; the donor is the smallest (distance, coordinates, group, centre)
    among points not moved yet whose own centre keeps another point, with all rows like it.  A centre
    that no point can be moved to stays empty.
    """
    per_center = rows.groupBy("_model", "cid").agg(F.sum("n").alias("n"))
    seen = per_center.groupBy("_model").agg(F.collect_list(F.struct("cid", "n")).alias("sizes"))  # K a model
    about = state.join(seen, "_model").withColumn(
        "empty", F.expr(f"array_except(sequence(0, CAST(size(centers) / {model.dim} AS INT) - 1), sizes.cid)")).filter(F.size("empty") > 0)
    short = Staged(about, "short-models")
    if short.df.isEmpty():
        short.drop()
        return rows
    values = 3 * model.k + model.k * model.dim
    joined = blocks.join(model.send(short.df, values), "_model").select("_model", "x", "b", "centers", "empty")
    donors = (donor_rows(joined, model.dim).groupBy("_model", "target", "d", "features", "grp", "cid").agg(F.sum("n").alias("n"))
              .withColumn("place", F.row_number().over(Window.partitionBy("_model", "target").orderBy("d", "features", "grp", "cid")))
              .filter(F.col("place") <= 2 * model.k))
    moves = donors.groupBy("_model").cogroup(short.df.groupBy("_model")).applyInPandas(_chooser(model.dim), ROWS)
    both = Staged(merged(rows.unionByName(moves), ("_model",), model.dim).filter("n > 0"), "repaired")
    short.drop()
    return both.df


def fair_lloyd_models(points: DataFrame, models: DataFrame, by: str | Sequence[str], max_iter: int,
                      repair: bool = True) -> DataFrame:
    """``(*by, cid, center)`` of every model after ``max_iter`` fair steps.

    ``points`` has the key columns ``by``, ``features`` and ``grp``; ``models`` has one row per centre:
    ``(*by, cid, center)``, with ``cid`` from 0 in each model, whose centres may differ in number.
    A NULL key is a key.  A model without points, or without one of the groups, keeps its centres.
    """
    keys = [by] if isinstance(by, str) else list(by)
    model = Model(models, keys)
    if not model.n:
        return models.select(*keys, "cid", "center")
    blocks = Staged(point_blocks(points, model), "point-blocks")
    state, dim = model.df.select("_model", "centers"), model.dim
    last: Staged | None = None
    for _ in range(max_iter):
        joined = blocks.df.join(model.send(state, model.k * dim), "_model").select("_model", "x", "b", "centers")
        rows = Staged(merged(block_moments(joined, dim), ("_model",), dim), "moments")
        after = repaired(blocks.df, state, rows.df, model) if repair else rows.df
        new = Staged(solved(state, after, dim), "centres")
        rows.drop()
        if last is not None:
            last.drop()
        last, state = new, new.df
    blocks.drop()
    final = model.df.drop("centers").join(state, "_model")
    one = F.expr(f"transform(_cids, (c, i) -> named_struct('cid', c, 'center', slice(centers, i * {dim} + 1, {dim})))")
    return final.select(*keys, F.inline(one))
