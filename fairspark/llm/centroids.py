"""Centroid clustering in whole numbers with PCA-rotated filtering.

Vectors are rotated once into the principal axes of a bounded sample.  Of each are kept its leading
rotated coordinates and the norm of the rest, beside its integer components.  The squared distance
of the leading parts plus the squared difference of the two rest norms is never above the squared
distance to a centroid.  The centroid with the least bound is measured in integers; only those whose
bound does not exceed that distance are measured too, and the nearest is chosen among them.  Rotation
and sample decide how many distances are computed and never the result.

A round is one pass: each task adds up its vectors per cluster and gives at most ``k`` rows.

Defined results: rows whose vector is null, has a null or non-finite component or not ``dim``
components take no part; equal rows are separate vectors; starting centroids equal in hash go by
their components; a null id comes last in the start order; with fewer than ``k`` vectors each starts
a centroid; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stage, table
from .vectors import pack_rows, unpack_rows, whole_vectors

#: Rows on which the rotation is fitted (at most twice as many are read), and the share of their
#: variance that the leading coordinates hold.
SAMPLE_ROWS, LEADING_SHARE = 10_000, 0.75
#: Rows that one numpy pass compares with all centroids.
ROWS = 2_048


class Rotation:
    """Principal axes of a sample of vectors, the leading ones kept as coordinates."""

    def __init__(self, sample: np.ndarray, share: float = LEADING_SHARE):
        x = sample.astype(np.float64)
        self.mean = x.mean(axis=0)
        values, axes = np.linalg.eigh(np.cov(x - self.mean, rowvar=False, bias=True).reshape(x.shape[1], -1))
        values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
        held = np.cumsum(values) / max(values.sum(), 1e-300)
        self.axes = np.ascontiguousarray(axes[:, :max(1, int(np.searchsorted(held, share)) + 1)])

    def __call__(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and rest norm of each vector."""
        x = v - self.mean
        lead = x @ self.axes
        return lead, np.sqrt(np.maximum((x * x).sum(axis=1) - (lead * lead).sum(axis=1), 0))


def lower_bounds(lead: np.ndarray, rest: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray) -> np.ndarray:
    """A number for each vector and centroid that is never above their squared distance.

    The allowance for rounding is a billionth of the largest squares; their error is below 1e-14 of them.
    """
    a, b = (lead * lead).sum(axis=1), (c_lead * c_lead).sum(axis=1)
    flat_part = a[:, None] + b[None, :] - 2 * lead @ c_lead.T
    gap = rest[:, None] - c_rest[None, :]
    size = a.max(initial=0) + b.max(initial=0) + (rest * rest).max(initial=0) + (c_rest * c_rest).max(initial=0)
    return flat_part + gap * gap - 1e-9 * (size + 1)


def nearest_centroid(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray,
                     c_lead: np.ndarray, c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (the smaller number at a tie), squared distance, and distances computed."""
    v = v.astype(np.int64)
    bound = lower_bounds(lead, rest, c_lead, c_rest)
    guess = bound.argmin(axis=1)
    gap = v - centroids[guess]
    first = np.einsum("ij,ij->i", gap, gap)
    row, cid = np.nonzero(bound <= first[:, None])
    gap = v[row] - centroids[cid]
    d = np.full(bound.shape, np.iinfo(np.int64).max)
    d[np.arange(len(v)), guess] = first
    d[row, cid] = np.einsum("ij,ij->i", gap, gap)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(v)), best], len(v) + len(row)


def _passes(b: pa.RecordBatch, dim: int) -> Iterator[tuple]:
    for i in range(0, b.num_rows, ROWS):
        part = b.slice(i, ROWS)
        yield (part, unpack_rows(part.column(1), "<i4", dim), unpack_rows(part.column(2), "<f8"),
               part.column(3).to_numpy(zero_copy_only=False))


def rotated_vectors(vectors: DataFrame, rotation: Rotation, dim: int) -> DataFrame:
    """``(vec_id, v, lead, rest)`` of ``vectors`` (vec_id, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lead, rest = rotation(unpack_rows(b.column(1), "<i4", dim))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pack_rows(lead, "<f8"), pa.array(rest)],
                                             names=["vec_id", "v", "lead", "rest"])

    return vectors.mapInArrow(run, "vec_id long, v binary, lead binary, rest double")


def cluster_sums(rotated: DataFrame, centroids: np.ndarray, rotation: Rotation) -> list:
    """``(cluster, n, s0, s1, ...)`` after one assignment: at most one row per centroid and task."""
    k, dim = centroids.shape
    c_lead, c_rest = rotation(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches:
            for _, v, lead, rest in _passes(b, dim):
                best, _, _ = nearest_centroid(v, lead, rest, centroids, c_lead, c_rest)
                n += np.bincount(best, minlength=k)
                order = np.argsort(best, kind="stable")
                present, at = np.unique(best[order], return_index=True)
                sums[present] += np.add.reduceat(v[order].astype(np.int64), at, axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), *[pa.array(sums[some, j]) for j in range(dim)]],
                                         names=["cluster", "n", *[f"s{j}" for j in range(dim)]])

    cols = ["n", *[f"s{j}" for j in range(dim)]]
    parts = rotated.mapInArrow(run, "cluster int, " + ", ".join(f"{c} long" for c in cols))
    return parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in cols]).collect()  # at most k rows


def assigned(rotated: DataFrame, centroids: np.ndarray, rotation: Rotation) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""
    dim = centroids.shape[1]
    c_lead, c_rest = rotation(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, v, lead, rest in _passes(b, dim):
                best, d, _ = nearest_centroid(v, lead, rest, centroids, c_lead, c_rest)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.astype(np.int32)), pa.array(d)],
                                                 names=["vec_id", "cluster", "distance"])

    return rotated.mapInArrow(run, "vec_id long, cluster int, distance long")


def centroid_clusters(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, salt: str = "2:",
                      vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` as a stored table, and the final centroids (k rows)."""
    vectors = whole_vectors(df, vector, {"vec_id": F.col("vec_id")}, dim=dim)
    start = (vectors.orderBy(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).asc_nulls_last(), F.hex("v"))
             .limit(k).collect())
    if not start:
        return vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), np.empty((0, dim), np.int64)
    centroids = np.array([np.frombuffer(r["v"], "<i4") for r in start], np.int64)
    share = min(1.0, SAMPLE_ROWS / max(1, vectors.count()))
    sample = vectors.select("v").sample(share, seed=1).limit(2 * SAMPLE_ROWS).collect() if share < 1 else vectors.select("v").collect()
    rotation = Rotation(np.array([np.frombuffer(r["v"], "<i4") for r in sample or start]))
    rotated = stage(rotated_vectors(vectors, rotation, dim), "rotated")
    for _ in range(rounds):
        for r in cluster_sums(rotated, centroids, rotation):
            centroids[r["cluster"]] = [s // r["n"] for s in r[2:]]
    return stage(assigned(rotated, centroids, rotation), "clusters"), centroids


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters, centroids = centroid_clusters(table(spark, sf_dir, "embeddings"))
    sums = {r["cluster"]: r["d"] for r in clusters.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    total = sum(sums.values())
    rows = [(i, sums[i], total, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
            for i, c in enumerate(centroids) if i in sums]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return clusters.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows are sent


def _oracle(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """DuckDB text: every distance of every round, without a filter."""
    ctes = [f"""pts AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {dim}
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS cid, v AS c
        FROM pts ORDER BY sha256('2:' || vec_id), v LIMIT {k})"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS (SELECT vec_id, v, arg_min(cid, (d, cid)) AS cid, min(d) AS d FROM (
            SELECT p.vec_id, p.v, c.cid, CAST(list_sum(list_transform(list_zip(p.v, c.c), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS BIGINT) AS d
            FROM pts p CROSS JOIN c{r} c) GROUP BY vec_id, v)""")
        if r < rounds:
            ctes.append(f"""m{r} AS (SELECT cid, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM
                (SELECT cid, unnest(v) AS x, unnest(range({dim})) AS j FROM a{r}) GROUP BY cid, j)""")
            ctes.append(f"""c{r + 1} AS (SELECT c.cid, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN
                (SELECT cid, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM m{r} GROUP BY cid) m ON c.cid = m.cid)""")
    last = f"a{rounds}"
    return "WITH " + ",\n".join(ctes) + f"""
        SELECT a.vec_id, CAST(a.cid AS INTEGER) AS cluster, a.d AS distance,
            CAST(sum(a.d) OVER (PARTITION BY a.cid) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c.c, ',')) AS centroid_sha256
        FROM {last} a JOIN c{rounds} c ON a.cid = c.cid"""


ORACLE = _oracle()
