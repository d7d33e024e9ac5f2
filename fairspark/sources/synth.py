"""Two-group synthetic point clouds as a distributed source.

For ``n`` points and ``k`` true centres each centre gets ``c = n div k``
points (the remainder is dropped); the first ``int(0.8 c)`` are group A, the
rest group B.  Centre ``i`` has x uniform in ``10 + 100 i +- 10``; y is uniform
in ``60 +- 10`` for A and ``20 +- 10`` for B; coordinates carry at most six
decimals (half-even).

Rows come from ``spark.range`` and the uniforms from a hash of
``(seed, axis, id)``, so every row is the same whatever the partitioning or
the retry of a lost task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .numbering import numbered

# fixed values of the generator
X_START = 10.0
X_STEP = 100.0
Y_A = 60.0
Y_B = 20.0
HALF_RANGE = 10.0
SHARE_A = 0.8
DECIMALS = 6
TWO_POW_52 = 4503599627370496.0


def hash_uniform(seed: int, axis: str, id_col: Column) -> Column:
    """Uniform in [0, 1) from the first 52 bits of md5('<seed>-<axis>-<id>')."""
    h = F.md5(F.concat_ws("-", F.lit(str(seed)), F.lit(axis), id_col.cast("string")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(TWO_POW_52)


def synth_points(spark: SparkSession, n: int, k: int, seed: int = 42,
                 partitions: int | None = None) -> DataFrame:
    """``(id, cid, x, y, grp)`` for ``k * (n div k)`` points."""
    if k <= 0:
        raise ValueError("k must be positive")
    per = n // k
    n_a = int(SHARE_A * per)
    total = per * k
    ids = spark.range(0, total, 1, partitions) if partitions else spark.range(0, total)
    cid = F.expr(f"CAST(id div {per} AS INT)") if per else F.lit(0)
    is_a = (F.col("id") % F.lit(max(per, 1))) < F.lit(n_a)
    return _place(ids.select("id", cid.alias("cid"), is_a.alias("is_a")), ["id"], F.col("id"), seed)


def deal_points(rows: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``(id, cid, x, y, grp)``: the points of ``synth_points`` for as many as ``rows`` has rows.

    Every row is dealt one number by exact ranking (no sort, no shuffle of rows), and its number decides
    centre and group, so each centre has ``n div k`` points of which ``int(0.8 (n div k))`` are in A; the
    rows beyond ``k * (n div k)`` get none.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    ids, n = numbered(rows.select(F.lit(True).alias("_row")))
    per = n // k
    share = ids.filter(F.col("id") < per * k).select(
        "id", F.expr(f"CAST(id div {max(per, 1)} AS INT)").alias("cid"), (F.col("id") % max(per, 1) < int(SHARE_A * per)).alias("is_a"))
    return _place(share, ["id"], F.col("id"), seed)


def synth_points_of(rows: DataFrame, keys: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """``(*keys, cid, x, y, grp)``: one point per row, drawn by a hash of its key columns.

    Centre and group are drawn too, uniform over the ``k`` centres and A with probability 0.8, so no row
    count is needed and nothing is shuffled.  Rows with equal keys give equal points; a NULL key is left
    out of the hashed text.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in keys])
    drawn = rows.select(*keys, F.floor(hash_uniform(seed, "cid", key) * k).cast("int").alias("cid"),
                        (hash_uniform(seed, "grp", key) < SHARE_A).alias("is_a"))
    return _place(drawn, keys, key, seed)


def _place(rows: DataFrame, keys: Sequence[str], key: Column, seed: int) -> DataFrame:
    x_lo = F.lit(X_START - HALF_RANGE) + F.col("cid").cast("double") * F.lit(X_STEP)
    y_lo = F.when(F.col("is_a"), F.lit(Y_A - HALF_RANGE)).otherwise(F.lit(Y_B - HALF_RANGE))
    span = F.lit(2 * HALF_RANGE)
    return rows.select(
        *keys, "cid",
        F.bround(x_lo + hash_uniform(seed, "x", key) * span, DECIMALS).alias("x"),
        F.bround(y_lo + hash_uniform(seed, "y", key) * span, DECIMALS).alias("y"),
        F.when(F.col("is_a"), F.lit("A")).otherwise(F.lit("B")).alias("grp"))
