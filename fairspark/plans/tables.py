"""How the shared test tables become points and text lines.

* P2: ``lineitem`` as 2-d points ``x = l_quantity``, ``y = l_extendedprice / 1000``,
  grouped either *balanced* (``l_linestatus = 'F'`` is A) or *unbalanced*
  (``l_quantity <= 10`` is A; one centre then has no A point).
* P64: ``embeddings`` as 64-d points, A = even label; the centres are the
  embeddings of the smallest ``vec_id`` of each label.
* Text: ``documents.text`` split into lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.partitioning import spread
from ..sources.points import points_from, points_from_array
from ..sources.text import lines_from

# fixed values: the P2 centre list, and a centre far from every P2 point
P2_CENTERS = [(10.0, 10.0), (10.0, 40.0), (25.0, 60.0), (40.0, 30.0), (40.0, 85.0)]
P2_FAR_CENTER = (200.0, 200.0)
PRICE_SCALE = 1000.0
UNBALANCED_QTY = 10.0
# three centres whose nearest point is the same one
P2_FAR_CENTERS = [(200.0, 200.0), (201.0, 201.0), (202.0, 202.0)]
# start centres of the models of the parts
PART_CENTERS = [(12.0, 15.0), (38.0, 55.0)]
# added before rounding where values are means of few prices: those end in halves of the last place
OFF_HALVES = 3.1e-7
# centres of the table of centres
TABLE_CENTERS = 2_000
P64_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """A test table, pruned to ``columns`` and spread over the task slots
    (each test file is a single row group, i.e. a single scan task)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df.select(*columns) if columns else df, spark.sparkContext.defaultParallelism)


def p2_group(grouping: str) -> F.Column:
    if grouping == "balanced":
        return F.when(F.col("l_linestatus") == "F", "A").otherwise("B")
    if grouping == "unbalanced":
        return F.when(F.col("l_quantity") <= UNBALANCED_QTY, "A").otherwise("B")
    raise ValueError("grouping is 'balanced' or 'unbalanced'")


def p2_points(spark: SparkSession, sf_dir: str, grouping: str = "unbalanced",
              keep: tuple[str, ...] = ()) -> DataFrame:
    li = table(spark, sf_dir, "lineitem",
               ("l_quantity", "l_extendedprice", "l_linestatus", *keep))
    return points_from(li, [F.col("l_quantity"), F.col("l_extendedprice") / F.lit(PRICE_SCALE)],
                       p2_group(grouping), keep=keep)


def p64_points(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings", ("embedding", "label", *keep))
    grp = F.when(F.col("label") % 2 == 0, "A").otherwise("B")
    return points_from_array(emb, "embedding", grp, keep=keep, dim=P64_DIM)


def p64_centers(spark: SparkSession, sf_dir: str) -> list[tuple[float, ...]]:
    """Embedding of the smallest vec_id of each label, in label order (one row per label)."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    ids = [r["v"] for r in emb.groupBy("label").agg(F.min("vec_id").alias("v")).collect()]  # K ids
    rows = emb.filter(F.col("vec_id").isin(ids)).select("label", "embedding").orderBy("label").collect()
    return [tuple(float(v) for v in r["embedding"]) for r in rows]


def doc_lines(spark: SparkSession, sf_dir: str, keep_line_no: bool = True) -> DataFrame:
    """``(doc_id, line_no, value)`` for every line of every document."""
    return lines_from(table(spark, sf_dir, "documents", ("doc_id", "text")), "text", ["doc_id"],
                      keep_line_no)
