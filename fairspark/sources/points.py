"""Labelled points: read from text, take from a table, count per group.

Points are a DataFrame ``(features array<double>, grp string, ...)`` where
``grp`` is always ``'A'`` or ``'B'``: loaders map the caller's two labels onto
these, and any third label is an error, so every operator sees two groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import as_col
from .text import read_text_lines as read_lines

# fixed values: the two canonical group labels
GROUP_A = "A"
GROUP_B = "B"


def _canonical_group(label: Column, group_a: str, group_b: str) -> Column:
    return (
        F.when(label == F.lit(group_a), F.lit(GROUP_A))
        .when(label == F.lit(group_b), F.lit(GROUP_B))
        .otherwise(F.raise_error(F.concat(F.lit("label is neither group: "),
                                          F.coalesce(label.cast("string"), F.lit("NULL")))))
    )


def parse_points(lines: DataFrame, dim: int, group_a: str = GROUP_A, group_b: str = GROUP_B,
                 on_bad: str = "fail", col: str = "value") -> DataFrame:
    """Parse ``c1,...,cd,label`` lines into ``(features, grp)``.

    ``on_bad='fail'`` stops at a line with the wrong field count, a malformed
    number or a third label; ``on_bad='drop'`` leaves such lines out.
    """
    if on_bad not in ("fail", "drop"):
        raise ValueError("on_bad must be 'fail' or 'drop'")
    fields = F.split(F.col(col), ",")
    raw = F.slice(fields, 1, dim)
    label = F.element_at(fields, -1)
    # try_cast + an explicit check fails the same way whatever the ANSI setting
    feats = F.transform(raw, lambda s: s.try_cast("double"))
    if on_bad == "fail":
        checked = (F.when(F.size(fields) != dim + 1,
                          F.raise_error(F.concat(F.lit(f"expected {dim + 1} fields: "), F.col(col))))
                   .when(F.exists(feats, lambda x: x.isNull()),
                         F.raise_error(F.concat(F.lit("malformed number: "), F.col(col))))
                   .otherwise(feats))
        return lines.select(checked.alias("features"),
                            _canonical_group(label, group_a, group_b).alias("grp"))
    ok = ((F.size(fields) == dim + 1)
          & F.forall(feats, lambda x: x.isNotNull())
          & label.isin(group_a, group_b))
    return (lines.select(feats.alias("features"), label.alias("label"), ok.alias("ok"))
            .filter("ok")
            .select("features", F.when(F.col("label") == group_a, GROUP_A)
                    .otherwise(GROUP_B).alias("grp")))


def load_points(spark: SparkSession, path: str, dim: int, group_a: str = GROUP_A,
                group_b: str = GROUP_B, on_bad: str = "fail",
                partitions: int | None = None) -> DataFrame:
    """Read and parse a points text file."""
    return parse_points(read_lines(spark, path, partitions), dim, group_a, group_b, on_bad)


def points_from(df: DataFrame, coord_cols: Sequence[str | Column], group: str | Column,
                group_a: str = GROUP_A, group_b: str = GROUP_B,
                keep: Sequence[str] = ()) -> DataFrame:
    """Points from table columns: ``(features, grp, *keep)``; a NULL coordinate is an error."""
    coords = [as_col(c).cast("double") for c in coord_cols]
    any_null = coords[0].isNull()
    for c in coords[1:]:
        any_null = any_null | c.isNull()
    feats = F.when(any_null, F.raise_error(F.lit("NULL coordinate"))).otherwise(F.array(*coords))
    return df.select(*keep, feats.cast("array<double>").alias("features"),
                     _canonical_group(as_col(group), group_a, group_b).alias("grp"))


def points_from_array(df: DataFrame, array_col: str | Column, group: str | Column,
                      group_a: str = GROUP_A, group_b: str = GROUP_B,
                      keep: Sequence[str] = (), dim: int | None = None) -> DataFrame:
    """Points from an array column (e.g. an embedding); a NULL vector or element is an error, and so
    is a vector that has not the declared ``dim`` coordinates."""
    arr = as_col(array_col).cast("array<double>")  # a plain cast stays in generated code
    bad = arr.isNull() | F.exists(arr, lambda x: x.isNull())
    feats = F.when(bad, F.raise_error(F.lit("NULL coordinate")))
    if dim is not None:
        feats = feats.when(F.size(arr) != dim, F.raise_error(F.lit(f"expected {dim} coordinates")))
    feats = feats.otherwise(arr)
    return df.select(*keep, feats.cast("array<double>").alias("features"),
                     _canonical_group(as_col(group), group_a, group_b).alias("grp"))


def persist_points(points: DataFrame) -> DataFrame:
    """Keep points for iterative use, in the partitions they have; starts no job.

    Blocks lost with an executor are rebuilt from the scan by lineage.
    """
    return points.persist(StorageLevel.MEMORY_AND_DISK)


def group_counts(points: DataFrame) -> DataFrame:
    """``(n, n_a, n_b)`` in one pass."""
    return points.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("grp") == GROUP_A).alias("n_a"),
        F.count_if(F.col("grp") == GROUP_B).alias("n_b"),
    )
