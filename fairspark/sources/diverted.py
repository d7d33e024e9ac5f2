"""Reading point files with diversion: good points, and beside them every bad line with its place.

One pass parses the lines and stages the outcome with each line's file, split and place among the
rows of its task.  The lines of a split stand together in a task, so a line's number in its file is
its place in the split plus the lines of the file's earlier splits; that takes one row per split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import Staged
from .points import GROUP_A, GROUP_B

# fixed values: why a line is no point
FIELD_COUNT = "field count"
NUMBER = "malformed number"
LABEL = "label is neither group"


@dataclass
class DivertedPoints:
    """``good`` is ``(features, grp)``; ``bad`` is ``(file, line, value, reason)``, lines counted from 1."""

    good: DataFrame
    bad: DataFrame
    staged: Staged

    def drop(self) -> None:
        """Delete the staged lines; neither frame can be read any more."""
        self.staged.drop()


def parsed(value: Column, dim: int, group_a: str = GROUP_A, group_b: str = GROUP_B) -> tuple[Column, Column, Column]:
    """``(features, grp, reason)`` of a line ``c1,...,cd,label``; ``reason`` is null for a point."""
    fields = F.split(value, ",")
    features = F.transform(F.slice(fields, 1, dim), lambda s: s.try_cast("double"))
    label = F.element_at(fields, -1)
    reason = (F.when(F.size(fields) != dim + 1, FIELD_COUNT)
              .when(F.exists(features, lambda x: x.isNull()), NUMBER)
              .when(~label.isin(group_a, group_b), LABEL))
    return features, F.when(label == group_a, GROUP_A).otherwise(GROUP_B), reason


def read_points_diverted(spark: SparkSession, path: str, dim: int, group_a: str = GROUP_A,
                         group_b: str = GROUP_B) -> DivertedPoints:
    """Points and bad lines of the text files under ``path``."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"))
    features, grp, reason = parsed(F.col("value"), dim, group_a, group_b)
    judged = lines.select("file", "split", "at", "value", features.alias("features"), grp.alias("grp"), reason.alias("reason"))
    is_good = F.col("reason").isNull()
    kept = judged.select("file", "split", "at", F.when(is_good, F.col("features")).alias("features"),
                         F.when(is_good, F.col("grp")).alias("grp"), F.when(~is_good, F.col("value")).alias("value"), "reason")
    staged = Staged(kept, "point-lines")
    splits = staged.df.groupBy("file", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("lines"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "split", "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    bad = (staged.df.filter("reason is not null").join(starts, ["file", "split"])
           .select("file", (F.col("at") - F.col("first") + F.col("before") + 1).alias("line"), "value", "reason"))
    return DivertedPoints(staged.df.filter("reason is null").select("features", "grp"), bad, staged)
