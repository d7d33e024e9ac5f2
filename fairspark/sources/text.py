"""Text sources: a text file, or a text column of a table, as lines.

A line is one "document" of the word-count operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import line_array


def read_text_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """``(value string)``, one row per line of the files under ``path``.

    The input splits already spread the read; the round-robin shuffle over ``partitions`` tasks is
    only done when asked for.
    """
    df = spark.read.text(path)
    return df.repartition(partitions) if partitions else df


def lines_from(df: DataFrame, text_col: str = "text", id_cols: Sequence[str] = ("doc_id",),
               keep_line_no: bool = True) -> DataFrame:
    """Split a text column into lines: ``(*id_cols, line_no, value)``.

    ``line_no`` starts at 0.  Null texts have no lines.
    """
    # An inner explode makes Catalyst add ``size(lines) > 0`` below it, which
    # splits every text twice; the outer form plus a null filter does not.
    src = df.select(*id_cols, line_array(F.col(text_col)).alias("_lines"))
    if keep_line_no:
        out = src.select(*id_cols, F.posexplode_outer("_lines").alias("line_no", "value"))
    else:
        out = src.select(*id_cols, F.explode_outer("_lines").alias("value"))
    return out.filter(F.col("value").isNotNull())
