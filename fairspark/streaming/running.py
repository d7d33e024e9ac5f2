"""The same operators on Structured Streaming inputs.

The reference programs are batch only; these helpers let the word count and
the per-group cost of fixed centres run incrementally over a growing folder
of text files.  They reuse the batch operators unchanged -- both are
aggregations Spark keeps as streaming state -- and write their state under
the session's checkpoint folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.geometry import Centers
from ..operators.objective import group_mean_costs
from ..operators.words import word_counts
from ..session import ensure_checkpoint_dir
from ..sources.points import parse_points


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines ``(value)`` of the text files arriving under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def running_word_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(word, n)`` kept up to date as lines arrive (output mode complete or update)."""
    return word_counts(lines, "one_round", col=col)


def running_group_costs(lines: DataFrame, centers: Centers, dim: int) -> DataFrame:
    """``(grp, n, mean_cost)`` of arriving point lines against fixed centres."""
    return group_mean_costs(parse_points(lines, dim), centers)


def start(result: DataFrame, name: str, sink: str, mode: str = "complete",
          checkpoint: str | None = None, **options) -> StreamingQuery:
    """Start a streaming aggregation into ``sink`` with its state under the checkpoint folder (the
    ``memory`` sink brings every result to the driver and is for tests)."""
    spark = result.sparkSession
    base = checkpoint or os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex}")
    writer = (result.writeStream.format(sink).outputMode(mode).queryName(name)
              .option("checkpointLocation", base))
    for k, v in options.items():
        writer = writer.option(k, v)
    return writer.start()
