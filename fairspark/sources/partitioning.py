"""Input spreading.

A scan yields one task per file split or row group.  A small input in one
large row group would run every later stage in a single task; ``spread``
round-robins such an input over the cluster's task slots.  A large input
already has many files and is returned as is (no shuffle).  It is meant for
plain file scans: the number of files is known without planning or running one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """``df``, a file scan, dealt over ``partitions`` tasks if it has fewer files."""
    return df if len(df.inputFiles()) >= partitions else df.repartition(partitions)
