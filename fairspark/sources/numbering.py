"""Exact row numbers without a sort: rows per task, offsets, then the place within the task.

The rows are staged with the task that wrote them and their place in it, so the numbers stay the
same however the table is read later, and a retried task changes nothing.  Nothing is shuffled but
one count per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staged

#: Bits of the place within a task in ``monotonically_increasing_id``.
PLACE_BITS = 33


def numbered(df: DataFrame, name: str = "id") -> tuple[DataFrame, int]:
    """``df`` with a column ``name`` that counts its rows from 0 without gaps, and the number of rows."""
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"a column {name} is there already")
    rows = Staged(df.withColumn("_at", F.monotonically_increasing_id()), "rows").df
    task = F.shiftright("_at", PLACE_BITS)
    counts = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))  # one row per task
    before = F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_task", F.coalesce(before, F.lit(0)).alias("_before"), "_n")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    joined = rows.withColumn("_task", task).join(F.broadcast(offsets.drop("_n")), "_task")  # a number per task
    return joined.withColumn(name, F.col("_before") + place).drop("_task", "_at", "_before"), total
