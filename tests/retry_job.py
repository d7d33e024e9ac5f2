"""Run word counts and a fair step with an injected task failure; print the comparison.

Started by tests/test_retry.py in its own process, because task retries need a
``local[N, maxFailures]`` master.
"""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from fairspark.operators import fair, words  # noqa: E402
from fairspark.plans import tables  # noqa: E402

SF = "/root/testdata/sf0.01"


def flaky(batches):
    ctx = TaskContext.get()
    fail = ctx.partitionId() == 1 and ctx.attemptNumber() == 0
    for b in batches:
        if fail:
            raise RuntimeError("injected task failure")
        yield b


def main():
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    lines = tables.doc_lines(spark, SF)
    clean = sorted(words.word_counts(lines, "salted", 8, ["doc_id", "line_no"]).collect())
    hit = lines.mapInPandas(flaky, lines.schema)
    retried = sorted(words.word_counts(hit, "salted", 8, ["doc_id", "line_no"]).collect())
    pts = tables.p2_points(spark, SF).select("features", "grp")
    c1 = fair.fair_step(pts, tables.P2_CENTERS)
    c2 = fair.fair_step(pts.mapInPandas(flaky, pts.schema), tables.P2_CENTERS)
    same_centers = all(abs(a - b) < 1e-9 for p, q in zip(c1, c2) for a, b in zip(p, q))
    print("RESULT", clean == retried, len(clean), same_centers)


if __name__ == "__main__":
    main()
