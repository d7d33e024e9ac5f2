"""Per-step cost of fair Lloyd as the point count grows (synthetic two-group points).

usage: python scripts/scale_check.py [n ...]      (default: 2000000 20000000)
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fairspark.operators import fair, objective  # noqa: E402
from fairspark.session import local_session  # noqa: E402
from fairspark.sources.points import persist_points, points_from  # noqa: E402
from fairspark.sources.synth import synth_points  # noqa: E402


def main() -> None:
    sizes = [int(a) for a in sys.argv[1:]] or [2_000_000, 20_000_000]
    spark = local_session(8, shuffle_partitions=16, extra={"spark.driver.memory": "16g"})
    for n in sizes:
        pts = persist_points(points_from(synth_points(spark, n, 5, seed=7, partitions=32), ["x", "y"], "grp"))
        t = time.time()
        pts.count()
        load = time.time() - t
        centers = [(10.0 + 100 * i, 40.0) for i in range(5)]
        steps = []
        for _ in range(4):
            t = time.time()
            centers = fair.fair_step(pts, centers)
            steps.append(round(time.time() - t, 2))
        phi = objective.fair_objective(pts, centers).head()[0]
        print(f"n={n} load={load:.1f}s steps={steps} phi={phi:.4f}", flush=True)
        pts.unpersist()


if __name__ == "__main__":
    main()
