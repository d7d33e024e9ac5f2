import subprocess
import sys
from pathlib import Path


def test_jobs_survive_an_injected_task_failure():
    job = Path(__file__).with_name("retry_job.py")
    out = subprocess.run([sys.executable, str(job)], capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    _, same_counts, n, same_centers = line[0].split()
    assert same_counts == "True" and int(n) > 0 and same_centers == "True"
