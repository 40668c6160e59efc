"""Injected task failures are retried and give the same numbers (separate
process: retries need a ``local[N,F]`` master)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_retried_tasks_give_the_same_results(sf_dir):
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "retry_check.py"), sf_dir],
        capture_output=True, text=True, timeout=900,
    )
    assert proc.returncode == 0, proc.stdout[-2000:] + proc.stderr[-2000:]
    assert "equal after retries: True; candidates" in proc.stdout
