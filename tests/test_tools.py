"""The skew checks run end to end (separate process: they need their own
session with the event log on) and their results equal DuckDB."""

import os
import subprocess
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("case", ["versions", "chunks", "status"])
def test_skew_check(sf_dir, case):
    scratch = tempfile.mkdtemp(prefix=f"skew-{case}-")
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), sf_dir, scratch, case],
        capture_output=True, text=True, timeout=900,
    )
    assert proc.returncode == 0, proc.stdout[-2000:] + proc.stderr[-2000:]
    assert "equal to DuckDB: True" in proc.stdout
