"""The whole test tree is collected in one run (no module hides another)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_whole_tree_is_collected():
    r = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=ROOT, capture_output=True, text=True)
    assert r.returncode == 0, r.stdout[-2000:]
    for f in os.listdir(os.path.join(ROOT, "tests")):
        if f.startswith("test_"):
            assert f"tests/{f}::" in r.stdout, f
