"""Workers need no copy of the package: a driver elsewhere, with the package on its own path only."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from __spark_entry__ import queries
from staywise.session import local_session
spark = local_session(2, 2)
for name in {names!r}:
    if name in queries():
        assert queries()[name](spark, {small!r}).count() > 0, name
print("all ran")
"""


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
def test_from_another_folder(tmp_path):
    names = ["change_points", "forest_attributions", "op6_toxicity_chain", "op5_language_mixture", "op8_quality_scores", "op3_nearest_vectors", "op10_simhash_components"]
    names += ["op11_whitened_vectors", "op12_log_bilinear_scores", "op13_token_alignment"]
    script = SCRIPT.format(root=str(ROOT), names=names, small=SMALL)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-2000:]
