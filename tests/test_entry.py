"""The rest of the repository without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LEFT_OUT = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
PROGRAM = """
import __spark_entry__ as entry
from sightline import session
assert "pipeline" not in entry.queries() and not [n for n in entry.queries() if n.startswith("op")]
spark = session.build(master="local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
print("rows", entry.entry(spark).count())
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_subpackage(tmp_path, pipeline):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=LEFT_OUT)
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink()
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=copy, capture_output=True, text=True, timeout=300,
        env={**os.environ, "PYTHONPATH": str(copy)},
    )
    assert "rows 1000" in done.stdout, done.stderr[-2000:]
