"""Workers find the package; scratch folders are shared."""

import os
import subprocess
import sys

import pytest

from sightline import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
from sightline import session
spark = session.build("elsewhere", master="local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
print("rows", entry.entry(spark).count())
"""


def test_workers_need_no_path_to_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1000" in done.stdout, done.stderr[-2000:]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
