"""Stored steps without any setting from outside."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

SCRIPT = """
from tillworks.session import build_session, shared_folder, stored
spark = build_session(master="local[2]", partitions=2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert stored(spark.range(5)).count() == 5
from __spark_entry__ import queries
assert queries()["store_matrix"](spark, "/root/testdata/sf0.001").count() > 0
print("FOLDER", shared_folder(spark))
spark.stop()
"""


def test_stored_steps_need_no_setting_and_leave_nothing(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(REPO)}
    ran = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=REPO, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]
    folder = ran.stdout.split("FOLDER ")[1].strip()
    assert not Path(folder).exists()
