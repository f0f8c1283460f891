"""The package works from another working directory: tasks bring its functions along."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from reelgrain.session import build_session
spark = build_session(master="local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
for name in ("j5_nearest_in_scene", "p7_resize_nearest", "x3_detector", "k3_running_anomalies"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("fine")
"""


def test_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", SCRIPT, root], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
